"""Export a set of tables as a bundle."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.names import column, make_fqn, names_of, quoted
from ..operators.constraints import Constraints
from ..operators.reconcile import (
    assert_reconciled, fingerprints, merge_parts, missing_results, reconcile, stem_collisions)
from ..session import path_exists, pinned, small_frame
from ..sources import bundle as bd
from .chunking import ChunkPlan, SINGLE, with_part
from .inventory import LARGE_TABLE_ROWS, chunk_plan, excluded_names, export_order, plan_tables, row_counts

# files a task holds open at most; it sorts what belongs to further parts
OPEN_FILES = 32


def write_part(df: DataFrame, path: str, plan: ChunkPlan, level: int = 3, rows_per_group: int = 100_000,
               cluster: bool = False) -> int:
    """Write one table's data below ``path`` and return the rows that reached the writer.

    Without ``cluster`` every scan task writes its own files and nothing is shuffled. With it, rows are
    rebalanced by part first, which AQE cuts to even tasks, so a part with a third of the rows becomes
    several files rather than one task. That is spared where the tasks' own files are large enough already.
    """
    seen = Observation()
    single = plan.parts == 1
    part = bd.part_name(df.columns)
    placed = df if single else with_part(df, plan, part)
    if cluster and not single and not _large_files(df, plan, rows_per_group):
        placed = placed.hint("rebalance", quoted(part))
    writer = (
        placed.observe(seen, F.count(F.lit(1)).alias("rows")).write
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", min(max(level, 1), 22))
        .option("parquet.block.row.count.limit", rows_per_group))
    if single:
        writer.parquet(f"{path}/{part}=0")
    else:
        writer.partitionBy(part).parquet(path)
    return seen.get["rows"]


def _large_files(df: DataFrame, plan: ChunkPlan, rows_per_group: int) -> bool:
    """Whether files of one task and part hold half a row group or more on average; reads the key only.

    Row groups end at ``rows_per_group`` rows whatever the file, so larger files would be cut no better.
    """
    if plan.searches():
        return False
    task = F.spark_partition_id().alias("task")
    files = with_part(df.select(column(plan.key)), plan, "part").groupBy(task, "part").agg(F.count(F.lit(1)).alias("rows"))
    seen = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    return seen["files"] * rows_per_group <= 2 * seen["rows"]


@contextmanager
def _open_writers(spark: SparkSession, parts: int):
    """Writes within keep a file per part open instead of sorting a task's rows by part, which spills."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, max(parts, int(before or 0)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def fqn_of(name, schema: str = "main") -> str:
    """``table`` or (schema, table) -> the bracketed name."""
    return make_fqn(*name) if isinstance(name, tuple) else make_fqn(schema, name)


def concrete_plans(tables: Mapping[str, DataFrame], chunks: int, threshold: int, declared=()) -> dict[str, ChunkPlan]:
    """Chunk plan per table, keyed tables first. ``declared`` keys settle uniqueness without a look at the data."""
    rows = export_order(plan_tables(tables, chunks, threshold, declared, lean=True)).collect()  # one row per table
    with ThreadPoolExecutor(8) as pool:
        made = pool.map(lambda r: chunk_plan(tables[r["table_name"]], r["strategy"], r["chunk_key"], chunks,
                                             (r["lo"], r["hi"])), rows)
        return {r["table_name"]: plan for r, plan in zip(rows, made)}


def export_tables(
    spark: SparkSession, source: Mapping[str, DataFrame], out: str, exclude=(), schema_only: bool = False,
    level: int = 3, chunks: int | None = None, chunk_threshold: int | None = None, rows_per_group: int = 100_000,
    validate: bool = False, layout: str = "scan", parallel: int = 8, schema: str = "main",
    source_host: str = "", source_database: str = "", plans: Mapping[str, ChunkPlan] | None = None,
    constraints: Constraints | None = None,
) -> DataFrame:
    """Write ``source`` (table name -> DataFrame) to ``out``; returns one row per stored part.

    A table of another schema than ``schema`` is named by a (schema, table) pair, so equal table names of two
    schemas can share a bundle. ``exclude`` patterns match the table or ``schema.table``. ``validate`` compares the
    content of what was stored with the source, not only its rows.

    ``layout="scan"`` keeps the partitions the source is read in, with no shuffle. ``layout="key"``
    clusters large tables by their chunk key into ``chunks`` parts (8), at the price of one where a task's rows of a
    part would make small files; ``chunks`` and
    ``chunk_threshold`` belong to it and are refused with the other. ``plans``
    overrides the plan of single tables: with the scan layout it fits a table read by the same plan's
    chunk predicates, where every task already holds one part. The keys of ``constraints`` (tables named ``table`` or
    ``schema.table``) choose chunk keys without measuring what is unique; they are not checked here.
    """
    if layout not in ("scan", "key"):
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "scan" and (chunks is not None or chunk_threshold is not None):
        raise ValueError("chunks and chunk_threshold need the key layout")
    chunks, chunk_threshold = chunks or 8, LARGE_TABLE_ROWS if chunk_threshold is None else chunk_threshold
    if path_exists(spark, f"{out}/manifest.json") or path_exists(spark, f"{out}/data"):
        raise FileExistsError(f"{out} already holds a bundle or part of one")
    tables = {}
    for name, df in source.items():
        own, table = name if isinstance(name, tuple) else (schema, name)
        if not excluded_names([table], exclude, own):
            tables[name] = df
    if not tables:
        raise ValueError("no tables to export")
    fqns = {name: fqn_of(name, schema) for name in tables}
    if len(set(fqns.values())) < len(fqns):
        raise ValueError("a table is named twice")
    names = small_frame(spark, [(f,) for f in fqns.values()], "table_fqn string")
    clash = stem_collisions(names).first() if len(fqns) > 1 else None
    if clash:
        raise ValueError(f"{clash['first_fqn']} and {clash['last_fqn']} share the file stem {clash['stem']}")

    chosen = dict.fromkeys(tables, SINGLE)
    if layout == "key" and not schema_only:
        known = {name: fqn for fqn in fqns.values() for name in names_of({fqn: None})}
        known = {name: fqn for name, fqn in known.items() if name in names_of(dict.fromkeys(fqns.values()))}
        declared = [replace(k, table=known[k.table]) for k in (constraints.keys if constraints else ()) if k.table in known]
        by_fqn = concrete_plans({fqns[n]: df for n, df in tables.items()}, chunks, chunk_threshold, declared)
        chosen = {n: by_fqn[fqns[n]] for n in tables}
    chosen.update(plans or {})

    def write(name: str) -> tuple[str, int]:
        df = tables[name].limit(0) if schema_only else tables[name]
        path = f"{out}/{bd.data_dir(fqns[name])}"
        return fqns[name], write_part(df, path, chosen[name], level, rows_per_group, layout == "key")

    # the jobs are independent; a few at a time keep the executors busy while a small one finishes
    most = max(plan.parts for plan in chosen.values())
    with _open_writers(spark, min(most, OPEN_FILES)), ThreadPoolExecutor(max(1, parallel)) as pool:
        written = dict(pool.map(write, [n for n in chosen if n in tables]))

    schemas = {fqns[n]: df.schema for n, df in tables.items()}
    folders = {fqn: [bd.data_dir(fqn)] for fqn in fqns.values()}
    counted = bd.stored_counts(spark, out, folders, schemas)
    path = F.concat(F.col("folder"), F.lit("="), F.col("part").cast("string"))
    first = {fqns[n]: f"{bd.data_dir(fqns[n])}/{bd.part_name(df.columns)}" for n, df in tables.items()}
    where = small_frame(spark, first.items(), "table_fqn string, folder string")
    stats = counted.join(where, "table_fqn").select("table_fqn", "part", path.alias("path"), "rows")
    # at most tables x chunks rows: this is what goes into the manifest
    stats = pinned(stats)
    merged = {r["table_fqn"]: r for r in merge_parts(stats).collect()}
    for fqn, rows in written.items():
        stored = merged[fqn]["row_count"] if fqn in merged else 0
        if stored != rows:
            raise ValueError(f"{fqn}: {rows} rows read, {stored} rows stored")
    # every table has a result: a stored part, or no row seen by its write
    empty = [(f,) for f, rows in written.items() if rows == 0]
    results = stats.select("table_fqn").distinct().unionByName(small_frame(spark, empty, "table_fqn string"))
    if missing_results(names, results, "table_fqn").take(1):
        raise ValueError("some tables were not exported; refusing to write a partial bundle")

    entries = []
    for name, df in tables.items():
        fqn = fqns[name]
        identity = [f.name for f in df.schema.fields if (f.metadata or {}).get("identity")]
        files = list(merged[fqn]["file_names"]) if fqn in merged else [f"{first[fqn]}=0"]
        entries.append({"table_fqn": fqn, "file_names": files,
                        "row_count": merged[fqn]["row_count"] if fqn in merged else 0,
                        "has_identity": bool(identity), "identity_columns": identity})
    if validate and not schema_only:
        named = {fqns[n]: df for n, df in tables.items()}
        counted = {r[0]: r[1] for r in row_counts(named).collect()}
        live = small_frame(spark, [(f, counted.get(f, 0)) for f in named], "table_fqn string, row_count bigint")
        archive = small_frame(spark, [(e["table_fqn"], e["row_count"]) for e in entries],
                                        "table_fqn string, row_count bigint")
        assert_reconciled(reconcile(archive, live, "table_fqn"))
        stored = {e["table_fqn"]: spark.read.schema(schemas[e["table_fqn"]]).parquet(
            *[f"{out}/{p}" for p in e["file_names"]]) for e in entries}
        both = [{r["table_name"]: r["fingerprint"] for r in fingerprints(t).collect()} for t in (named, stored)]
        differing = sorted(f for f in named if both[0].get(f) != both[1].get(f))
        if differing:
            raise ValueError(f"stored content differs from the source: {', '.join(differing)}")
    bd.write_schemas(spark, out, schemas)
    bd.write_manifest(spark, out, {
        "writer_version": "1", "format_version": bd.FORMAT_VERSION,
        "created_at": datetime.now(timezone.utc).isoformat(), "source_host": source_host,
        "source_database": source_database, "tables": entries,
        "total_rows": sum(e["row_count"] for e in entries), "schema_only": schema_only})
    return stats
