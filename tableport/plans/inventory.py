"""What is in a set of tables: counts, column profiles, chunk-key choice and the export plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import column, glob_to_regex, make_fqn, qualified_name
from ..session import pinned, small_frame
from .chunking import ChunkPlan, SINGLE, modulo_plan, ntile_plan, range_plan

# A table above this many rows counts as large; values above this many bytes are
# large objects (the widest in-row value of the source engine).
LARGE_TABLE_ROWS = 500_000
IN_ROW_BYTES = 8000

Tables = Mapping[str, DataFrame]


def union_all(frames) -> DataFrame:
    """Bag union by name, paired up as a tree so the plan stays log(n) deep."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = zip(frames[::2], frames[1::2])
        odd = frames[-1:] if len(frames) % 2 else []
        frames = [a.unionByName(b) for a, b in pairs] + odd
    return frames[0]


def _session(tables: Tables) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def exclude(listing: DataFrame, patterns, schema_col: str = "schema_name",
            table_col: str = "table_name") -> DataFrame:
    """Drop tables whose ``table`` or ``schema.table`` matches a glob. Case-sensitive; bad globs raise."""
    for pattern in patterns:
        rx = glob_to_regex(pattern)
        full = F.concat_ws(".", F.col(schema_col), F.col(table_col))
        listing = listing.filter(~(F.col(table_col).rlike(rx) | full.rlike(rx)))
    return listing


def excluded_names(names, patterns, schema: str = "main") -> set[str]:
    """The same rule for a handful of names on the driver."""
    import re

    rules = [re.compile(glob_to_regex(p).replace(r"\z", r"\Z")) for p in patterns]
    return {n for n in names if any(r.match(n) or r.match(f"{schema}.{n}") for r in rules)}


def row_counts(tables: Tables) -> DataFrame:
    """(table_name, row_count) of every non-empty table.

    All scans feed one map-side-combined count, so many tables cost one shuffle of a row per task; no
    column is read, the Parquet footers answer.
    """
    rows = union_all([df.select(F.lit(name).alias("table_name")) for name, df in tables.items()])
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


def inventory(tables: Tables, schema: str = "main") -> DataFrame:
    """One row per table: names, ordinal, number of columns and exact row count."""
    listing = small_frame(
        _session(tables),
        [(schema, name, i, len(df.columns)) for i, (name, df) in enumerate(tables.items())],
        "schema_name string, table_name string, ordinal int, column_count int")
    return listing.join(row_counts(tables), "table_name", "left").select(
        "schema_name", "table_name", "ordinal", "column_count",
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        qualified_name("schema_name", "table_name").alias("table_fqn"))


def inventory_totals(listing: DataFrame, large_rows: int = LARGE_TABLE_ROWS) -> DataFrame:
    return listing.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_distinct("schema_name").alias("schemas"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.count_if(F.col("row_count") > large_rows).alias("large_tables"),
    )


def schema_names(listing: DataFrame) -> DataFrame:
    return listing.select("schema_name").distinct().orderBy("schema_name")


def largest_table(listing: DataFrame) -> DataFrame:
    """Most rows wins; the first in catalog order on ties and when all are empty."""
    return listing.orderBy(F.desc("row_count"), "ordinal").limit(1)


def _is_key_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.IntegerType, T.LongType))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


PROFILE = ("table_name string, rows bigint, ordinal int, column_name string, data_type string, key_type boolean, "
           "nulls bigint, lo bigint, hi bigint, max_bytes bigint")


def column_profile(tables: Tables, only=lambda f: True) -> DataFrame:
    """One row per column: rows, nulls, integer bounds and longest value, in one pass per table.

    ``only`` picks columns by their StructField; the others are not read.
    """
    frames = []
    for name, df in tables.items():
        aggregates, cells = ["count(1) AS rows"], []
        for i, f in enumerate(df.schema.fields):
            if not only(f):
                continue
            c = _quoted(f.name)
            aggregates.append(f"count_if({c} IS NULL) AS n{i}")
            lo = hi = longest = "CAST(NULL AS BIGINT)"
            if _is_key_type(f.dataType):
                aggregates += [f"CAST(min({c}) AS BIGINT) AS lo{i}", f"CAST(max({c}) AS BIGINT) AS hi{i}"]
                lo, hi = f"lo{i}", f"hi{i}"
            elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
                aggregates.append(f"CAST(max(octet_length({c})) AS BIGINT) AS b{i}")
                longest = f"b{i}"
            cells.append(
                f"struct({i} AS ordinal, {_text(f.name)} AS column_name, "
                f"{_text(f.dataType.simpleString())} AS data_type, {str(_is_key_type(f.dataType))} AS key_type, "
                f"n{i} AS nulls, {lo} AS lo, {hi} AS hi, {longest} AS max_bytes)")
        if not cells:
            continue
        frames.append(df.agg(*[F.expr(a) for a in aggregates]).selectExpr(
            f"{_text(name)} AS table_name", "rows", f"inline(array({', '.join(cells)}))"))
    return union_all(frames) if frames else small_frame(_session(tables), [], PROFILE)


def lob_profile(profile: DataFrame, limit: int = IN_ROW_BYTES) -> DataFrame:
    """Longest value of every string and binary column, flagged above ``limit`` bytes."""
    return profile.filter(F.col("data_type").isin("string", "binary")).select(
        "table_name", "column_name", "max_bytes",
        (F.coalesce("max_bytes", F.lit(0)) > limit).alias("is_lob"))


def _column_of(r) -> tuple[str, str]:
    return r["table_name"], r["column_name"]


def _most_copies(tables: Tables, columns) -> dict[tuple[str, str], int]:
    """Largest number of rows sharing one value, per column."""
    frames = []
    for table, name in map(_column_of, columns):
        keys = tables[table].select(column(name).alias("k"))
        frames.append(keys.groupBy("k").count().agg(
            F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
            F.coalesce(F.max("count"), F.lit(0)).alias("copies")))
    return {_column_of(r): r["copies"] for r in union_all(frames).collect()} if frames else {}


KEYS = ("table_name string, column_name string, ordinal int, rows bigint, nulls bigint, lo bigint, hi bigint, "
        "is_unique boolean, key_rank int")
LOBS = "table_name string, column_name string, max_bytes bigint, is_lob boolean"


def key_profile(tables: Tables, profile: DataFrame | None = None) -> DataFrame:
    """Integer columns with exact uniqueness, best chunk key first (``key_rank`` 1).

    Bounds settle most columns for free: more rows than values between MIN and MAX means duplicates.
    Only the others pay for a duplicate count, and that one moves the key column alone. The profile
    itself is a few rows per table, so it is read to the driver to decide which columns those are.
    """
    spark = _session(tables)
    stats = (column_profile(tables) if profile is None else profile).filter("key_type").collect()
    candidates = [r for r in stats if r["lo"] is not None and r["nulls"] == 0 and r["rows"] <= r["hi"] - r["lo"] + 1]
    counted = _most_copies(tables, candidates)
    unique = {column for column, copies in counted.items() if copies <= 1}
    order = {}
    for r in stats:
        is_unique = _column_of(r) in unique or r["rows"] == 0
        order.setdefault(r["table_name"], []).append((not is_unique, r["nulls"] > 0, r["ordinal"], r))
    rows = []
    for entries in order.values():
        for rank, (not_unique, _, _, r) in enumerate(sorted(entries, key=lambda e: e[:3]), start=1):
            rows.append((r["table_name"], r["column_name"], r["ordinal"], r["rows"], r["nulls"], r["lo"],
                         r["hi"], not not_unique, rank))
    return small_frame(spark, rows, KEYS)


def plan_rows(listing: DataFrame, keys: DataFrame, lobs: DataFrame, n: int, threshold: int) -> DataFrame:
    """Strategy per table as one CASE over its profile.

    single: no usable key, n <= 1, or fewer rows than the threshold. A key that is unique and free of
    NULLs is treated as indexed and split by MIN/MAX (single when it has one value); any other key
    is split by NTILE edges when the table holds large objects and by modulo otherwise.
    """
    best = keys.filter("key_rank = 1 AND nulls = 0").select(
        "table_name", F.col("column_name").alias("chunk_key"), "lo", "hi", F.col("is_unique").alias("indexed"))
    lob = lobs.groupBy("table_name").agg(F.max("is_lob").alias("has_lob"))
    joined = listing.join(best, "table_name", "left").join(lob, "table_name", "left")
    has_lob = F.coalesce("has_lob", F.lit(False))
    strategy = (
        F.when(F.col("chunk_key").isNull() | F.lit(n <= 1), "single")
        .when(F.col("row_count") < threshold, "single")
        .when(~F.col("indexed") & has_lob, "ntile")
        .when(~F.col("indexed"), "modulo")
        .when(F.col("lo") >= F.col("hi"), "single")
        .otherwise("range"))
    planned = joined.withColumn("strategy", strategy)
    return planned.select(
        "table_name", "ordinal", "row_count", "chunk_key", "lo", "hi",
        F.coalesce("indexed", F.lit(False)).alias("indexed"),
        has_lob.alias("has_lob"), "strategy",
        F.when(F.col("strategy") == "single", 1).otherwise(n).alias("chunks"),
        (has_lob & F.col("strategy").isin("range", "ntile")).alias("lob_range"),
    )


def export_order(plan: DataFrame) -> DataFrame:
    """Tables with a key first, catalog order within each half."""
    return plan.orderBy(F.col("chunk_key").isNull(), "ordinal")


def _declared_keys(tables: Tables, profile, declared) -> list:
    """Chunk keys that need no look at the data: a sole identity column, else the first single-column declared key
    of an integer type, else a NOT NULL column called ``id``."""
    stats = {_column_of(r): r for r in profile}
    found = []
    for name, df in tables.items():
        fields = [f for f in df.schema.fields if _is_key_type(f.dataType)]
        identity = [f.name for f in fields if (f.metadata or {}).get("identity")]
        keyed = [k.columns[0] for k in sorted((k for k in declared if k.table == name), key=lambda k: not k.primary)
                 if len(k.columns) == 1 and k.columns[0] in {f.name for f in fields}]
        named = [f.name for f in fields if f.name.lower() == "id" and not f.nullable]
        chosen = identity if len(identity) == 1 else keyed or named
        if chosen and stats[name, chosen[0]]["nulls"] == 0:
            found.append(stats[name, chosen[0]])
    return found


def plan_tables(tables: Tables, n: int = 8, threshold: int = LARGE_TABLE_ROWS, declared=(),
                lean: bool = False) -> DataFrame:
    """Strategy per table, with every table's best key and value widths; ``lean`` looks only at what decides.

    Lean, as an export plans: row counts come from footers. Only tables of at least ``threshold`` rows are looked at,
    and of those only the integer columns; uniqueness is measured only where no identity column, declared key
    (``declared``: ``Key``s) or NOT NULL ``id`` settles it, and value widths only for tables without a unique key,
    since no other strategy depends on them. Keys of small tables and ``has_lob`` of the others stay empty then.
    """
    spark = _session(tables)
    listing = pinned(inventory(tables))
    if not lean:
        profile = pinned(column_profile(tables))
        return plan_rows(listing, key_profile(tables, profile), lob_profile(profile), n, threshold)
    large = {r["table_name"] for r in listing.collect() if r["row_count"] >= threshold} if n > 1 else set()
    large = {name: df for name, df in tables.items() if name in large}
    if not large:
        return plan_rows(listing, small_frame(spark, [], KEYS), small_frame(spark, [], LOBS), n, threshold)
    profile = pinned(column_profile(large, lambda f: _is_key_type(f.dataType)))
    settled = _declared_keys(large, profile.collect(), declared)
    done = {r["table_name"] for r in settled}
    open_tables = {name: df for name, df in large.items() if name not in done}
    keys = small_frame(spark, [(r["table_name"], r["column_name"], r["ordinal"], r["rows"], r["nulls"], r["lo"], r["hi"],
                                True, 1) for r in settled], KEYS)
    if open_tables:
        keys = keys.unionByName(key_profile(open_tables, profile.where(F.col("table_name").isin(*open_tables))))
    keys = pinned(keys)
    unsure = {r[0] for r in keys.filter("key_rank = 1 AND NOT is_unique").select("table_name").collect()}
    wide = {name: df for name, df in large.items() if name in unsure}
    lobs = lob_profile(column_profile(wide, lambda f: isinstance(f.dataType, (T.StringType, T.BinaryType)))) \
        if wide else small_frame(spark, [], LOBS)
    return plan_rows(listing, keys, lobs, n, threshold)


def chunk_plan(df: DataFrame, strategy: str, key: str | None, n: int, bounds: tuple | None = None) -> ChunkPlan:
    """The concrete cuts for one table's strategy; ``bounds`` as profiled save a range plan its pass."""
    if strategy == "range":
        return range_plan(df, key, n, bounds)
    if strategy == "ntile":
        return ntile_plan(df, key, n)
    if strategy == "modulo":
        return modulo_plan(key, n)
    return SINGLE


def sample(df: DataFrame, columns=None, max_rows: int | None = None, key: str | None = None,
           key_range: tuple[int, int] | None = None, order_by=()) -> DataFrame:
    """A probe of a table: few columns, an optional closed key range, an optional row limit.

    ``columns``: None takes the first five, ``"all"`` every one, a list or comma text names them without
    regard to case. ``order_by`` makes the limited rows repeatable.
    """
    if columns is None:
        chosen = df.columns[:5]
    elif isinstance(columns, str) and columns.lower() == "all":
        chosen = df.columns
    else:
        wanted = columns.split(",") if isinstance(columns, str) else list(columns)
        by_lower = {c.lower(): c for c in reversed(df.columns)}
        chosen = []
        for name in (w.strip() for w in wanted):
            if not name:
                continue
            if name.lower() not in by_lower:
                raise ValueError(f"column {name!r} not found")
            chosen.append(by_lower[name.lower()])
    if key_range is not None:
        if key is None:
            raise ValueError("a key range needs a chunk key")
        df = df.filter(column(key).between(*key_range))
    if order_by:
        df = df.orderBy(*order_by)
    if max_rows is not None:
        df = df.limit(max_rows)
    return df.select(*[column(c) for c in chosen])


def dictionary(tables: Tables, schema: str = "main") -> DataFrame:
    """Declared columns of every table, in catalog order, from schemas and field metadata."""
    rows = []
    for name, df in tables.items():
        for i, f in enumerate(df.schema.fields):
            m = f.metadata or {}
            rows.append((make_fqn(schema, name), name, i, f.name, m.get("sql_type", f.dataType.simpleString()),
                         m.get("precision"), m.get("scale"), m.get("max_length"), f.nullable,
                         bool(m.get("identity", False)), m.get("seed"), m.get("increment"),
                         m.get("collation"), m.get("default_name"), m.get("default")))
    return small_frame(
        _session(tables),
        rows, "table_fqn string, table_name string, ordinal int, name string, sql_type string, precision int, "
              "scale int, max_length int, is_nullable boolean, is_identity boolean, seed bigint, "
              "increment bigint, collation string, default_name string, default_definition string")
