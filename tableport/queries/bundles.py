"""Bundles: export, restore, manifest checks and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.names import make_fqn, part_path, split_fqn
from ..operators import reconcile as rec
from ..operators.constraints import Constraints, ForeignKey, Key
from ..plans import chunking
from ..plans.export import export_tables
from ..plans.inventory import inventory
from ..plans.restore import restore_tables
from ..session import scratch_path, small_frame
from ..sources import bundle as bd
from ..sources.targets import PathTarget
from .catalog import PLAN_CHUNKS, PLAN_THRESHOLD
from .common import CHUNKS, TABLES, load, load_all
from .declared import COLUMNS

FIRST = {t: cols[0][0] for t, cols in COLUMNS.items()}


def _roundtrip(spark, root, tables=None, **options):
    tables = tables or load_all(spark, root)
    out, back = scratch_path(spark, "bundle"), PathTarget(scratch_path(spark, "restored"))
    export_tables(spark, tables, out, **options)
    restored = restore_tables(spark, out, back)
    copies = {t: back.read(spark, make_fqn("main", t), tables[t].schema) for t in tables}
    before = rec.fingerprints(tables).select("table_name", F.col("fingerprint").alias("f0"))
    after = rec.fingerprints(copies, FIRST)
    plain = F.regexp_extract("table_fqn", r"\[([^\]]+)\]$", 1)
    return (restored.select(plain.alias("table_name"), F.col("row_count").alias("rows_written"),
                            F.col("restored_rows").alias("rows_restored"))
            .join(before, "table_name").join(after.drop("row_count"), "table_name")
            .select("table_name", "rows_written", "rows_restored", "key_sum",
                    (F.col("fingerprint") == F.col("f0")).alias("content_equal")))


def q21_roundtrip(spark, root):
    return _roundtrip(spark, root)


def q21b_roundtrip_by_key(spark, root):
    return _roundtrip(spark, root, layout="key", chunks=PLAN_CHUNKS, chunk_threshold=PLAN_THRESHOLD)


def q21c_roundtrip_odd_columns(spark, root):
    # columns called like the folder level and the working columns of an export
    tables = {t: df.withColumns({"_part": F.col(FIRST[t]) % 7, "_Slice": F.lit("x"), "_prev": F.col(FIRST[t])})
              for t, df in load_all(spark, root).items()}
    done = _roundtrip(spark, root, tables, layout="key", chunks=PLAN_CHUNKS, chunk_threshold=PLAN_THRESHOLD)
    return done.select("table_name", "rows_restored", "key_sum", "content_equal")


def q21d_two_schemas(spark, root):
    """Two schemas that share a table name, one table excluded, its foreign keys left out of the report."""
    lines = load(spark, root, "lineitem")
    tables = {"orders": load(spark, root, "orders"), ("history", "orders"): load(spark, root, "orders").filter("o_orderstatus = 'F'"),
              "lineitem": lines, ("history", "lineitem"): lines.filter("l_linestatus = 'F'"), "part": load(spark, root, "part")}
    out, back = scratch_path(spark, "bundle"), PathTarget(scratch_path(spark, "restored"))
    export_tables(spark, tables, out, exclude=["main.part"], validate=True)
    key = lambda t: Key(t, ("o_orderkey",))
    refers = lambda name, parent, column: ForeignKey(name, "main.lineitem", (column,), parent, (column,))
    restored = restore_tables(spark, out, back, constraints=Constraints(
        (key("main.orders"), key("history.orders")),
        (refers("fk_part", "part", "l_partkey"), ForeignKey("fk_orders", "main.lineitem", ("l_orderkey",), "main.orders", ("o_orderkey",)))))
    return restored.select("table_fqn", F.col("restored_rows").alias("rows"))


def q22_schema_only(spark, root):
    tables = load_all(spark, root)
    out = scratch_path(spark, "schemas")
    export_tables(spark, tables, out, schema_only=True)
    opened = bd.open_bundle(spark, out)
    kept = {make_fqn("main", t): opened.schemas[make_fqn("main", t)] == df.schema for t, df in tables.items()}
    same = small_frame(spark, kept.items(), "table_fqn string, same_columns boolean")
    listed = opened.tables.select("table_fqn", F.col("row_count").alias("bundle_rows"), F.lit("schema only").alias("entry"))
    loaded = inventory(tables).select("table_fqn", F.col("row_count").alias("bundle_rows"), F.lit("loaded").alias("entry"))
    return loaded.unionByName(listed).join(same, "table_fqn")


def q22c_identity(spark, root):
    """Identity columns and rows as the manifest of an export lists them."""
    tables = {t: df.select(*[F.col(c).alias(c, metadata={"identity": c == FIRST[t] and t in ("orders", "part")}) for c in df.columns])
              for t, df in load_all(spark, root).items() if t in ("orders", "part", "nation")}
    out = scratch_path(spark, "bundle")
    export_tables(spark, tables, out)
    return bd.open_bundle(spark, out).tables.select(
        "table_fqn", "row_count", "has_identity", F.concat_ws(",", "identity_columns").alias("identity_columns"))


def _parts(spark, root):
    """Per-part rows of three tables under three strategies, as an export would report them."""
    plans = []
    for table, make in (("orders", chunking.range_plan), ("lineitem", chunking.ntile_plan)):
        df = load(spark, root, table)
        plans.append((table, df, make(df, FIRST[table], CHUNKS)))
    plans.append(("events", load(spark, root, "events"), chunking.modulo_plan("user_id", CHUNKS)))
    frames = []
    for table, df, plan in plans:
        counts = chunking.part_counts(df, plan).withColumn("table_fqn", F.lit(make_fqn("main", table)))
        frames.append(counts.withColumn("path", part_path("table_fqn", F.col("part"))))
    return reduce(lambda a, b: a.unionByName(b), frames)


def q22b_merge_parts(spark, root):
    merged = rec.merge_parts(_parts(spark, root))
    return merged.withColumn("file_names", F.concat_ws(",", "file_names"))


def q23_reconcile(spark, root):
    tables = load_all(spark, root)
    parts = [chunking.part_counts(df, chunking.modulo_plan(FIRST[t], CHUNKS)).select(
        F.lit(t).alias("table_name"), F.col("part"), F.lit("").alias("path"), "rows") for t, df in tables.items()]
    archive = rec.merge_parts(reduce(lambda a, b: a.unionByName(b), parts), "table_name")
    return rec.reconcile(archive, inventory(tables), "table_name")


def q23b_reconcile_keys(spark, root):
    per_order = load(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.count(F.lit(1)).alias("row_count"))
    # customer keys stand for the live side: most order keys are unknown there, some have other counts
    live = load(spark, root, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("row_count"))
    return rec.reconcile(per_order, live, "k")


def q24_collisions(spark, root):
    part = load(spark, root, "part").select(
        F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_")).alias("s"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("t"))
    fqns = part.select(F.explode(F.array(
        F.concat(F.lit("["), "s", F.lit("].["), "t", F.lit("]")),
        F.concat(F.lit("[brand].["), F.substring_index("s", "_", -1), F.lit("_"), "t", F.lit("]")))).alias("table_fqn"))
    return rec.stem_collisions(fqns)


def q25_manifest_check(spark, root):
    out = scratch_path(spark, "bundle")
    export_tables(spark, load_all(spark, root), out, validate=True)
    opened = bd.open_bundle(spark, out)
    problems = bd.manifest_problems(opened.manifest).count()
    return bd.check_bundle(spark, opened).withColumn("manifest_problems", F.lit(problems).cast("bigint"))


QUERIES = {f.__name__: f for f in (
    q21_roundtrip, q21b_roundtrip_by_key, q21c_roundtrip_odd_columns, q21d_two_schemas, q22_schema_only, q22b_merge_parts, q22c_identity, q23_reconcile,
    q23b_reconcile_keys, q24_collisions, q25_manifest_check)}

_ROUNDTRIP = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_written, count(*) AS rows_restored, "
    f"CAST(sum({FIRST[t]}) AS BIGINT) AS key_sum, true AS content_equal FROM {t}" for t in TABLES)
_FQN = "'[main].[{t}]'"

ORACLES = {
    "q21_roundtrip": _ROUNDTRIP,
    "q21b_roundtrip_by_key": _ROUNDTRIP,
    "q21c_roundtrip_odd_columns": f"SELECT table_name, rows_restored, key_sum, content_equal FROM ({_ROUNDTRIP})",
    "q21d_two_schemas": """SELECT '[main].[orders]' AS table_fqn, count(*) AS rows FROM orders
        UNION ALL SELECT '[history].[orders]', count(*) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT '[main].[lineitem]', count(*) FROM lineitem
        UNION ALL SELECT '[history].[lineitem]', count(*) FROM lineitem WHERE l_linestatus = 'F'""",
    "q22_schema_only": " UNION ALL ".join(
        f"SELECT '[main].[{t}]' AS table_fqn, count(*) AS bundle_rows, 'loaded' AS entry, true AS same_columns FROM {t} "
        f"UNION ALL SELECT '[main].[{t}]', 0, 'schema only', true" for t in TABLES),
    "q22c_identity": " UNION ALL ".join(
        f"SELECT '[main].[{t}]' AS table_fqn, count(*) AS row_count, {t != 'nation'} AS has_identity, "
        f"'{'' if t == 'nation' else FIRST[t]}' AS identity_columns FROM {t}" for t in ("orders", "part", "nation")),
    "q22b_merge_parts": f"""WITH ob AS (SELECT min(o_orderkey) lo, max(o_orderkey) hi FROM orders),
        os AS (SELECT lo, CAST(ceil((hi - lo + 1) / {CHUNKS}.0) AS BIGINT) AS size FROM ob),
        t AS (SELECT l_orderkey AS k, ntile({CHUNKS}) OVER (ORDER BY l_orderkey) AS bk FROM lineitem),
        f AS (SELECT k, min(bk) - 1 AS part FROM t GROUP BY k),
        p AS (SELECT 'orders' AS t, (o_orderkey - lo) // size AS part FROM orders, os
              UNION ALL SELECT 'lineitem', f.part FROM t JOIN f USING (k)
              UNION ALL SELECT 'events', abs(user_id % {CHUNKS}) FROM events),
        g AS (SELECT t, part, count(*) AS rows FROM p GROUP BY ALL)
        SELECT '[main].[' || t || ']' AS table_fqn, CAST(sum(rows) AS BIGINT) AS row_count, count(*) AS parts,
        string_agg('data/main_' || t || '.part' || part || '.parquet', ',' ORDER BY part) AS file_names
        FROM g GROUP BY t""",
    "q23_reconcile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS archive_rows, count(*) AS live_rows, 'OK' AS status FROM {t}"
        for t in TABLES),
    "q23b_reconcile_keys": """WITH a AS (SELECT l_orderkey AS k, count(*) AS archive_rows FROM lineitem GROUP BY 1),
        l AS (SELECT o_custkey AS k, count(*) AS live_rows FROM orders GROUP BY 1)
        SELECT k, archive_rows, live_rows, CASE WHEN archive_rows IS NULL THEN 'MISSING_IN_ARCHIVE'
        WHEN live_rows IS NULL THEN 'MISSING_IN_LIVE' WHEN archive_rows <> live_rows THEN 'MISMATCH'
        ELSE 'OK' END AS status FROM a FULL JOIN l USING (k)""",
    "q24_collisions": """WITH p AS (SELECT replace(lower(p_brand), '#', '_') AS s, replace(p_name, ' ', '_') AS t FROM part),
        n AS (SELECT '[' || s || '].[' || t || ']' AS fqn FROM p
              UNION SELECT '[brand].[' || split_part(s, '_', 2) || '_' || t || ']' FROM p),
        k AS (SELECT fqn, trim(replace(replace(replace(fqn, '[', ''), ']', ''), '.', '_'), '_') AS stem FROM n)
        SELECT stem, min(fqn) AS first_fqn, max(fqn) AS last_fqn, count(*) AS tables
        FROM k GROUP BY stem HAVING count(*) > 1""",
    "q25_manifest_check": " UNION ALL ".join(
        f"SELECT '[main].[{t}]' AS table_fqn, CAST(1 AS INTEGER) AS parts_listed, CAST(0 AS BIGINT) AS parts_missing, "
        f"count(*) AS row_count, count(*) AS stored_rows, true AS ok, CAST(0 AS BIGINT) AS manifest_problems FROM {t}"
        for t in TABLES),
}
