"""Inventory, dictionary, profiles and export plans over all tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators.constraints import with_computed
from ..plans import dictionary as dd, inventory as inv
from ..session import pinned
from .common import TABLES, load, load_all
from .declared import CHECKS, COLUMNS, COMPUTED, CONSTRAINTS, FOREIGN_KEYS, KEYS, TYPE_TEXT

EXCLUDED = ("part*", "main.e[mv]*", "?egion", "*s[!t]")
PLAN_THRESHOLD, PLAN_LOB_BYTES, PLAN_CHUNKS = 200, 300, 8


def q11_inventory(spark, root):
    return inv.inventory(load_all(spark, root))


def q11b_inventory_totals(spark, root):
    return inv.inventory_totals(inv.inventory(load_all(spark, root)), large_rows=5_000)


def q11c_two_schemas(spark, root):
    tables = load_all(spark, root)
    listing = inv.inventory(tables).unionByName(inv.inventory(
        {t: tables[t].filter(F.col(COLUMNS[t][0][0]) < 100) for t in ("orders", "lineitem", "events")}, "history"))
    return inv.inventory_totals(listing, large_rows=5_000)


def q12_dictionary(spark, root):
    tables = load_all(spark, root)
    described = dd.describe(inv.dictionary(tables), dd.key_columns(spark, CONSTRAINTS),
                            dd.foreign_key_columns(spark, CONSTRAINTS))
    counted = inv.column_profile(tables).select("table_name", "column_name", "rows", "nulls")
    return described.join(counted, ["table_name", "column_name"])


def q12b_largest(spark, root):
    return inv.largest_table(inv.inventory(load_all(spark, root))).select("table_name", "row_count")


def q12c_star_joins(spark, root):
    nation = load(spark, root, "nation")
    buyer = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("buyer_nation"))
    seller = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller_nation"))
    orders = load(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                F.col("o_custkey").alias("c_custkey"))
    suppliers = load(spark, root, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return (
        load(spark, root, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
        .join(suppliers.join(seller, "s_nationkey"), "l_suppkey")
        .join(orders, "l_orderkey")
        .join(load(spark, root, "customer").select("c_custkey", "c_nationkey").join(buyer, "c_nationkey"), "c_custkey")
        .groupBy("buyer_nation", "seller_nation")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))
    )


def q12d_left_residual(spark, root):
    # an outer join cannot split a frequent key of its optional side, so lines are counted per key first
    orders = load(spark, root, "orders")
    lines = load(spark, root, "lineitem").groupBy("l_orderkey", "l_shipdate").agg(F.count(F.lit(1)).alias("n"))
    joined = orders.join(
        lines, (orders.o_orderkey == lines.l_orderkey) & (lines.l_shipdate != orders.o_orderdate)
        & (lines.l_shipdate > orders.o_orderdate), "left")
    return joined.groupBy("o_orderpriority").agg(
        F.sum(F.coalesce("n", F.lit(1))).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("late_lines"),
        F.count_if(F.col("l_orderkey").isNull()).alias("orders_without"))


def q12e_key_listing(spark, root):
    listing = inv.inventory(load_all(spark, root))
    keys = dd.key_columns(spark, CONSTRAINTS)
    single = dd.single_column_keys(keys).select("table_name", F.lit(True).alias("single"))
    return (dd.key_listing(keys, listing).join(single, "table_name", "left")
            .join(listing.select("table_name", "row_count"), "table_name")
            .select("table_name", "key_columns", F.coalesce("single", F.lit(False)).alias("single"), "row_count"))


def q12f_foreign_key_listing(spark, root):
    listing = inv.inventory(load_all(spark, root)).select("table_name", "row_count")
    child = listing.withColumnsRenamed({"table_name": "child", "row_count": "child_rows"})
    parent = listing.withColumnsRenamed({"table_name": "parent", "row_count": "parent_rows"})
    return (dd.foreign_key_listing(dd.foreign_key_columns(spark, CONSTRAINTS))
            .join(child, "child").join(parent, "parent"))


def q12g_computed_listing(spark, root):
    target = {"lineitem": with_computed(load(spark, root, "lineitem"), COMPUTED)}
    listed = dd.computed_listing(spark, inv.dictionary(target), {"lineitem": COMPUTED})
    known = target["lineitem"].agg(*[F.count(c).alias(c) for c in COMPUTED])
    counts = known.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).alias("known_rows")) for c in COMPUTED])))
    return listed.join(counts, "name")


def q12h_check_listing(spark, root):
    listing = inv.inventory(load_all(spark, root)).filter("table_name <> 'events'")
    checks = dd.check_listing(dd.check_rows(spark, CONSTRAINTS), listing)
    return checks.join(listing.select("table_name", "row_count"), "table_name")


def q13_exclude(spark, root):
    kept = inv.exclude(inv.inventory(load_all(spark, root)), EXCLUDED)
    return kept.select("table_name", "row_count")


def q14_plan(spark, root):
    tables = load_all(spark, root)
    profile = pinned(inv.column_profile(tables))
    return inv.plan_rows(inv.inventory(tables), inv.key_profile(tables, profile),
                         inv.lob_profile(profile, PLAN_LOB_BYTES), PLAN_CHUNKS, PLAN_THRESHOLD)


def q14b_plan_of_an_export(spark, root):
    return inv.plan_tables(load_all(spark, root), PLAN_CHUNKS, PLAN_THRESHOLD, KEYS, lean=True).select(
        "table_name", "row_count", "chunk_key", "indexed", "strategy")


def q14c_export_order(spark, root):
    plan = inv.plan_tables(load_all(spark, root), PLAN_CHUNKS, PLAN_THRESHOLD, KEYS, lean=True)
    # one row per table, numbered in the order an export takes them
    placed = inv.export_order(plan).select("table_name", F.monotonically_increasing_id().alias("at"))
    return placed.join(plan.select("table_name", "row_count"), "table_name").select(
        "table_name", "row_count", F.row_number().over(Window.orderBy("at")).alias("position"))


def q15_key_profile(spark, root):
    return inv.key_profile(load_all(spark, root))


def q16_lob_profile(spark, root):
    return inv.lob_profile(inv.column_profile(load_all(spark, root)))


def q16_sample(spark, root):
    df = load(spark, root, "lineitem")
    return inv.sample(df, max_rows=1000, order_by=df.columns[:5])


QUERIES = {f.__name__: f for f in (
    q11_inventory, q11b_inventory_totals, q11c_two_schemas, q12_dictionary, q12b_largest, q12c_star_joins, q12d_left_residual,
    q12e_key_listing, q12f_foreign_key_listing, q12g_computed_listing,
    q12h_check_listing, q13_exclude, q14_plan, q14b_plan_of_an_export, q14c_export_order, q15_key_profile, q16_lob_profile,
    q16_sample)}

_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i} AS ordinal, {len(COLUMNS[t])} AS column_count, count(*) AS row_count FROM {t}"
    for i, t in enumerate(TABLES))


def _key_position(table, column):
    key = next(k for k in KEYS if k.table == table)
    return f"{key.columns.index(column)}" if column in key.columns else "CAST(NULL AS INTEGER)"


def _referenced(table, column):
    for fk in FOREIGN_KEYS:
        if fk.child == table and column in fk.child_cols:
            return f"'{fk.parent}.{fk.parent_cols[fk.child_cols.index(column)]}'"
    return "CAST(NULL AS VARCHAR)"


_DICTIONARY = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, {i} AS ordinal, '{c}' AS column_name, '{TYPE_TEXT[k]}' AS declared_type,
    {_key_position(t, c)} AS key_position, {_referenced(t, c)} AS referenced, count(*) AS rows,
    count(*) - count({c}) AS nulls FROM {t}"""
    for t, cols in COLUMNS.items() for i, (c, k) in enumerate(cols))
_KEY_STATS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS ordinal, count(*) AS rows,
    count(*) - count({c}) AS nulls, CAST(min({c}) AS BIGINT) AS lo, CAST(max({c}) AS BIGINT) AS hi,
    count(DISTINCT {c}) = count(*) AS is_unique FROM {t}"""
    for t, cols in COLUMNS.items() for i, (c, k) in enumerate(cols) if k in "ib")
_KEY_PROFILE = f"""SELECT *, CAST(row_number() OVER (PARTITION BY table_name
    ORDER BY NOT is_unique, nulls > 0, ordinal) AS INTEGER) AS key_rank FROM ({_KEY_STATS})"""


def _lob_sql(limit):
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(max(strlen({c})) AS BIGINT) AS max_bytes,
        max(strlen({c})) > {limit} AS is_lob FROM {t}"""
        for t, cols in COLUMNS.items() for c, k in cols if k == "s")


def _plan_key(table):
    """The declared single-column key, else the first integer column."""
    return COLUMNS[table][0][0]


_KEY_TEXT = " UNION ALL ".join(
    f"SELECT '{k.table}' AS table_name, '{', '.join(c + ' ASC' for c in k.columns)}' AS key_columns, "
    f"{str(len(k.columns) == 1).upper()} AS single, count(*) AS row_count FROM {k.table}" for k in KEYS)
_ACTION = {"CASCADE": "CASCADE", "SET_NULL": "SET NULL", "NO_ACTION": ""}
_FK_TEXT = " UNION ALL ".join(
    f"""SELECT '{fk.name}' AS fk, '{fk.child}' AS child, '{fk.parent}' AS parent,
    '{', '.join(a + '=' + b for a, b in zip(fk.child_cols, fk.parent_cols))}' AS column_pairs,
    '{_ACTION[fk.on_delete]}' AS on_delete, '{_ACTION[fk.on_update]}' AS on_update,
    (SELECT count(*) FROM {fk.child}) AS child_rows, (SELECT count(*) FROM {fk.parent}) AS parent_rows"""
    for fk in FOREIGN_KEYS)

ORACLES = {
    "q11_inventory": f"""SELECT 'main' AS schema_name, table_name, ordinal, column_count, row_count,
        '[main].[' || table_name || ']' AS table_fqn FROM ({_COUNTS})""",
    "q11b_inventory_totals": f"""SELECT count(*) AS tables, CAST(1 AS BIGINT) AS schemas,
        CAST(sum(row_count) AS BIGINT) AS total_rows, count(*) FILTER (WHERE row_count > 5000) AS large_tables
        FROM ({_COUNTS})""",
    "q11c_two_schemas": f"""WITH l AS (SELECT 'main' AS schema_name, row_count FROM ({_COUNTS}) UNION ALL
        SELECT 'history', count(*) FROM orders WHERE o_orderkey < 100 UNION ALL
        SELECT 'history', count(*) FROM lineitem WHERE l_orderkey < 100 UNION ALL
        SELECT 'history', count(*) FROM events WHERE event_id < 100)
        SELECT count(*) AS tables, count(DISTINCT schema_name) AS schemas, CAST(sum(row_count) AS BIGINT) AS total_rows,
        count(*) FILTER (WHERE row_count > 5000) AS large_tables FROM l""",
    "q12h_check_listing": " UNION ALL ".join(
        f"""SELECT '{c.table}' AS table_name, '{c.name}' AS name, '{c.condition}' AS condition, {c.disabled} AS is_disabled,
        {c.untrusted} AS is_not_trusted, count(*) AS row_count FROM {c.table}""" for c in CHECKS if c.table != "events"),
    "q14c_export_order": f"""SELECT table_name, row_count, CAST(row_number() OVER (
        ORDER BY row_count < {PLAN_THRESHOLD}, ordinal) AS INTEGER) AS position FROM ({_COUNTS})""",
    "q12_dictionary": _DICTIONARY,
    "q12b_largest": f"SELECT table_name, row_count FROM ({_COUNTS}) ORDER BY row_count DESC, ordinal LIMIT 1",
    "q12c_star_joins": """SELECT b.n_name AS buyer_nation, s.n_name AS seller_nation, count(*) AS rows,
        sum(l_quantity) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation b ON c_nationkey = b.n_nationkey JOIN nation s ON s_nationkey = s.n_nationkey
        GROUP BY ALL""",
    "q12d_left_residual": """SELECT o_orderpriority, count(*) AS rows, count(l_orderkey) AS late_lines,
        count(*) - count(l_orderkey) AS orders_without
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate > o_orderdate GROUP BY 1""",
    "q12e_key_listing": _KEY_TEXT,
    "q12f_foreign_key_listing": _FK_TEXT,
    "q12g_computed_listing": " UNION ALL ".join(
        f"SELECT 'lineitem' AS table_name, '{c}' AS name, '{text.replace(chr(39), chr(39) * 2)}' AS definition, "
        f"{11 + i} AS ordinal, '{kind}' AS sql_type, count(*) AS known_rows FROM lineitem"
        for i, ((c, text), kind) in enumerate(zip(COMPUTED.items(), ("double", "int", "string")))),
    "q13_exclude": f"""SELECT table_name, row_count FROM ({_COUNTS})
        WHERE NOT (table_name LIKE 'part%' OR table_name LIKE 'em%' OR table_name LIKE 'ev%'
        OR table_name LIKE '_egion' OR regexp_full_match(table_name, '.*s[^t]'))""",
    "q14_plan": f"""WITH c AS ({_COUNTS}), k AS (SELECT * FROM ({_KEY_PROFILE}) WHERE key_rank = 1 AND nulls = 0),
        l AS (SELECT table_name, bool_or(is_lob) AS has_lob FROM ({_lob_sql(PLAN_LOB_BYTES)}) GROUP BY 1),
        j AS (SELECT c.table_name, c.ordinal, row_count, k.column_name AS chunk_key,
            coalesce(is_unique, false) AS indexed, coalesce(has_lob, false) AS has_lob, lo, hi
            FROM c LEFT JOIN k USING (table_name) LEFT JOIN l USING (table_name)),
        p AS (SELECT *, CASE WHEN chunk_key IS NULL OR row_count < {PLAN_THRESHOLD} THEN 'single'
            WHEN NOT indexed AND has_lob THEN 'ntile' WHEN NOT indexed THEN 'modulo'
            WHEN lo >= hi THEN 'single' ELSE 'range' END AS strategy FROM j)
        SELECT table_name, ordinal, row_count, chunk_key, lo, hi, indexed, has_lob, strategy,
            CASE WHEN strategy = 'single' THEN 1 ELSE {PLAN_CHUNKS} END AS chunks,
            has_lob AND strategy IN ('range', 'ntile') AS lob_range FROM p""",
    "q14b_plan_of_an_export": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS row_count, CASE WHEN count(*) >= {PLAN_THRESHOLD} THEN '{_plan_key(t)}' END AS chunk_key,
        count(*) >= {PLAN_THRESHOLD} AND {_plan_key(t) == cols[0][0] and t not in ('lineitem', 'conversations')} AS indexed,
        CASE WHEN count(*) < {PLAN_THRESHOLD} THEN 'single' WHEN {t not in ('lineitem', 'conversations')} THEN 'range' ELSE 'modulo' END AS strategy FROM {t}"""
        for t, cols in COLUMNS.items()),
    "q15_key_profile": _KEY_PROFILE,
    "q16_lob_profile": _lob_sql(8000),
    "q16_sample": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
        ORDER BY ALL LIMIT 1000""",
}
