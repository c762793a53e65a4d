"""Keys, references, checks and computed columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bitmaps, constraints as con, difference
from ..plans.inventory import inventory, union_all
from ..session import small_frame
from .common import load, load_all
from .declared import CHECKS, COMPUTED, CONSTRAINTS


def q26_pk(spark, root):
    return con.key_violations(load(spark, root, "lineitem"), ("l_orderkey", "l_linenumber"))


def q26b_pk_null(spark, root):
    # a status of 'P' becomes NULL: every key tuple holding one is a violation
    orders = load(spark, root, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return con.key_violations(orders, ("o_orderkey", "status"))


def q23c_located_differences(spark, root):
    """A copy of lineitem with changed, lost and doubled rows; the keys are found again."""
    lines, k = load(spark, root, "lineitem"), F.col("l_orderkey")
    copy = lines.where(k % 1009 != 3).withColumn("l_quantity", F.when(k % 997 == 5, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return difference.locate_differences(lines, copy.unionByName(copy.where(k % 1013 == 7)), "l_orderkey")


def q26c_key_counts(spark, root):
    """Rows and different keys of integer columns; unique where they are the same."""
    wanted = [("orders", "o_orderkey"), ("customer", "c_custkey"), ("lineitem", "l_orderkey"), ("events", "user_id"), ("documents", "doc_id")]
    return union_all([bitmaps.key_counts(load(spark, root, t), c).select(
        F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "rows", "keys") for t, c in wanted])


def q26d_repeated_keys(spark, root):
    return bitmaps.repeated_keys(load(spark, root, "lineitem"), "l_orderkey")


def q28c_orphans_by_bitmap(spark, root):
    """Lines whose order is not among the finished ones."""
    finished = load(spark, root, "orders").where("o_orderstatus = 'F'")
    return bitmaps.orphans(load(spark, root, "lineitem"), "l_orderkey", finished, "o_orderkey")


def q27_unique(spark, root):
    orders = load(spark, root, "orders").select(
        "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return con.key_violations(orders, ("o_custkey", "status"), primary=False)


def q28_fk_orphans(spark, root):
    return con.orphan_keys(load(spark, root, "orders"), ("o_orderkey",),
                           load(spark, root, "lineitem"), ("l_orderkey",))


def q28b_fk_composite(spark, root):
    lines = load(spark, root, "lineitem")
    child = lines.filter("l_linestatus = 'F'").select(
        F.nullif("l_partkey", F.lit(0)).alias("l_partkey"), "l_suppkey")
    return con.orphan_keys(child, ("l_partkey", "l_suppkey"),
                           lines.filter("l_linestatus = 'O'"), ("l_partkey", "l_suppkey"))


def q29_checks(spark, root):
    line_checks = {c.name: c.condition for c in CHECKS if c.table == "lineitem"}
    line_checks["ck_finite"] = con.finite_condition("l_extendedprice")
    return con.check_counts(load(spark, root, "lineitem"), line_checks)


def q29b_check_rows(spark, root):
    failing = con.check_violations(load(spark, root, "lineitem"), "nullif(l_tax, 0.0) > 0.01")
    return failing.select("l_orderkey", "l_linenumber", "l_tax")


def q30_not_null(spark, root):
    lines = load(spark, root, "lineitem").withColumns({
        "l_returnflag": F.nullif("l_returnflag", F.lit("N")), "l_tax": F.nullif("l_tax", F.lit(0.0)),
        "l_linenumber": F.nullif("l_linenumber", F.lit(7))})
    return con.null_counts(lines)


def q31_computed(spark, root):
    lines = load(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag", "l_linestatus")
    return con.with_computed(lines, COMPUTED).select("l_orderkey", "l_linenumber", *COMPUTED)


def q32_report(spark, root):
    return con.constraint_report(load_all(spark, root), CONSTRAINTS)


def q33_retain(spark, root):
    orders, customers = load(spark, root, "orders"), load(spark, root, "customer")
    order_name = F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"))
    edges = orders.select(order_name.alias("child"),
                          F.concat(F.lit("customer/"), F.col("o_custkey").cast("string")).alias("parent"))
    kept = orders.filter("o_orderstatus = 'F'").select(order_name.alias("name")).unionByName(
        customers.filter("c_mktsegment <> 'BUILDING'").select(
            F.concat(F.lit("customer/"), F.col("c_custkey").cast("string")).alias("name")))
    return con.retained(edges, kept)


def q33b_retained_constraints(spark, root):
    """Checks whose table is kept; with the rows they stand on."""
    listing = inventory(load_all(spark, root)).filter("row_count > 5000 AND table_name <> 'events'")
    rows = [(c.name, c.table, c.condition) for c in CHECKS]
    checks = small_frame(spark, rows, "name string, table_name string, condition string")
    kept = con.retained_constraints(checks, listing.select("table_name", "row_count"), name="table_name")
    return kept.join(listing.select("table_name", "row_count"), "table_name")


QUERIES = {f.__name__: f for f in (
    q23c_located_differences, q26_pk, q26b_pk_null, q26c_key_counts, q26d_repeated_keys, q28c_orphans_by_bitmap, q27_unique, q28_fk_orphans, q28b_fk_composite, q29_checks, q29b_check_rows,
    q30_not_null, q31_computed, q32_report, q33_retain, q33b_retained_constraints)}

_LINE_NULLS = {"l_returnflag": "nullif(l_returnflag, 'N')", "l_tax": "nullif(l_tax, 0)",
               "l_linenumber": "nullif(l_linenumber, 7)"}


def _report():
    out = []
    row = ("SELECT {seq} AS seq, '{kind}' AS kind, '{table}' AS table_name, '{name}' AS constraint_name, "
           "{violations} AS violations, {status} AS status")
    for k in CONSTRAINTS.keys:
        cols = ", ".join(k.columns)
        out.append(row.format(
            seq=0, kind="PRIMARY KEY", table=k.table, name="_".join((k.table, *k.columns)), status="''",
            violations=f"(SELECT count(*) FROM (SELECT 1 FROM {k.table} GROUP BY {cols} HAVING count(*) > 1))"))
    for c in CHECKS:
        skip = c.disabled or c.untrusted
        out.append(row.format(
            seq=2, kind="CHECK", table=c.table, name=c.name, status="'SKIPPED'" if skip else "''",
            violations="CAST(NULL AS BIGINT)" if skip else
            f"(SELECT count(*) FROM {c.table} WHERE NOT coalesce({c.condition}, true))"))
    for table, cols in CONSTRAINTS.not_null.items():
        for c in cols:
            out.append(row.format(seq=3, kind="NOT NULL", table=table, name=c, status="''",
                                  violations=f"(SELECT count(*) - count({c}) FROM {table})"))
    for fk in CONSTRAINTS.foreign_keys:
        out.append(row.format(
            seq=4, kind="FOREIGN KEY", table=fk.child, name=fk.name, status="''",
            violations=f"(SELECT count(*) FROM {fk.child} a ANTI JOIN {fk.parent} b "
                       f"ON a.{fk.child_cols[0]} = b.{fk.parent_cols[0]})"))
    return (f"SELECT seq, kind, table_name, constraint_name, violations, CASE WHEN status <> '' THEN status "
            f"WHEN violations = 0 THEN 'OK' ELSE 'VIOLATED' END AS status FROM ({' UNION ALL '.join(out)})")


ORACLES = {
    "q23c_located_differences": """WITH changed AS (SELECT * REPLACE (CASE WHEN l_orderkey % 997 = 5 THEN l_quantity + 1 ELSE l_quantity END
                AS l_quantity) FROM lineitem WHERE l_orderkey % 1009 <> 3),
        copy AS (FROM changed UNION ALL FROM changed WHERE l_orderkey % 1013 = 7),
        n AS (SELECT l_orderkey, md5(CAST(x AS VARCHAR)) AS h, count(*) FILTER (side = 0) AS l, count(*) FILTER (side = 1) AS r
              FROM (SELECT l_orderkey, lineitem AS x, 0 AS side FROM lineitem UNION ALL SELECT l_orderkey, copy, 1 FROM copy) GROUP BY ALL),
        d AS (SELECT l_orderkey, CAST(sum(greatest(l - r, 0)) AS BIGINT) AS missing, CAST(sum(greatest(r - l, 0)) AS BIGINT) AS extra,
                     count(*) FILTER (r > l AND l = 0) AS new FROM n GROUP BY 1)
        SELECT l_orderkey, missing, extra, CASE WHEN missing > 0 AND extra > 0 THEN 'changed' WHEN missing > 0 THEN 'lost'
            WHEN new = 0 THEN 'doubled' ELSE 'added' END AS kind FROM d WHERE missing > 0 OR extra > 0""",
    "q26c_key_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS rows, count(DISTINCT {c}) AS keys FROM {t}"
        for t, c in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("lineitem", "l_orderkey"), ("events", "user_id"),
                     ("documents", "doc_id"))),
    "q26d_repeated_keys": "SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "q28c_orphans_by_bitmap": """SELECT l_orderkey, count(*) AS child_rows FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
    "q26_pk": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "q26b_pk_null": """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, count(*) AS copies FROM orders
        GROUP BY ALL HAVING count(*) > 1 OR status IS NULL""",
    "q27_unique": """SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, count(*) AS copies FROM orders
        GROUP BY ALL HAVING count(*) > 1""",
    "q28_fk_orphans": """SELECT o_orderkey, count(*) AS child_rows FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY 1""",
    "q28b_fk_composite": """SELECT c.l_partkey, c.l_suppkey, count(*) AS child_rows FROM lineitem c
        WHERE c.l_linestatus = 'F' AND c.l_partkey <> 0 AND NOT EXISTS (SELECT 1 FROM lineitem p
        WHERE p.l_linestatus = 'O' AND p.l_partkey = c.l_partkey AND p.l_suppkey = c.l_suppkey) GROUP BY ALL""",
    "q29_checks": " UNION ALL ".join(
        [f"SELECT '{c.name}' AS constraint_name, count(*) AS violations FROM lineitem "
         f"WHERE NOT coalesce({c.condition}, true)" for c in CHECKS if c.table == "lineitem"]
        + ["SELECT 'ck_finite', count(*) FROM lineitem WHERE NOT isfinite(l_extendedprice)"]),
    "q29b_check_rows": """SELECT l_orderkey, l_linenumber, l_tax FROM lineitem
        WHERE NOT coalesce(nullif(l_tax, 0) > 0.01, true)""",
    "q30_not_null": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({_LINE_NULLS.get(c, c)}) AS nulls FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")),
    "q31_computed": """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price,
        CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS lead_days,
        l_returnflag || '/' || l_linestatus AS line_label FROM lineitem""",
    "q32_report": _report(),
    "q33b_retained_constraints": " UNION ALL ".join(
        f"SELECT '{c.table}' AS table_name, '{c.name}' AS name, '{c.condition}' AS condition, count(*) AS row_count "
        f"FROM {c.table} HAVING count(*) > 5000" for c in CHECKS if c.table != "events"),
    "q33_retain": """SELECT 'orders/' || o_orderkey AS child, 'customer/' || o_custkey AS parent
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'F' AND c_mktsegment <> 'BUILDING'""",
}
