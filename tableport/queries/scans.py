"""Scans, chunk predicates and chunk plans over lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import chunking, order_stats
from ..plans.inventory import union_all
from ..session import small_frame
from ..sources.tables import footer_bounds, full_scan, table_path
from .common import CHUNKS, load

COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
KEY = "l_orderkey"
ROW = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


def _signed(df):
    # a key with both signs, so the remainder's sign matters
    return df.withColumn("signed_key", F.col("l_orderkey") - F.col("l_partkey") * 5)


def q01_scan_full(spark, root):
    return full_scan(load(spark, root, "lineitem"), COLUMNS)


def q02_range_chunk(spark, root):
    df = load(spark, root, "lineitem").select(*ROW)
    return chunking.with_part(df, chunking.range_plan(df, KEY, CHUNKS), "part")


def q03_modulo_chunk(spark, root):
    df = _signed(load(spark, root, "lineitem").select(*ROW))
    return chunking.with_part(df, chunking.modulo_plan("signed_key", CHUNKS), "part")


def q04_minmax(spark, root):
    return chunking.key_bounds(load(spark, root, "lineitem"), KEY)


def q04b_footer_minmax(spark, root):
    lo, hi, known, rows = footer_bounds(spark, table_path(root, "lineitem"), KEY)
    return small_frame(spark, [(lo, hi, known, rows)], "lo bigint, hi bigint, known bigint, rows bigint")


def q05_range_plan(spark, root):
    return chunking.range_table(load(spark, root, "lineitem"), KEY, CHUNKS)


def q06_range_counts(spark, root):
    bounds = footer_bounds(spark, table_path(root, "lineitem"), KEY)
    df = load(spark, root, "lineitem")
    return chunking.part_counts(df, chunking.range_plan(df, KEY, CHUNKS, bounds))


def q07_modulo_counts(spark, root):
    return chunking.part_counts(_signed(load(spark, root, "lineitem")),
                                chunking.modulo_plan("signed_key", CHUNKS))


def q08_ntile_bounds(spark, root):
    edges = order_stats.ntile_edges(load(spark, root, "lineitem"), KEY, CHUNKS)
    rows = [(bucket, *edge) for bucket, edge in enumerate(edges, start=1)]
    return small_frame(spark, rows, "bucket int, lo bigint, hi bigint, rows bigint")


def q09_ntile_disjoint(spark, root):
    plan = chunking.ntile_plan(load(spark, root, "lineitem"), KEY, CHUNKS)
    rows = [(part, lo, hi) for part, (lo, hi) in enumerate(plan.ranges)]
    return small_frame(spark, rows, "part int, lo bigint, hi bigint")


def q10_ntile_counts(spark, root):
    df = load(spark, root, "lineitem")
    return chunking.part_counts(df, chunking.ntile_plan(df, KEY, CHUNKS))


def q10b_cover(spark, root):
    df = load(spark, root, "lineitem")
    plans = [chunking.range_plan(df, KEY, CHUNKS), chunking.modulo_plan(KEY, CHUNKS),
             chunking.ntile_plan(df, KEY, CHUNKS)]
    proofs = [chunking.cover(df, chunking.part_conditions(p)).withColumn("strategy", F.lit(p.strategy))
              for p in plans]
    return proofs[0].unionByName(proofs[1]).unionByName(proofs[2])


def q03b_predicate_scans(spark, root):
    """Every part of three plans read by its own predicate; together they are the whole tables."""
    frames = []
    for table, key, make in (("lineitem", "l_orderkey", chunking.range_plan), ("orders", "o_custkey", chunking.ntile_plan),
                             ("events", "user_id", lambda df, key, n: chunking.modulo_plan(key, n))):
        df = load(spark, root, table)
        for i, condition in enumerate(chunking.part_conditions(make(df, key, CHUNKS))):
            frames.append(df.filter(condition).agg(F.count(F.lit(1)).alias("rows"), F.sum(key).alias("key_sum")).select(
                F.lit(table).alias("table_name"), F.lit(i).alias("part"), "rows", "key_sum"))
    return union_all(frames).groupBy("table_name").agg(
        F.count_if(F.col("rows") > 0).alias("parts"), F.sum("rows").alias("rows"), F.sum("key_sum").alias("key_sum"))


QUERIES = {f.__name__: f for f in (
    q01_scan_full, q02_range_chunk, q03_modulo_chunk, q03b_predicate_scans, q04_minmax, q04b_footer_minmax, q05_range_plan, q06_range_counts,
    q07_modulo_counts, q08_ntile_bounds, q09_ntile_disjoint, q10_ntile_counts, q10b_cover)}

_RANGE = f"""
WITH b AS (SELECT min({KEY}) lo, max({KEY}) hi FROM lineitem),
s AS (SELECT lo, hi, CAST(ceil((hi - lo + 1) / {CHUNKS}.0) AS BIGINT) AS size FROM b)
"""
_NTILE = f"""
WITH t AS (SELECT {KEY} AS k, ntile({CHUNKS}) OVER (ORDER BY {KEY}) AS bk FROM lineitem),
e AS (SELECT bk, min(k) AS lo, max(k) AS hi, count(*) AS rows FROM t GROUP BY bk)
"""
_SIGNED = "(l_orderkey - l_partkey * 5)"

ORACLES = {
    "q03b_predicate_scans": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({CHUNKS} AS BIGINT) AS parts, count(*) AS rows, CAST(sum({k}) AS BIGINT) AS key_sum FROM {t}"
        for t, k in (("lineitem", "l_orderkey"), ("orders", "o_custkey"), ("events", "user_id"))),
    "q01_scan_full": f"SELECT {', '.join(COLUMNS)} FROM lineitem",
    "q02_range_chunk": f"""{_RANGE}
        SELECT {', '.join(ROW)}, CAST(({KEY} - lo) // size AS INTEGER) AS part FROM lineitem, s""",
    "q03_modulo_chunk": f"""SELECT {', '.join(ROW)}, {_SIGNED} AS signed_key,
        CAST(abs({_SIGNED} % {CHUNKS}) AS INTEGER) AS part FROM lineitem""",
    "q04_minmax": f"""SELECT coalesce(min({KEY}), 0) AS lo, coalesce(max({KEY}), 0) AS hi FROM lineitem""",
    "q04b_footer_minmax": f"""SELECT min({KEY}) AS lo, max({KEY}) AS hi, count({KEY}) AS known,
        count(*) AS rows FROM lineitem""",
    "q05_range_plan": f"""{_RANGE}
        SELECT CAST(i AS INTEGER) AS part, lo + i * size AS lo, least(lo + (i + 1) * size - 1, hi) AS hi
        FROM s, range({CHUNKS}) r(i) WHERE lo + i * size <= hi""",
    "q06_range_counts": f"""{_RANGE}
        SELECT CAST(({KEY} - lo) // size AS INTEGER) AS part, count(*) AS rows
        FROM lineitem, s GROUP BY 1""",
    "q07_modulo_counts": f"""SELECT CAST(abs({_SIGNED} % {CHUNKS}) AS INTEGER) AS part, count(*) AS rows
        FROM lineitem GROUP BY 1""",
    "q08_ntile_bounds": f"{_NTILE} SELECT CAST(bk AS INTEGER) AS bucket, lo, hi, rows FROM e",
    "q09_ntile_disjoint": f"""{_NTILE},
        d AS (SELECT bk, greatest(lo, coalesce(lag(hi) OVER (ORDER BY bk) + 1, lo)) AS lo, hi FROM e)
        SELECT CAST(row_number() OVER (ORDER BY bk) - 1 AS INTEGER) AS part, lo, hi FROM d WHERE lo <= hi""",
    "q10_ntile_counts": f"""{_NTILE},
        f AS (SELECT k, min(bk) AS bk FROM t GROUP BY k),
        c AS (SELECT f.bk, count(*) AS rows FROM t JOIN f USING (k) GROUP BY f.bk)
        SELECT CAST(row_number() OVER (ORDER BY bk) - 1 AS INTEGER) AS part, rows FROM c""",
    "q10b_cover": """SELECT s AS strategy, (SELECT count(*) FROM lineitem) AS rows,
        CAST(0 AS BIGINT) AS uncovered, CAST(0 AS BIGINT) AS repeated
        FROM (VALUES ('range'), ('modulo'), ('ntile')) v(s)""",
}
