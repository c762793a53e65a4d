import random

import pytest
from pyspark.sql import Window, functions as F

from tableport.plans import chunking as ch, order_stats as os_
from tableport.session import small_frame
from tableport.sources.tables import footer_bounds

MIN, MAX = -(1 << 63), (1 << 63) - 1


def test_split_key_range_against_every_key():
    rng = random.Random(11)
    for _ in range(300):
        lo, n = rng.randint(-60, 60), rng.randint(0, 15)
        hi = lo + rng.randint(-2, 45)
        parts = ch.split_key_range(lo, hi, n)
        assert [k for a, b in parts for k in range(a, b + 1)] == (list(range(lo, hi + 1)) if n else [])
        widths = [b - a + 1 for a, b in parts]
        assert len(parts) <= n and len(set(widths[:-1])) <= 1 and (not widths or widths[-1] <= widths[0])


def test_split_key_range_tiles_everything():
    for lo, hi in ((MIN, MAX), (-50, 49), (0, 1), (MAX - 3, MAX), (MIN, MIN + 9)):
        for n in (1, 2, 3, 7, 8, 64):
            parts = ch.split_key_range(lo, hi, n)
            assert parts[0][0] == lo and parts[-1][1] == hi and len(parts) <= n
            assert all(b + 1 == c for (_, b), (c, _) in zip(parts, parts[1:]))


def test_trim_overlaps_keeps_each_key_in_its_first_bucket():
    rng = random.Random(12)
    for _ in range(300):
        keys, n = sorted(rng.randint(0, 25) for _ in range(rng.randint(1, 60))), rng.randint(1, 12)
        sizes = os_.bucket_sizes(len(keys), n)
        buckets = [keys[sum(sizes[:i]):sum(sizes[:i + 1])] for i in range(len(sizes))]
        ranges = os_.trim_overlaps([(b[0], b[-1]) for b in buckets])
        assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:])) and all(a <= b for a, b in ranges)
        tops = [b[-1] for b in buckets]
        for key in keys:
            first = next(i for i, top in enumerate(tops) if key <= top)
            assert [b for a, b in ranges if a <= key <= b] == [tops[first]]
    assert os_.trim_overlaps([]) == []


def keys_frame(spark, keys):
    return small_frame(spark, [(i, k) for i, k in enumerate(keys)], "id int, k bigint")


def random_keys(rng, size):
    hot = rng.randint(-5, 5)
    pool = [rng.randint(-40, 40) for _ in range(size)]
    return [hot if rng.random() < 0.34 else k for k in pool]


def brute_ntile(df, n):
    tiled = df.filter("k is not null").withColumn("b", F.ntile(n).over(Window.orderBy("k")))
    return [tuple(r) for r in tiled.groupBy("b").agg(F.min("k"), F.max("k"), F.count("*")).orderBy("b")
            .select("min(k)", "max(k)", "count(1)").collect()]


def test_ntile_edges_equal_window_ntile(spark):
    rng = random.Random(1)
    for n in (1, 2, 3, 8, 50):
        df = keys_frame(spark, random_keys(rng, rng.randint(1, 120)) + [None, None])
        assert os_.ntile_edges(df, "k", n) == brute_ntile(df, n)


def test_ntile_edges_over_the_whole_bigint_range(spark):
    rng = random.Random(2)
    df = keys_frame(spark, [MIN, MAX, MIN, 0, -1] + [rng.randint(MIN, MAX) for _ in range(300)] + [MAX] * 90)
    assert os_.ntile_edges(df, "k", 7) == brute_ntile(df, 7)


def test_few_cells_per_pass_give_the_same_keys(spark):
    rng = random.Random(3)
    keys = random_keys(rng, 200)
    df, ordered = keys_frame(spark, keys), sorted(keys)
    ranks = [1, 2, 57, 100, 199, 200]
    found = os_.keys_at_ranks(df, "k", ranks, ordered[0], ordered[-1], cells=4)
    assert found == {r: ordered[r - 1] for r in ranks}


def test_ntile_of_nothing(spark):
    assert os_.ntile_edges(keys_frame(spark, [None, None]), "k", 4) == []
    assert ch.ntile_plan(keys_frame(spark, [None]), "k", 4) == ch.SINGLE


def plans_for(df, n):
    return [ch.range_plan(df, "k", n), ch.ntile_plan(df, "k", n), ch.modulo_plan("k", n)]


def test_parts_hold_every_row_once(spark):
    rng = random.Random(4)
    for size in (2, 40, 150):
        df = keys_frame(spark, random_keys(rng, size) + [None])
        for plan in plans_for(df, 5):
            proof = ch.cover(df, ch.part_conditions(plan)).first()
            assert (proof["rows"], proof["uncovered"], proof["repeated"]) == (size + 1, 0, 0), plan
            by_part = ch.with_part(df, plan)
            for r, condition in enumerate(ch.part_conditions(plan)):
                a = by_part.filter(F.col("_part") == r).drop("_part")
                b = df.filter(condition)
                assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rows_outside_the_planned_range_keep_a_part(spark):
    planned = keys_frame(spark, range(100))
    later = keys_frame(spark, [-7, 100, MAX, MIN, None, 50])
    for plan in plans_for(planned, 4):
        parts = {r["k"]: r["_part"] for r in ch.with_part(later, plan).collect()}
        assert all(0 <= p < plan.parts for p in parts.values())
        assert parts[None] == 0
        if plan.strategy != "modulo":
            assert parts[MIN] == 0 and parts[MAX] == plan.parts - 1
        assert ch.cover(later, ch.part_conditions(plan)).first()["uncovered"] == 0


def test_range_plan_over_the_whole_bigint_range(spark):
    df = keys_frame(spark, [MIN, -5, 0, 5, MAX])
    plan = ch.range_plan(df, "k", 8)
    expected = {k: i for k in (MIN, -5, 0, 5, MAX) for i, (a, b) in enumerate(plan.ranges) if a <= k <= b}
    assert {r["k"]: r["_part"] for r in ch.with_part(df, plan).collect()} == expected
    listed = [(r["lo"], r["hi"]) for r in ch.range_table(df, "k", 8).orderBy("part").collect()]
    assert listed == list(plan.ranges)


def test_modulo_keeps_negative_keys(spark):
    df = keys_frame(spark, range(-23, 24))
    hits = [df.filter(ch.in_modulo("k", 5, r)).count() for r in range(5)]
    assert sum(hits) == 47 and all(hits)


def test_single_part_plans(spark):
    assert ch.range_plan(keys_frame(spark, [7, 7]), "k", 4) == ch.SINGLE
    assert ch.range_plan(keys_frame(spark, [None]), "k", 4) == ch.SINGLE
    assert ch.modulo_plan("k", 1) == ch.SINGLE
    assert ch.key_bounds(keys_frame(spark, [None]), "k").first() == (0, 0)


def test_range_predicate_reaches_the_scan(spark, lineitem_path):
    df = spark.read.parquet(lineitem_path).filter(ch.in_range("l_orderkey", 10, 20)).select("l_orderkey", "l_tax")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_orderkey,10)" in plan and "LessThanOrEqual(l_orderkey,20)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan


def test_footer_bounds(spark, lineitem_path):
    df = spark.read.parquet(lineitem_path)
    row = df.agg(F.min("l_orderkey"), F.max("l_orderkey"), F.count("l_orderkey"), F.count("*")).first()
    assert footer_bounds(spark, lineitem_path, "l_orderkey") == tuple(row)


def test_many_unequal_ranges_are_searched(spark):
    rng = random.Random(8)
    keys = [rng.randint(MIN, MAX) for _ in range(400)] + [MIN, MAX]
    df = keys_frame(spark, keys + [None])
    for n in (130, 131, 257, 300):
        plan = ch.ntile_plan(df, "k", n)
        assert plan.searches()
        expected = {k: sum(c <= k for c in plan.cuts) for k in keys} | {None: 0}
        assert {r["k"]: r["_part"] for r in ch.with_part(df, plan).collect()} == expected
        assert {r["k"]: r["p"] for r in df.select("k", plan.part_column().alias("p")).collect()} == expected
