"""Bitmap proofs against plain counts, dense and sparse."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableport.operators import bitmaps

EDGES = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2**63 - 1, -2**63 + 1, 2**31]


def column_of(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"id {kind}").repartition(5)


@pytest.mark.parametrize("dense", [None, True, False])
def test_counts_and_repeats(spark, dense):
    rnd = random.Random(1)
    values = [rnd.randint(-40_000, 70_000) for _ in range(3000)] + EDGES + EDGES[:4] + [None, None]
    df, counts = column_of(spark, values), Counter(v for v in values if v is not None)
    assert tuple(bitmaps.key_counts(df, "id", dense).first()) == (sum(counts.values()), len(counts))
    assert dict(map(tuple, bitmaps.repeated_keys(df, "id", dense).collect())) == {k: n for k, n in counts.items() if n > 1}
    assert tuple(bitmaps.key_counts(df.limit(0), "id", dense).first()) == (0, 0)


@pytest.mark.parametrize("dense", [None, True, False])
def test_orphans(spark, dense):
    rnd = random.Random(2)
    parents = [v for v in range(-1000, 70_000) if v % 997] + EDGES[:6] + [None]
    children = [rnd.randint(-1000, 69_999) for _ in range(4000)] + EDGES + [None] * 3
    got = dict(map(tuple, bitmaps.orphans(column_of(spark, children), "id", column_of(spark, parents), "id", dense).collect()))
    assert got == {k: n for k, n in Counter(children).items() if k is not None and k not in set(parents)} and got
    none = bitmaps.orphans(column_of(spark, [1, 2]), "id", column_of(spark, [], "int"), "id", dense).collect()
    assert sorted(map(tuple, none)) == [(1, 1), (2, 1)]


def test_density_is_measured(spark):
    assert bitmaps.is_dense(spark.range(100_000), "id") and not bitmaps.is_dense(spark.range(0, 10**12, 10**9), "id")
    assert not bitmaps.is_dense(spark.range(0), "id")
    with pytest.raises(ValueError, match="no integer"):
        bitmaps.key_counts(spark.range(3).select(F.col("id").cast("string")), "id")
