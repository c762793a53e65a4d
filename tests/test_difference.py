"""Located differences against plain multisets."""

import random
from collections import Counter, defaultdict

import pytest

from tableport.operators import difference


def plain(left, right):
    out = {}
    sides = [defaultdict(Counter), defaultdict(Counter)]
    for side, rows in zip(sides, (left, right)):
        for row in rows:
            side[row[0]][row] += 1
    for key in {*sides[0], *sides[1]}:
        a, b = (side.get(key, Counter()) for side in sides)
        missing, extra = sum((a - b).values()), sum((b - a).values())
        if missing or extra:
            new = any(a[row] == 0 for row in b - a)
            out[key] = (missing, extra, "changed" if missing and extra else "lost" if missing else "added" if new else "doubled")
    return out


@pytest.mark.parametrize("levels,fanout", [(1, 4096), (2, 4096), (2, 7), (6, 5)])
def test_differences_are_found_down_to_the_keys(spark, monkeypatch, levels, fanout):
    monkeypatch.setattr(difference, "FANOUT", fanout)
    rnd = random.Random(levels)
    left = [(rnd.choice([rnd.randint(-5000, 90_000), 2**62, -2**62, None, 7]), rnd.choice("ab"), rnd.choice([None, 1.5])) for _ in range(3000)]
    right = [r for r in left if rnd.random() > 0.01]
    right = [(r[0], "c", None) if rnd.random() < 0.01 else r for r in right] + rnd.sample(left, 20) + [(123_456, "new", None)]
    schema = "id long, t string, v double"
    a, b = (spark.createDataFrame(rows, schema).repartition(4) for rows in (left, right))
    got = {r["id"]: (r["missing"], r["extra"], r["kind"]) for r in difference.locate_differences(a, b, "id", levels=levels).collect()}
    assert got == plain(left, right) and len({k for *_, k in got.values()}) >= 3


def test_equal_and_empty_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "id long, t string")
    assert difference.locate_differences(df, df, "id").count() == 0
    assert difference.locate_differences(df.limit(0), df.limit(0), "id").count() == 0
    assert {tuple(r) for r in difference.locate_differences(df, df.limit(0), "id").collect()} == {(1, 2, 0, "lost"), (None, 1, 0, "lost")}


def test_a_null_moved_to_the_next_column_differs(spark):
    a = spark.createDataFrame([(1, None, "x")], "id long, s string, t string")
    b = spark.createDataFrame([(1, "x", None)], "id long, s string, t string")
    assert [r["kind"] for r in difference.locate_differences(a, b, "id").collect()] == ["changed"]
