"""Chunk plans: how one table is divided into disjoint parts that cover every row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import column
from .order_stats import key_summary, ntile_edges, trim_overlaps

BIGINT_MAX = (1 << 63) - 1


def split_key_range(lo: int, hi: int, n: int) -> list[tuple[int, int]]:
    """At most ``n`` equal, gap-free closed ranges over lo..hi; the last one ends at hi."""
    if n == 0 or lo > hi:
        return []
    size = -((lo - hi - 1) // n)  # ceiling of the width over n
    return [(start, min(start + size - 1, hi)) for start in range(lo, hi + 1, size)]


# Above this many cuts the nested comparison outgrows what the JVM compiles to machine code.
TREE_CUTS = 128


def _interval_tree(key: str, cuts, base: int = 0) -> str:
    """Number of cuts at or below the key, as nested comparisons: log2(n) of them per row."""
    if not cuts:
        return str(base)
    mid = len(cuts) // 2
    return (f"if({key} < {cuts[mid]}, {_interval_tree(key, cuts[:mid], base)}, "
            f"{_interval_tree(key, cuts[mid + 1:], base + mid + 1)})")


def _interval_search(df: DataFrame, key: str, cuts, name: str) -> DataFrame:
    """The same number by binary search over a literal array, one small projection per halving.

    A NULL key passes no comparison and stays at 0.
    """
    table = f"array({', '.join(str(c) for c in cuts)})"
    step = 1 << (len(cuts).bit_length() - 1)
    df = df.withColumn(name, F.lit(0))
    part = "`" + name + "`"
    while step:
        df = df.withColumn(name, F.expr(f"if({key} >= get({table}, {part} + {step - 1}), {part} + {step}, {part})"))
        step //= 2
    return df


@dataclass(frozen=True)
class ChunkPlan:
    """``strategy`` is single, range, ntile or modulo; ``ranges`` are the closed ranges as planned.

    Parts are wider than the planned ranges at both ends: part 0 also takes NULL keys and keys below
    the first range, the last part takes keys above the last. Rows that appear after planning, or a
    nullable key, therefore never fall out of an export.
    """

    strategy: str
    key: str | None = None
    ranges: tuple[tuple[int, int], ...] = ()
    divisor: int = 1

    @property
    def parts(self) -> int:
        return {"single": 1, "modulo": self.divisor}.get(self.strategy) or len(self.ranges)

    @property
    def cuts(self) -> list[int]:
        return [lo for lo, _ in self.ranges[1:]]

    @property
    def _quoted_key(self) -> str:
        return "`" + self.key.replace("`", "``") + "`"

    def searches(self) -> bool:
        """Too many unequal ranges for one expression; ``with_part`` looks the part up instead."""
        return self.strategy in ("range", "ntile") and len(self.cuts) > TREE_CUTS and not self._equal_width()

    def _equal_width(self) -> bool:
        """Part by one division: equal ranges whose whole width fits a bigint."""
        lo, first_hi = self.ranges[0]
        size = first_hi - lo + 1
        starts = [a for a, _ in self.ranges]
        return (starts == list(range(lo, lo + size * len(starts), size))
                and lo + size * len(starts) > self.ranges[-1][1] and self.ranges[-1][1] - lo <= BIGINT_MAX)

    def part_column(self) -> Column:
        """Part number of a row, 0-based. One pass over the table labels every row."""
        if self.parts == 1:
            return F.lit(0)
        key = F.col(self._quoted_key).cast("bigint")
        if self.strategy == "modulo":
            # remainder keeps the key's sign, so its absolute value is in 0..divisor-1
            part = F.abs(key % self.divisor).cast("int")
        elif self._equal_width():
            (lo, first_hi), hi = self.ranges[0], self.ranges[-1][1]
            inside = F.least(F.greatest(key, F.lit(lo)), F.lit(hi))
            part = F.call_function("div", inside - lo, F.lit(first_hi - lo + 1)).cast("int")
        else:
            part = F.expr(_interval_tree(self._quoted_key, self.cuts))
        return F.when(key.isNull(), 0).otherwise(part)

    def predicates(self) -> list[str]:
        """One SQL condition per part, for sources read by predicate (one partition each)."""
        if self.parts == 1:
            return ["1 = 1"]
        name = '"' + self.key.replace('"', '""') + '"'
        if self.strategy == "modulo":
            return [f"ABS({name} % {self.divisor}) = {r}" + (f" OR {name} IS NULL" if r == 0 else "")
                    for r in range(self.divisor)]
        cuts = self.cuts
        middle = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts, cuts[1:])]
        return [f"{name} < {cuts[0]} OR {name} IS NULL", *middle, f"{name} >= {cuts[-1]}"]


SINGLE = ChunkPlan("single")


def range_plan(df: DataFrame, key: str, n: int, bounds: tuple | None = None) -> ChunkPlan:
    """Equal-width ranges between MIN and MAX; one part when there is at most one distinct key.

    ``bounds`` starts with (min, max) when they are known already, e.g. from Parquet footers.
    """
    lo, hi, *_ = bounds or key_summary(df, key)
    if lo is None or lo >= hi or n <= 1:
        return SINGLE
    return ChunkPlan("range", key, tuple(split_key_range(lo, hi, n)))


def ntile_plan(df: DataFrame, key: str, n: int) -> ChunkPlan:
    """Row-equalised ranges: NTILE edges made disjoint."""
    ranges = trim_overlaps(ntile_edges(df, key, n)) if n > 1 else []
    return ChunkPlan("ntile", key, tuple(ranges)) if ranges else SINGLE


def modulo_plan(key: str, n: int) -> ChunkPlan:
    return ChunkPlan("modulo", key, divisor=n) if n > 1 else SINGLE


def in_range(key: str, lo: int, hi: int) -> Column:
    """Closed range predicate; reaches the Parquet scan as a pushed filter."""
    return column(key).between(lo, hi)


def in_modulo(key: str, divisor: int, remainder: int) -> Column:
    return F.abs(column(key) % divisor) == remainder


def with_part(df: DataFrame, plan: ChunkPlan, name: str = "_part") -> DataFrame:
    if plan.searches():
        return _interval_search(df, plan._quoted_key, plan.cuts, name)
    return df.withColumn(name, plan.part_column())


def part_counts(df: DataFrame, plan: ChunkPlan) -> DataFrame:
    return with_part(df, plan, "part").groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """One row (lo, hi), 0 and 0 for an empty table."""
    k = column(key).cast("bigint")
    return df.agg(F.coalesce(F.min(k), F.lit(0)).cast("bigint").alias("lo"),
                  F.coalesce(F.max(k), F.lit(0)).cast("bigint").alias("hi"))


def range_table(df: DataFrame, key: str, n: int) -> DataFrame:
    """The range plan as rows (part, lo, hi), computed in Spark with 128-bit safe widths."""
    wide = "decimal(38,0)"
    k = column(key)
    bounds = df.agg(F.min(k).cast(wide).alias("lo"), F.max(k).cast(wide).alias("hi"))
    size = F.ceil((F.col("hi") - F.col("lo") + 1) / n).cast(wide)
    start = F.col("lo") + F.col("part").cast(wide) * F.col("size")
    return (
        bounds.filter("lo is not null")
        .withColumn("size", size)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .select("part", start.alias("a"), F.least(start + F.col("size") - 1, F.col("hi")).alias("b"))
        .filter("a <= b")
        .select("part", F.col("a").cast("bigint").alias("lo"), F.col("b").cast("bigint").alias("hi"))
    )


def cover(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """Proof that conditions partition the table, in one pass and without a shuffle of rows.

    Counts the rows that satisfy no condition and those that satisfy more than one; both are 0 exactly
    when the parts are disjoint and together hold every row once.
    """
    hits = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("int") for c in conditions])
    return df.select(hits.alias("hits")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("hits") == 0).alias("uncovered"),
        F.count_if(F.col("hits") > 1).alias("repeated"),
    )


def part_conditions(plan: ChunkPlan) -> list[Column]:
    """The plan's own predicates as Columns."""
    if plan.parts == 1:
        return [F.lit(True)]
    return [F.expr(p.replace('"' + plan.key.replace('"', '""') + '"', plan._quoted_key))
            for p in plan.predicates()]
