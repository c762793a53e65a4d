"""Where two copies of a table differ: hashes over key ranges, opened range by range down to the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.names import column
from ..session import materialize

# each level cuts a differing range into this many; two levels tell 16 million ranges apart
FANOUT = 4096


def _hashed(df: DataFrame, key: str, columns, side: int) -> DataFrame:
    row = F.xxhash64(*[F.struct(column(c).isNull(), column(c)) for c in columns])
    return df.select(column(key).cast("bigint").alias("k"), row.alias("h"), F.lit(side).alias("side"))


def _differing(rows: DataFrame, width: int) -> DataFrame:
    """(range) of ``width`` keys whose rows differ in number or content; NULL keys are a range of their own."""
    left, exact = F.col("side") == 0, F.col("h").cast("decimal(20,0)")
    summed = rows.groupBy(F.floor(F.col("k") / F.lit(width).cast("decimal(20,0)")).cast("decimal(20,0)").alias("range")).agg(
        F.count_if(left).alias("n0"), F.count_if(~left).alias("n1"),
        F.sum(F.when(left, exact)).alias("s0"), F.sum(F.when(~left, exact)).alias("s1"),
        F.bit_xor(F.when(left, F.col("h"))).alias("x0"), F.bit_xor(F.when(~left, F.col("h"))).alias("x1"))
    same = (F.col("n0") == F.col("n1")) & F.col("s0").eqNullSafe(F.col("s1")) & F.col("x0").eqNullSafe(F.col("x1"))
    return summed.where(~same).select("range")


def locate_differences(left: DataFrame, right: DataFrame, key: str, columns=None, levels: int = 2) -> DataFrame:
    """(key, missing, extra, kind) of every key whose rows differ between two copies, as multisets of rows.

    ``missing`` rows are only in ``left``, ``extra`` ones only in ``right``. ``kind``: ``changed`` (both), ``lost`` (only
    missing), ``doubled`` (only extra, all of them copies of rows that ``left`` has under that key), else ``added``. ``key`` is an
    integer column, NULLs are a key of their own; ``columns`` are compared (all of ``left``).

    A level shuffles one row of sums per task and range; only rows of ranges that differ go on, so copies that agree but
    for a few keys are read once a level and nearly nothing of them is shuffled. Row contents are 64-bit hashes.
    """
    columns = list(columns or left.columns)
    rows = _hashed(left, key, columns, 0).unionByName(_hashed(right, key, columns, 1))
    bounds = rows.agg(F.min("k"), F.max("k")).first()
    width = 1 if bounds[0] is None else bounds[1] - bounds[0] + 1
    for _ in range(levels):
        width = max(1, -(-width // FANOUT))
        ranges = materialize(_differing(rows, width), "differing")
        at = F.floor(F.col("k") / F.lit(width).cast("decimal(20,0)")).cast("decimal(20,0)")
        rows = rows.join(ranges.select(F.col("range").alias("_range")), at.eqNullSafe(F.col("_range")), "left_semi")
        if width == 1:
            break
    counted = rows.groupBy("k", "h").agg(F.count_if(F.col("side") == 0).alias("l"), F.count_if(F.col("side") == 1).alias("r"))
    per_key = counted.groupBy("k").agg(
        F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))).alias("missing"),
        F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0))).alias("extra"),
        F.count_if((F.col("r") > F.col("l")) & (F.col("l") == 0)).alias("new")).where("missing > 0 OR extra > 0")
    kind = (F.when((F.col("missing") > 0) & (F.col("extra") > 0), "changed").when(F.col("missing") > 0, "lost")
            .when(F.col("new") == 0, "doubled").otherwise("added"))
    return per_key.select(F.col("k").alias(key), "missing", "extra", kind.alias("kind"))
