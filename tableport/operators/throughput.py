"""Throughput of chunks, ramps and competing runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ranking import global_row_number
from .telemetry import MIB

# Shortest time a rate divides by, and the gain in percent below which a ramp has its knee.
MIN_SECONDS = 0.001
KNEE_GAIN_PCT = 10.0


def per_second(amount: Column, seconds: Column) -> Column:
    return amount / F.greatest(seconds.cast("double"), F.lit(MIN_SECONDS))


def heartbeat(rows: DataFrame, keys, ts: str = "ts", seconds: int = 30) -> DataFrame:
    """Rows and rows/s per key in fixed windows."""
    return (rows.groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("_w"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(*keys, F.col("_w.start").alias("slot_start"), "rows",
                    (F.col("rows") / float(seconds)).alias("rows_per_sec")))


def chunk_summary(rows: DataFrame, keys, ts: str = "ts", size: Column | None = None) -> DataFrame:
    """Rows, seconds between first and last row, rows/s and, with ``size`` in bytes, MiB/s per key."""
    measures = [F.count(F.lit(1)).alias("rows"), F.min(ts).alias("_a"), F.max(ts).alias("_b")]
    if size is not None:
        measures.append(F.sum(size).alias("bytes"))
    seconds = F.timestamp_diff("MICROSECOND", F.col("_a"), F.col("_b")) / 1_000_000.0
    out = rows.groupBy(*keys).agg(*measures).withColumn("seconds", seconds).withColumn(
        "rows_per_sec", per_second(F.col("rows"), F.col("seconds")))
    if size is not None:
        out = out.withColumn("mib_per_sec", per_second(F.col("bytes"), F.col("seconds")) / MIB)
    return out.drop("_a", "_b")


def progress(finished: DataFrame, order_by) -> DataFrame:
    """``k of n``: position of every finished item in the order it finished, and the total."""
    numbered = global_row_number(finished, order_by, "done")
    total = finished.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return numbered.withColumn("total", F.lit(total).cast("bigint"))


def ramp(steps: DataFrame, keys=(), step: str = "step") -> DataFrame:
    """Aggregate and per-connection rows/s of each step (keys, step, rows, elapsed) and its gain in percent.

    The gain is 100 for a first step or after one without rows. A ramp has a handful of steps per key.
    """
    rate = steps.withColumn("rows_per_sec", per_second(F.col("rows"), F.col("elapsed")))
    before = F.lag("rows_per_sec").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy(step))
    gain = F.when(before > 0, (F.col("rows_per_sec") - before) / before * 100.0).otherwise(100.0)
    return rate.withColumn("per_connection", F.col("rows_per_sec") / F.col(step)).withColumn("gain_pct", gain)


def knee(ramped: DataFrame, keys=(), step: str = "step") -> DataFrame:
    """First step past 1 that gains less than 10 percent; NULL where the ramp never flattens."""
    flat = (F.col("gain_pct") < KNEE_GAIN_PCT) & (F.col(step) > 1)
    return ramped.groupBy(*keys).agg(F.min(F.when(flat, F.col(step))).alias("knee"), F.max(step).alias("last_step"))


def compare_runs(results: DataFrame, ours: str, other: str, keys=("run",)) -> DataFrame:
    """Two tools side by side (keys, tool, wall, bytes, failed): wall, size, size/s and speed-up.

    One pass pivots both tools. A failed or absent run has no speed-up.
    """
    def of(tool: str, column: str) -> Column:
        return F.max(F.when(F.col("tool") == tool, F.col(column)))

    picked = results.filter(F.col("tool").isin(ours, other)).groupBy(*keys).agg(*[
        of(tool, c).alias(f"{side}_{c}")
        for side, tool in (("our", ours), ("other", other)) for c in ("wall", "bytes", "failed")])
    usable = ~F.coalesce(F.col("our_failed"), F.lit(True)) & ~F.coalesce(F.col("other_failed"), F.lit(True))
    return picked.withColumns({
        "our_bytes_per_sec": per_second(F.col("our_bytes"), F.col("our_wall")),
        "other_bytes_per_sec": per_second(F.col("other_bytes"), F.col("other_wall")),
        "speedup": F.when(usable, F.col("other_wall") / F.greatest("our_wall", F.lit(MIN_SECONDS))),
    })
