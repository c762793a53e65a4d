"""Slowest statements and what they hint at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import snippet, statement_text

# Milliseconds and reads above which a row or a report is flagged.
SLOW_ROW_MS = 5_000.0
SLOW_REPORT_MS = 10_000.0
HEAVY_READS = 100_000.0


def recent(stats: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """Intervals of the last minutes with at least one execution."""
    since = now - F.make_dt_interval(mins=F.lit(minutes))
    return stats.filter((F.col("start_time") >= since) & (F.col("executions") >= 1))


def slowest(stats: DataFrame, limit: int = 10) -> DataFrame:
    """Top statements by average duration; text breaks ties. Durations come in microseconds."""
    ranked = stats.orderBy(F.desc("avg_duration_us"), "query_text").limit(limit)
    ms = F.col("avg_duration_us") / 1000.0
    return ranked.select(
        snippet(statement_text(F.col("query_text"))).alias("snippet"), ms.alias("avg_duration_ms"), "executions",
        F.coalesce("avg_reads", F.lit(0.0)).alias("avg_reads"),
        (F.col("avg_cpu_us") / 1000.0).alias("avg_cpu_ms"), (ms > SLOW_ROW_MS).alias("flagged"))


def insights(top: DataFrame) -> DataFrame:
    """One row of hints over the report's rows."""
    peaks = top.agg(F.greatest(F.coalesce(F.max("avg_duration_ms"), F.lit(0.0)), F.lit(0.0)).alias("max_ms"),
                    F.greatest(F.coalesce(F.max("avg_reads"), F.lit(0.0)), F.lit(0.0)).alias("max_reads"))
    slow, heavy = F.col("max_ms") > SLOW_REPORT_MS, F.col("max_reads") > HEAVY_READS
    return peaks.withColumns({"slow": slow, "heavy_reads": heavy, "healthy": ~slow & ~heavy})
