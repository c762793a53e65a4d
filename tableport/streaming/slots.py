"""The batch telemetry reports on unbounded input: watermark, tumbling windows, update output."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.times import utc_instant, utc_naive
from ..operators.telemetry import MIB, counter_rates
from ..session import list_folders, materialize, path_exists, scratch_path


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def timed(stream: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Zone-free timestamps as UTC instants (a watermark needs instants), late by at most ``delay``."""
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        stream = stream.withColumn(ts, utc_instant(F.col(ts)))
    return stream.withWatermark(ts, delay)


def _slot(keys, frame: DataFrame, *columns) -> DataFrame:
    return frame.select(*keys, utc_naive(F.col("_w.start")).alias("slot_start"), *columns)


def heartbeat_stream(stream: DataFrame, keys, delay: str, seconds: int = 30, ts: str = "ts") -> DataFrame:
    counted = timed(stream, delay, ts).groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("_w")).agg(
        F.count(F.lit(1)).alias("rows"))
    return _slot(keys, counted, "rows", (F.col("rows") / float(seconds)).alias("rows_per_sec"))


def timeline_stream(stream: DataFrame, measures, slot: str, delay: str, keys=("host",), ts: str = "ts",
                    tie: str | None = None) -> DataFrame:
    """Latest known value of each measure per slot."""
    order = F.struct(ts, tie) if tie else F.col(ts)
    latest = [F.max_by(m, F.when(F.col(m).isNotNull(), order)).alias(m) for m in measures]
    merged = timed(stream, delay, ts).groupBy(*keys, F.window(ts, slot).alias("_w")).agg(*latest)
    return _slot(keys, merged, *measures)


def rate_stream(stream: DataFrame, counter: str, slot: str, delay: str, keys=("host",), ts: str = "ts",
                tie: str | None = None) -> DataFrame:
    """MiB/s of a counter per slot, from its first and last sample there; no state beyond the window."""
    order = F.struct(ts, tie) if tie else F.col(ts)
    edges = timed(stream, delay, ts).groupBy(*keys, F.window(ts, slot).alias("_w")).agg(
        F.min_by(counter, order).alias("a"), F.max_by(counter, order).alias("b"),
        F.min(ts).alias("t0"), F.max(ts).alias("t1"))
    micros = F.nullif(F.unix_micros("t1") - F.unix_micros("t0"), F.lit(0))
    rate = F.greatest(F.col("b") - F.col("a"), F.lit(0)) / (micros / 1_000_000.0) / MIB
    return _slot(keys, edges, rate.alias("mib_per_sec"))


@dataclass(frozen=True)
class Drained:
    """``windows``: the last state of every window, closed or still open. ``late_rows``: rows that came after the
    watermark had passed their window and were left out; 0 means the windows hold all input."""

    windows: DataFrame
    late_rows: int


def _run(writer, store, out: str) -> int:
    """Runs ``store`` over all available micro-batches; the number of rows that state operators refused as late.

    A query remembers only its last hundred reports, so they are read at every batch and counted by its number.
    """
    late: dict[int, int] = {}
    running = []

    def note() -> None:
        for progress in running[0].recentProgress if running else ():
            late[progress.batchId] = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def noted(batch: DataFrame, number: int) -> None:
        note()
        store(batch, number)

    running.append(writer.foreachBatch(noted).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    running[0].awaitTermination()
    note()
    return sum(late.values())


def drain(stream: DataFrame, keys, name: str = "stream") -> Drained:
    """Run everything available and return every window it fed, one row per ``keys`` and ``slot_start``.

    Update output: a micro-batch writes the windows it changed to the shared folder, under its number, and the
    newest version of a window counts. State is bounded by the windows the watermark has not passed. A batch that
    is run again after a failure overwrites its own folder, so nothing counts twice.
    """
    spark, columns = stream.sparkSession, stream.columns
    out = scratch_path(spark, name)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={number}")

    late = _run(stream.writeStream.outputMode("update"), store, out)
    if not path_exists(spark, f"{out}/data"):
        return Drained(spark.createDataFrame([], stream.schema), late)
    stored = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{out}/data")
    values = [c for c in columns if c not in (*keys, "slot_start")]
    newest = stored.groupBy(*keys, "slot_start").agg(F.max_by(F.struct(*values), "batch").alias("_newest"))
    windows = newest.select(*keys, "slot_start", *[F.col("_newest")[v].alias(v) for v in values]).select(*columns)
    return Drained(windows, late)


@dataclass(frozen=True)
class DrainedRates:
    """``rates``: the samples with a rate per counter, as ``counter_rates`` gives them. ``late_rows``: samples that
    came after the watermark had passed them and were left out; 0 means the rates hold all input."""

    rates: DataFrame
    late_rows: int


def drain_rates(stream: DataFrame, counters, delay_seconds: int, keys=("host",), ts: str = "ts", tie: str | None = None,
                path: str | None = None) -> DrainedRates:
    """``counter_rates`` over a stream, steps over every edge of windows and micro-batches included.

    Samples may come in any order within ``delay_seconds`` of the newest one seen: those behind that watermark are put
    in order, and each key's last sample is carried to the next micro-batch. What is not yet behind it waits; the end
    of the input settles all of it. A sample without a time has no rate and settles at once.

    Waiting samples and carried ones (one per key) are a table with a version for each micro-batch, written under its
    number: a batch run again after a failure reads the version before its own and overwrites its own, so nothing counts
    twice. ``path`` keeps that table and the query's checkpoint, so a further run goes on where the last one ended;
    samples that wait between two runs are settled for the first result and taken up again by the second.
    """
    spark, keys, columns = stream.sparkSession, list(keys), stream.columns
    out = path or scratch_path(spark, "rates")
    order = [ts] + ([tie] if tie else [])
    role, at = "_role", F.col(ts)                        # 0: carried over from an earlier batch, 1: waiting
    held = T.StructType([*stream.schema.fields, T.StructField(role, T.IntegerType())])
    clock = "passed timestamp_ntz, newest timestamp_ntz, late bigint"
    naive = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    point = (lambda c: c) if naive else utc_naive

    def moment(t):
        return F.lit(None if t is None else t.isoformat(sep=" ")).cast("timestamp_ntz")

    def version_before(number: int):
        """The newest version below ``number``: (held rows, watermark passed, newest time, late rows so far)."""
        for n in range(number - 1, -1, -1):
            if path_exists(spark, f"{out}/clock/batch={n}"):
                row = spark.read.schema(clock).parquet(f"{out}/clock/batch={n}").first()
                return spark.read.schema(held).parquet(f"{out}/held/batch={n}"), row["passed"], row["newest"], row["late"]
        return spark.createDataFrame([], held), None, None, 0

    def settle(rows: DataFrame) -> DataFrame:
        """Rates of the waiting rows, each after the row before it, which may be a carried one."""
        return counter_rates(rows, counters, keys, ts, tie).where(F.col(role) == 1).drop(role)

    def store(batch: DataFrame, number: int) -> None:
        before, passed, newest, late = version_before(number)
        arrived = batch.withColumn(role, F.lit(1)).persist()
        try:
            seen = arrived.agg(F.max(point(at)).alias("newest"), F.count_if(point(at) <= moment(passed)).alias("late")).first()
            newest = max((t for t in (newest, seen["newest"]) if t is not None), default=None)
            limit = None if newest is None else newest - timedelta(seconds=delay_seconds)
            limit = max((t for t in (passed, limit) if t is not None), default=None)
            behind = at.isNull() | (point(at) <= moment(limit))
            on_time = arrived if passed is None else arrived.where(at.isNull() | (point(at) > moment(passed)))
            known = materialize(before.unionByName(on_time).withColumn("_behind", F.coalesce(behind, F.lit(False))), "rates-batch")
            ready, waiting = known.where("_behind").drop("_behind"), known.where("NOT _behind").drop("_behind")
            settle(ready).write.mode("overwrite").parquet(f"{out}/data/batch={number}")
            last = ready.where(at.isNotNull()).groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
            carried = last.select("_last.*").withColumn(role, F.lit(0))
            carried.unionByName(waiting).write.mode("overwrite").parquet(f"{out}/held/batch={number}")
            spark.createDataFrame([(limit, newest, late + seen["late"])], clock).coalesce(1).write.mode("overwrite").parquet(
                f"{out}/clock/batch={number}")
        finally:
            arrived.unpersist()

    _run(stream.writeStream.outputMode("append"), store, out)
    numbers = [int(p.rsplit("=", 1)[1]) for p in list_folders(spark, f"{out}/clock")]
    rest, _, _, late = version_before(max(numbers, default=-1) + 1)
    settled = settle(rest)
    if numbers:
        settled = spark.read.schema(settled.schema).parquet(*[f"{out}/data/batch={n}" for n in numbers]).unionByName(settled)
    return DrainedRates(settled, late)
