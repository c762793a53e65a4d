"""Rates, timelines, summaries and verdicts over metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import column, fresh
from ..functions.times import micros_since_epoch
from .ranking import preceding, previous

MIB = 1_048_576.0
# Verdict limits in percent, and the network floor in MiB/s.
SATURATED_PCT = 80.0
SLOW_NETWORK = 5.0
BUSY_LOCAL_PCT = 60.0
# Fixed values: (metric, pass when at least / below, limit).
GRADES = (
    ("write_rows_per_sec", ">=", 500_000.0),
    ("read_rows_per_sec", ">=", 50_000.0),
    ("round_trip_ms", "<", 200.0),
    ("connect_ms", "<", 500.0),
    ("round_trip_label_ms", "<", 50.0),
)


def counter_rates(samples: DataFrame, counters, keys=("host",), ts: str = "ts", tie: str | None = None) -> DataFrame:
    """MiB/s of growing counters between consecutive samples of a key; a reset counts as 0.

    The first sample of a key, one at the same instant as its predecessor, and one without a time have no rate.
    Samples without a key are one key of their own.
    """
    order = [ts] + ([tie] if tie else [])
    lagged = previous(samples, keys, order, [ts, *counters])
    micros = F.timestamp_diff("MICROSECOND", F.col(f"prev_{ts}"), F.col(ts))
    seconds = F.nullif(micros, F.lit(0)) / 1_000_000.0
    rates = {
        f"{c}_mib_s": F.greatest(F.col(c) - F.col(f"prev_{c}"), F.lit(0)) / seconds / MIB
        for c in counters
    }
    known = F.col(f"prev_{ts}").isNotNull()
    return lagged.withColumns({n: F.when(known, r) for n, r in rates.items()}).drop(
        *[f"prev_{c}" for c in (ts, *counters)])


def timeline(samples: DataFrame, measures, slot: str = "5 seconds", keys=("host",), ts: str = "ts",
             tie: str | None = None) -> DataFrame:
    """Latest known value of each measure per key and slot.

    Samples of different sources are rows with the other sources' measures left NULL; one conditional
    aggregate merges them, which equals a full outer join of the sources on the slot but reads and
    shuffles the samples once.
    """
    order = F.struct(ts, tie) if tie else F.col(ts)
    latest = [F.max_by(m, F.when(F.col(m).isNotNull(), order)).alias(m) for m in measures]
    return (samples.groupBy(*keys, F.window(ts, slot).alias("_w")).agg(*latest)
            .select(*keys, F.col("_w.start").alias("slot_start"), *measures))


def full_grid(slots: DataFrame, measures, slot: str = "5 seconds", keys=("host",), carry=(), max_age: int | None = None) -> DataFrame:
    """Every slot of each key from its first to its last, with ``sampled``: whether the timeline has it.

    ``slots`` is a ``timeline`` (one row per key and slot). Slots between have NULL measures, but those named in
    ``carry`` (sources slower than the slot) keep their last known value, for at most ``max_age`` slots where given.
    Each row makes the silent slots before it, so nothing is joined; the value known before a row comes over task
    edges as in ``preceding``, and a long silence is made piece by piece.
    """
    keys, measures, carry = list(keys), list(measures), list(carry)
    naive = isinstance(slots.schema["slot_start"].dataType, T.TimestampNTZType)
    micros = micros_since_epoch if naive else F.unix_micros
    zero = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    step = F.timestamp_diff("MICROSECOND", zero, zero + F.expr(f"INTERVAL {slot}"))
    number, gap, piece, at, *marks = fresh(
        [*slots.columns, "sampled"], "_number", "_gap", "_piece", "_at", *[f"_mark{i}" for i in range(len(carry))])
    numbered = slots.select(*map(column, keys), "slot_start", *map(column, measures), F.expr("0L").alias(number))
    numbered = numbered.withColumn(number, F.floor(micros(F.col("slot_start")) / step).cast("long"))
    marked = numbered.withColumns({
        m: F.when(column(c).isNotNull(), F.struct(F.col(number).alias("at"), column(c).alias("value"))) for m, c in zip(marks, carry)})
    ahead = preceding(marked, keys, [number], [number], marks)
    ahead = ahead.withColumn(gap, F.coalesce(F.col(number) - F.col(f"prev_{number}"), F.lit(1)))
    some = 4096
    pieces = ahead.withColumn(piece, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(gap) - 1) / some))))
    made = pieces.withColumn(at, F.explode(F.sequence(F.col(piece) * some + 1, F.least(F.col(gap), (F.col(piece) + 1) * some))))
    own = F.col(at) == F.col(gap)

    def value(name: str) -> Column:
        here = F.when(own, column(name))
        if name not in carry:
            return here
        known = F.col(f"known_{marks[carry.index(name)]}")
        age = F.col(number) - F.col(gap) + F.col(at) - known["at"]
        fresh_enough = F.lit(True) if max_age is None else age <= max_age
        return F.coalesce(here, F.when(fresh_enough, known["value"]))

    start = F.timestamp_add("MICROSECOND", (F.col(at) - F.col(gap)) * step, F.col("slot_start"))
    return made.select(*map(column, keys), start.alias("slot_start"), *[value(m).alias(m) for m in measures], own.alias("sampled"))


def summary(slots: DataFrame, keys=(), zero_fill: bool = False) -> DataFrame:
    """Averages and peaks of a timeline (cpu_pct, rx_mib_s and the server's srv_cpu, srv_workers, srv_io).

    Slots without a value are left out of an average; ``zero_fill`` counts them as 0 for the local measures. A
    timeline holds only slots with a sample: for an average over all slots, as of a sampler that makes a zero slot
    at every tick, give the ``full_grid``. Peaks start from 0.
    """
    def known(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0)) if zero_fill else F.col(name)

    def peak(name: str) -> Column:
        return F.greatest(F.coalesce(F.max(name), F.lit(0.0)), F.lit(0.0))

    has_server = F.count(F.coalesce("srv_cpu", "srv_workers", "srv_io")) > 0
    return slots.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("slots"), F.avg(known("cpu_pct")).alias("avg_cpu"),
        peak("rx_mib_s").alias("peak_rx"), F.avg(known("rx_mib_s")).alias("avg_rx"),
        has_server.alias("has_server"), F.avg("srv_cpu").alias("avg_srv_cpu"),
        *[F.when(has_server, peak(c)).alias(f"peak_{c}") for c in ("srv_cpu", "srv_workers", "srv_io")])


def verdict(summed: DataFrame) -> DataFrame:
    """The first saturated layer of each summary row; server layers only where they were measured."""
    over = lambda c: F.col("has_server") & (F.col(c) > SATURATED_PCT)
    return summed.withColumn("verdict", (
        F.when(over("peak_srv_cpu"), "server cpu")
        .when(over("peak_srv_workers"), "server workers")
        .when(over("peak_srv_io"), "server io")
        .when(F.col("avg_rx") < SLOW_NETWORK, "network")
        .when(F.col("avg_cpu") > BUSY_LOCAL_PCT, "local cpu")
        .otherwise("none")))


def grade(measurements: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """PASS or WARN per measurement; an unknown metric has no grade."""
    passed = F.lit(None).cast("boolean")
    for name, rule, limit in GRADES:
        ok = F.col(value) >= limit if rule == ">=" else F.col(value) < limit
        passed = F.when(F.col(metric) == name, ok).otherwise(passed)
    return measurements.withColumn("grade", F.when(passed, "PASS").when(~passed, "WARN"))
