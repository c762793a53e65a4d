import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tableport.operators import ranking, statements, telemetry as tel, throughput as thr
from tableport.operators.ranking import preceding
from tableport.plans.inventory import union_all
from tableport.session import small_frame
from tableport.streaming import slots as st

T0 = dt.datetime(2024, 1, 1)


def test_global_row_number(spark):
    rng = random.Random(6)
    rows = [(i, rng.randint(0, 5)) for i in range(500)]  # long runs of equal values
    df = spark.createDataFrame(rows, "id int, v int").repartition(7)
    got = {r["id"]: r["n"] for r in ranking.global_row_number(df, [F.desc("v"), "id"], "n").collect()}
    want = {i: n for n, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert got == want
    assert ranking.global_row_number(df.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_rates_of_hot_odd_and_missing_hosts(spark, tasks):
    rng = random.Random(7)
    rows, at = [], {}
    for i in range(400):
        host = "hot" if i % 3 else None if i % 2 else f"h{i % 5}" if i < 390 else f"once{i}"
        at[host] = at.get(host, T0) + dt.timedelta(minutes=0 if 100 < i < 250 else rng.choice([0, 1, 50, 200]))
        rows.append((host, at[host], i, rng.randint(0, 1000) * 1_000_000))
    df = spark.createDataFrame(rows, "host string, ts timestamp_ntz, id int, rx bigint")
    df = df.withColumns({"_prev": F.lit(1), "_TASK": F.lit(2)})
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        rated = tel.counter_rates(df, ["rx"], tie="id")
        got = {r["id"]: r["rx_mib_s"] for r in rated.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert rated.columns == [*df.columns, "rx_mib_s"]
    want, last = {}, {}
    for host, ts, i, rx in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        want[i] = None
        if host in last:
            seconds = (ts - last[host][0]).total_seconds()
            if seconds:
                want[i] = max(rx - last[host][1], 0) / seconds / tel.MIB
        last[host] = (ts, rx)
    assert got == want


def sample_rows(spark, rows):
    return spark.createDataFrame(
        rows, "host string, ts timestamp_ntz, id int, cpu_pct double, rx_mib_s double, srv_cpu double, "
              "srv_workers double, srv_io double")


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_timeline_keeps_the_latest_known_value(spark):
    df = sample_rows(spark, [
        ("a", at(0), 1, 10.0, None, None, None, None), ("a", at(2), 2, 20.0, None, None, None, None),
        ("a", at(3), 3, None, 5.0, None, None, None), ("a", at(3), 4, None, 6.0, None, None, None),
        ("a", at(7), 5, None, None, 50.0, 40.0, 30.0)])
    got = [tuple(r) for r in tel.timeline(df, ["cpu_pct", "rx_mib_s", "srv_cpu"], "5 seconds", tie="id").orderBy("slot_start").collect()]
    assert got == [("a", T0, 20.0, 6.0, None), ("a", at(5), None, None, 50.0)]


def test_summary_skips_or_fills_missing_slots(spark):
    df = sample_rows(spark, [("a", at(0), 1, 80.0, 4.0, None, None, None), ("a", at(5), 2, None, None, None, None, None)])
    slots = tel.timeline(df, ["cpu_pct", "rx_mib_s", "srv_cpu", "srv_workers", "srv_io"], "5 seconds")
    plain, filled = tel.summary(slots, ["host"]).first(), tel.summary(slots, ["host"], zero_fill=True).first()
    assert (plain["avg_cpu"], plain["avg_rx"], plain["peak_rx"]) == (80.0, 4.0, 4.0)
    assert (filled["avg_cpu"], filled["avg_rx"], filled["peak_rx"]) == (40.0, 2.0, 4.0)
    assert not plain["has_server"] and plain["peak_srv_cpu"] is None


def plain_grid(rows, step, carry_age):
    """{(host, slot): (cpu, srv, sampled)} of {(host, slot): (cpu, srv)}, slot by slot."""
    out = {}
    for host in {h for h, _ in rows}:
        slots = sorted(s for h, s in rows if h == host)
        known, seen = None, None
        for n in range((slots[-1] - slots[0]) // step + 1):
            slot = slots[0] + n * step
            cpu, srv = rows.get((host, slot), (None, None))
            known, seen = (srv, n) if srv is not None else (known, seen)
            alive = known is not None and (carry_age is None or n - seen <= carry_age)
            out[host, slot] = (cpu, known if alive else None, (host, slot) in rows)
    return out


@pytest.mark.parametrize("age", [None, 0, 3])
def test_full_grid_against_a_plain_walk(spark, age):
    rnd = random.Random(age)
    rows = {(rnd.choice(["a", "b", None, "busy", "busy"]), 5 * rnd.randint(0, 400)): (
        rnd.choice([None, 1.0 * rnd.randint(0, 9)]), rnd.choice([None, None, 1.0 * rnd.randint(0, 9)])) for _ in range(300)}
    rows |= {("far", 0): (1.0, 2.0), ("far", 5 * 20_000): (3.0, None), ("one", 50): (None, None)}
    df = spark.createDataFrame([(h, at(s), *v) for (h, s), v in rows.items()], "host string, slot_start timestamp_ntz, cpu double, srv double")
    got = tel.full_grid(df.repartition(7), ["cpu", "srv"], "5 seconds", carry=["srv"], max_age=age).collect()
    assert {(r["host"], int((r["slot_start"] - T0).total_seconds())): (r["cpu"], r["srv"], r["sampled"]) for r in got} == plain_grid(rows, 5, age)
    assert len(got) == len(plain_grid(rows, 5, age))


def test_full_grid_of_instants_and_of_nothing(spark):
    df = spark.sql("SELECT 'a' AS host, TIMESTAMP'2024-01-01 00:00:00' AS slot_start, 1.0D AS v UNION ALL SELECT 'a', TIMESTAMP'2024-01-01 03:00:00', 2.0D")
    got = tel.full_grid(df, ["v"], "1 hour", carry=["v"]).orderBy("slot_start").collect()
    assert [(r["v"], r["sampled"]) for r in got] == [(1.0, True), (1.0, False), (1.0, False), (2.0, True)]
    assert tel.full_grid(df.limit(0), ["v"], "1 hour").count() == 0


def test_known_values_come_over_task_edges(spark):
    """Keys that span many sort tasks, with their last known value far back."""
    rows = [("a", i, 1 if i == 3 else None) for i in range(4000)] + [("b", i, i if i % 900 == 7 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, n int, v int").repartition(5)
    got = {(r["k"], r["n"]): (r["known_v"], r["prev_v"]) for r in preceding(df, ["k"], ["n"], ["v"], ["v"]).collect()}
    want, known, before = {}, {}, {}
    for k, n, v in rows:
        want[k, n] = (known.get(k), before.get(k))
        before[k], known[k] = v, known.get(k) if v is None else v
    assert got == want


def test_a_burst_in_one_instant_is_spread(spark):
    rows = spark.range(20_000).selectExpr("'a' AS host", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id AS rx")
    lagged = preceding(rows, ["host"], ["ts"], ["rx"]).select("rx", "prev_rx").collect()
    assert len(lagged) == 20_000 and sum(r["prev_rx"] is None for r in lagged) == 1
    assert len({r["prev_rx"] for r in lagged}) == 20_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = preceding(rows, ["host"], ["ts"], ["rx"]).rdd.glom().map(len).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 10_000


def test_verdict_takes_the_first_saturated_layer(spark):
    cases = [  # has_server, cpu, workers, io, rx, local cpu
        ((True, 81.0, 99.0, 99.0, 1.0, 99.0), "server cpu"), ((True, 80.0, 81.0, 99.0, 1.0, 99.0), "server workers"),
        ((True, 0.0, 80.0, 81.0, 1.0, 99.0), "server io"), ((True, 0.0, 0.0, 80.0, 4.9, 99.0), "network"),
        ((True, 0.0, 0.0, 0.0, 5.0, 61.0), "local cpu"), ((True, 0.0, 0.0, 0.0, 5.0, 60.0), "none"),
        ((False, None, None, None, 1.0, 99.0), "network"), ((False, None, None, None, 9.0, 99.0), "local cpu"),
        ((False, None, None, None, 9.0, 1.0), "none")]
    df = small_frame(spark, [c for c, _ in cases], "has_server boolean, peak_srv_cpu double, peak_srv_workers double, "
                                                  "peak_srv_io double, avg_rx double, avg_cpu double")
    assert [r["verdict"] for r in tel.verdict(df).collect()] == [v for _, v in cases]


def test_grades(spark):
    rows = [("write_rows_per_sec", 5e5, "PASS"), ("write_rows_per_sec", 499_999.0, "WARN"), ("read_rows_per_sec", 5e4, "PASS"),
            ("round_trip_ms", 200.0, "WARN"), ("connect_ms", 499.0, "PASS"), ("round_trip_label_ms", 50.0, "WARN"), ("other", 1.0, None)]
    df = small_frame(spark, rows, "metric string, value double, want string")
    assert all(r["grade"] == r["want"] for r in tel.grade(df).collect())


def test_ramp_and_knee(spark):
    rows = [("a", 1, 1000, 1.0), ("a", 2, 1900, 1.0), ("a", 4, 2000, 1.0), ("a", 8, 2010, 1.0),
            ("b", 1, 0, 0.0), ("b", 2, 10, 0.0), ("c", 1, 10, 1.0), ("c", 2, 30, 1.0)]
    ramped = thr.ramp(small_frame(spark, rows, "run string, step int, rows bigint, elapsed double"), ["run"])
    gains = {(r["run"], r["step"]): round(r["gain_pct"], 3) for r in ramped.collect()}
    assert gains[("a", 1)] == 100 and gains[("a", 2)] == 90 and gains[("a", 4)] == 5.263 and gains[("b", 2)] == 100
    assert {r["run"]: r["knee"] for r in thr.knee(ramped, ["run"]).collect()} == {"a": 4, "b": None, "c": None}


def test_compare_runs(spark):
    rows = [(1, "x", 10.0, 1000, False), (1, "y", 50.0, 900, False), (2, "x", 10.0, 5, True), (2, "y", 20.0, 5, False),
            (3, "y", 20.0, 5, False), (4, "x", 0.0, 5, False), (4, "y", 1.0, 5, False)]
    out = thr.compare_runs(small_frame(spark, rows, "run int, tool string, wall double, bytes bigint, failed boolean"), "x", "y")
    assert {r["run"]: r["speedup"] for r in out.collect()} == {1: 5.0, 2: None, 3: None, 4: 1000.0}


def test_slow_statements(spark):
    rows = [(f"q{i}", at(60 * i), 1000.0 * i, 1 if i != 39 else 0, None if i == 40 else 10.0, 5.0) for i in range(41)]
    stats = spark.createDataFrame(rows, "query_text string, start_time timestamp_ntz, avg_duration_us double, executions bigint, avg_reads double, avg_cpu_us double")
    recent = statements.recent(stats, F.lit(at(60 * 40)).cast("timestamp_ntz"))
    assert recent.count() == 30  # 31 minutes hold a start, one was never executed
    top = statements.slowest(recent)
    assert [r["snippet"] for r in top.collect()] == ["q40", "q38", "q37", "q36", "q35", "q34", "q33", "q32", "q31", "q30"]
    first = top.first()
    assert (first["avg_duration_ms"], first["avg_reads"], first["flagged"]) == (40.0, 0.0, False)
    assert statements.insights(top).first()["healthy"]


def test_stream_over_many_files_equals_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("day", F.to_date("ts"))
    for i, day in enumerate(sorted(r["day"] for r in events.select("day").distinct().collect())[:6]):
        events.filter(F.col("day") == day).drop("day").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    seen = spark.read.parquet(f"{tmp_path}/in")
    stream = st.read_stream(spark, f"{tmp_path}/in", seen.schema, files_per_batch=2)
    drained = st.drain(st.heartbeat_stream(stream, ["event_type"], "10 days", seconds=3600), ["event_type"])
    got, want = drained.windows, thr.heartbeat(seen, ["event_type"], seconds=3600)
    assert want.count() > 0 and drained.late_rows == 0
    assert got.exceptAll(want.select(got.columns)).count() == 0 and want.select(got.columns).exceptAll(got).count() == 0


def test_rows_behind_the_watermark_are_reported(spark, tmp_path):
    for i, days in enumerate((20, 1, 0)):
        spark.createDataFrame([(T0 + dt.timedelta(days=days, seconds=s), "a") for s in range(3)], "ts timestamp_ntz, k string").coalesce(
            1).write.mode("append").parquet(f"{tmp_path}/in")
        import time
        time.sleep(1.1)                                  # files are read in the order of their times
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = st.read_stream(spark, f"{tmp_path}/in", schema, files_per_batch=1)
    drained = st.drain(st.heartbeat_stream(stream, ["k"], "1 hour"), ["k"])
    assert drained.late_rows > 0 and drained.windows.agg(F.sum("rows")).first()[0] < 9


def file_per_batch(rows, schema, folder, first=0):
    """One Parquet file for each list of rows, in the order in which a stream reads them."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(folder, exist_ok=True)
    for i, some in enumerate(rows, first):
        path = f"{folder}/part-{i:04d}.parquet"
        pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in some], schema=schema), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_late_rows_over_more_batches_than_a_query_remembers(spark, tmp_path):
    import pyarrow as pa

    schema = pa.schema([("ts", pa.timestamp("us")), ("k", pa.string())])
    rows = [[(at(60 * i), "a")] + ([(at(0), "a")] if i in (5, 6, 7) else []) for i in range(112)]
    file_per_batch(rows, schema, f"{tmp_path}/in")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = st.read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_batch=1)
        drained = st.drain(st.heartbeat_stream(stream, ["k"], "90 seconds"), ["k"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert drained.late_rows == 3 and drained.windows.agg(F.sum("rows")).first()[0] == 112


LONG = pytest.mark.skipif("TABLEPORT_LONG_TESTS" not in os.environ, reason="over three minutes")


@pytest.mark.parametrize("files,stop", [(12, 5), pytest.param(104, 103, marks=LONG)])
def test_stream_rates_equal_the_batch_over_edges_and_a_restart(spark, tmp_path, files, stop):
    import pyarrow as pa

    rnd = random.Random(files)
    schema = pa.schema([("host", pa.string()), ("ts", pa.timestamp("us")), ("id", pa.int64()), ("rx", pa.int64())])
    samples = [(rnd.choice(["a", "b", None, "rare"] if i % 40 == 0 else ["a", "b", None]), None if i % 61 == 60 else at(i // 3), i, rnd.randint(0, 10**9))
               for i in range(files * 6)]
    mixed = sorted(samples, key=lambda r: r[2] + rnd.randint(0, 30))     # out of order by at most ten seconds
    groups = [mixed[i * 6:i * 6 + 6] for i in range(files)]
    late = ("a", at(-100), 10**6, 1)
    groups[4].append(late)
    file_per_batch(groups[:stop], schema, f"{tmp_path}/in")
    spark_schema = spark.read.parquet(f"{tmp_path}/in").schema

    def run():
        stream = st.read_stream(spark, f"{tmp_path}/in", spark_schema, files_per_batch=1)
        return st.drain_rates(stream, ["rx"], 12, tie="id", path=f"{tmp_path}/state")

    def rates(df):
        return sorted(((r["host"], r["id"], r["rx_mib_s"]) for r in df.collect()), key=lambda r: r[1])

    def batch(rows):
        return rates(tel.counter_rates(spark.createDataFrame(rows, spark_schema), ["rx"], tie="id"))

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        first = run()
        assert rates(first.rates) == batch([r for g in groups[:stop] for r in g if r != late]) and first.late_rows == 1
        file_per_batch(groups[stop:], schema, f"{tmp_path}/in", stop)
        second = run()
        assert rates(second.rates) == batch(samples) and second.late_rows == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_stream_rates_of_nothing(spark, tmp_path):
    import pyarrow as pa

    schema = pa.schema([("host", pa.string()), ("ts", pa.timestamp("us")), ("rx", pa.int64())])
    file_per_batch([[]], schema, f"{tmp_path}/in")
    stream = st.read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    drained = st.drain_rates(stream, ["rx"], 5)
    assert drained.rates.count() == 0 and drained.late_rows == 0


def test_union_all_keeps_every_copy(spark):
    frames = [spark.range(i).select("id") for i in range(6)]
    assert union_all(frames).count() == 15


def test_lag_keeps_rows_without_a_key_or_time(spark):
    rows = [("a", at(0), 1, 10), ("a", at(60), 2, 20), (None, at(5), 3, 30), (None, at(6), 4, 40), ("a", None, 5, 50)]
    df = spark.createDataFrame(rows, "host string, ts timestamp_ntz, id int, rx bigint")
    out = tel.counter_rates(df, ["rx"], tie="id")
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3, 4, 5]
