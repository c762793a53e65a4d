"""Telemetry and throughput reports; events stand for metric samples, lineitem and orders for runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.metrics import latest_average, parse_metrics
from ..operators import statements, telemetry as tel, throughput as thr
from ..streaming import slots as st
from .common import load

MEASURES = ("cpu_pct", "mem_used_mb", "rx_mib_s", "srv_cpu", "srv_workers", "srv_io")
# which event type carries which measures: a source reports its own and leaves the others NULL
_WHOLE = "CAST(floor(value) AS DOUBLE)"  # sums of halves and eighths of whole numbers are exact in any order
SOURCES = {
    "cpu_pct": ("view", f"least({_WHOLE}, 100)"), "mem_used_mb": ("view", f"{_WHOLE} * 16"),
    "rx_mib_s": ("click", f"{_WHOLE} / 8"), "srv_cpu": ("purchase", f"least({_WHOLE} / 2, 100)"),
    "srv_workers": ("purchase", f"least({_WHOLE} / 4, 100)"), "srv_io": ("purchase", f"least({_WHOLE} / 2 + 1, 100)"),
}
# a growing counter with resets, in whole bytes
_COUNTER = "CAST(round(value * 100) AS BIGINT) * 10000"
# the events cover a month and come in no order
_DELAY = "60 days"


def _samples(events):
    return events.select(
        F.col("user_id").alias("host"), "ts", "event_id", F.col("ts").cast("date").alias("day"),
        *[F.when(F.col("event_type") == source, F.expr(text)).alias(m) for m, (source, text) in SOURCES.items()])


def _timeline(spark, root, keys=("host",), slot="1 hour"):
    return tel.timeline(_samples(load(spark, root, "events")), MEASURES, slot, keys, tie="event_id")


def q34_rate(spark, root):
    samples = load(spark, root, "events").select(
        F.col("user_id").alias("host"), "ts", "event_id", F.expr(_COUNTER).alias("rx_bytes"),
        F.col("event_id").alias("tx_bytes"))
    rates = tel.counter_rates(samples, ["rx_bytes", "tx_bytes"], tie="event_id")
    return rates.select("host", "event_id", "rx_bytes_mib_s", "tx_bytes_mib_s")


def q34b_rate_odd_hosts(spark, root):
    # users below 20 have no host, each sample of user 20 is a host of its own, and the views of a day are one burst
    samples = load(spark, root, "events").select(
        F.when(F.col("user_id") == 20, F.concat(F.lit("only "), F.col("event_id").cast("string")))
        .when(F.col("user_id") > 20, F.lit("busy")).alias("host"),
        F.when(F.col("event_type") == "view", F.date_trunc("DAY", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("ts"),
        "event_id", F.expr(_COUNTER).alias("rx_bytes"))
    return tel.counter_rates(samples, ["rx_bytes"], tie="event_id").select("host", "event_id", "rx_bytes_mib_s")


def q35_slots(spark, root):
    return _timeline(spark, root)


def _grid(spark, root):
    # purchases carry the server's values: a slow source, known for a day at most
    carry = ["srv_cpu", "srv_workers", "srv_io"]
    return tel.full_grid(_timeline(spark, root), MEASURES, "1 hour", ["host"], carry, max_age=24)


def q35c_full_grid(spark, root):
    return _grid(spark, root)


def q36c_summary_of_all_slots(spark, root):
    return tel.summary(_grid(spark, root), ["host"], zero_fill=True)


def q36_summary(spark, root):
    return tel.summary(_timeline(spark, root), ["host"])


def q36b_summary_zero_fill(spark, root):
    return tel.summary(_timeline(spark, root), ["host"], zero_fill=True)


def q37_verdict(spark, root):
    by_host = _timeline(spark, root, ("host", "day"), "10 minutes")
    return tel.verdict(tel.summary(by_host, ["host", "day"])).select("host", "day", "has_server", "verdict")


def q37b_grade(spark, root):
    per_user = load(spark, root, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("m"))
    metric = (F.when(F.col("event_type") == "view", "write_rows_per_sec").when(F.col("event_type") == "click", "read_rows_per_sec")
              .when(F.col("event_type") == "error", "round_trip_ms").when(F.col("event_type") == "signup", "connect_ms")
              .otherwise("round_trip_label_ms"))
    scaled = per_user.select("user_id", metric.alias("metric"), F.when(
        F.col("event_type") == "view", F.col("m") * 2500).when(F.col("event_type") == "click", F.col("m") * 300)
        .otherwise(F.col("m")).alias("value"))
    return tel.grade(scaled)


def _statement_stats(spark, root):
    """One interval per order: a five-way inner join down to the region."""
    lines = load(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("executions"), F.sum("l_quantity").alias("reads"))
    customer, nation = load(spark, root, "customer"), load(spark, root, "nation")
    return (
        lines.join(load(spark, root, "orders"), "o_orderkey")
        .join(customer, F.col("o_custkey") == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(load(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit(" SELECT\n"), "c_name", F.lit("\r\nFROM "), "n_name", F.lit("."), "r_name",
                     F.lit(" WHERE o = "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("query_text"),
            F.col("o_orderdate").alias("start_time"), (F.col("o_totalprice") * 30).alias("avg_duration_us"), "executions",
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("reads") * 500.0).alias("avg_reads"),
            (F.col("o_totalprice") * 7).alias("avg_cpu_us")))


def _top(spark, root):
    stats = _statement_stats(spark, root)
    newest = load(spark, root, "orders").agg(F.max("o_orderdate").alias("t")).first()["t"]
    return statements.slowest(statements.recent(stats, F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz"), minutes=180 * 24 * 60))


def q38_top10(spark, root):
    return _top(spark, root)


def q38b_insights(spark, root):
    return statements.insights(_top(spark, root))


def _ramp(spark, root):
    # each return flag is a run, each line number a step with that many connections
    steps = load(spark, root, "lineitem").groupBy(F.col("l_returnflag").alias("run"), F.col("l_linenumber").alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("l_tax").cast("decimal(18,2)")).cast("double").alias("elapsed"))
    return thr.ramp(steps, ["run"])


def q39_ramp(spark, root):
    return _ramp(spark, root)


def q40_knee(spark, root):
    return thr.knee(_ramp(spark, root), ["run"])


def q41_heartbeat(spark, root):
    return thr.heartbeat(load(spark, root, "events"), ["event_type"], seconds=30)


def q41b_progress(spark, root):
    finished = load(spark, root, "events").select("event_id", "ts")
    return thr.progress(finished, ["ts", "event_id"]).select("event_id", "done", "total")


def q41c_chunk_summary(spark, root):
    return thr.chunk_summary(load(spark, root, "events"), ["user_id"], size=F.octet_length("props").cast("bigint"))


def q43_json_metric(spark, root):
    document = F.format_string(
        '{"value":[{"name":{"value":"%s"},"timeseries":[{"data":[{"average":%s},{"average":%s},{"average":null}]},'
        '{"data":[{"average":-1}]}]},{"name":{"value":"%s"},"timeseries":[]}]}',
        "event_type", F.col("value").cast("string"), F.get_json_object("props", "$.k"), "event_type")
    events = load(spark, root, "events").select("event_id", parse_metrics(document).alias("m"))
    return events.select("event_id", latest_average(F.col("m"), "view").alias("view_average"),
                         latest_average(F.col("m"), "click").alias("click_average"))


def q45_stream_heartbeat(spark, root):
    events = st.read_stream(spark, root, load(spark, root, "events").schema, "events.parquet")
    return st.drain(st.heartbeat_stream(events, ["event_type"], _DELAY, seconds=3600), ["event_type"]).windows


def q45b_stream_slots(spark, root):
    events = st.read_stream(spark, root, load(spark, root, "events").schema, "events.parquet")
    return st.drain(st.timeline_stream(_samples(events), MEASURES, "1 hour", _DELAY, tie="event_id"), ["host"]).windows


def q45c_stream_rate(spark, root):
    events = st.read_stream(spark, root, load(spark, root, "events").schema, "events.parquet")
    samples = events.select(F.col("user_id").alias("host"), "ts", "event_id",
                            F.expr(_COUNTER).alias("rx_bytes"))
    return st.drain(st.rate_stream(samples, "rx_bytes", "1 day", _DELAY, tie="event_id"), ["host"]).windows


def q45d_stream_rate_over_edges(spark, root):
    """q34 from a stream: each sample has a rate, over every edge of days and micro-batches."""
    events = st.read_stream(spark, root, load(spark, root, "events").schema, "events.parquet")
    samples = events.select(F.col("user_id").alias("host"), "ts", "event_id", F.expr(_COUNTER).alias("rx_bytes"),
                            F.col("event_id").alias("tx_bytes"))
    rates = st.drain_rates(samples, ["rx_bytes", "tx_bytes"], 86_400, tie="event_id").rates
    return rates.select("host", "event_id", "rx_bytes_mib_s", "tx_bytes_mib_s")


def q46_compare_runs(spark, root):
    results = load(spark, root, "lineitem").groupBy(
        F.col("l_suppkey").alias("run"), F.col("l_linestatus").alias("tool")).agg(
        F.sum("l_quantity").alias("wall"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("bigint").alias("bytes"),
        (F.count(F.lit(1)) % 7 == 0).alias("failed"))
    return thr.compare_runs(results, "O", "F")


QUERIES = {f.__name__: f for f in (
    q34_rate, q34b_rate_odd_hosts, q35_slots, q35c_full_grid, q36_summary, q36c_summary_of_all_slots, q36b_summary_zero_fill, q37_verdict, q37b_grade, q38_top10, q38b_insights,
    q39_ramp, q40_knee, q41_heartbeat, q41b_progress, q41c_chunk_summary, q43_json_metric, q45_stream_heartbeat, q45b_stream_slots, q45c_stream_rate, q45d_stream_rate_over_edges, q46_compare_runs)}


def _slots_sql(keys, width):
    cols = ", ".join(
        f"arg_max({text}, (ts, event_id)) FILTER (WHERE event_type = '{source}') AS {m}"
        for m, (source, text) in SOURCES.items())
    return (f"SELECT {keys}, time_bucket(INTERVAL '{width}', ts) AS slot_start, {cols} "
            f"FROM (SELECT user_id AS host, CAST(ts AS DATE) AS day, * FROM events) GROUP BY ALL")


def _grid_sql(max_age):
    """Every hour of each host; the server's values carried for ``max_age`` hours at most."""
    server = [m for m, (source, _) in SOURCES.items() if source == "purchase"]
    local = ", ".join(m for m in SOURCES if m not in server)
    carried = ", ".join(
        f"""CASE WHEN slot_start - last_value(CASE WHEN {m} IS NOT NULL THEN slot_start END IGNORE NULLS) OVER w
            <= INTERVAL {max_age} HOUR THEN last_value({m} IGNORE NULLS) OVER w END AS {m}""" for m in server)
    return f"""WITH s AS ({_slots_sql("host", "1 hour")}),
        g AS (SELECT host, unnest(generate_series(min(slot_start), max(slot_start), INTERVAL 1 HOUR)) AS slot_start FROM s GROUP BY host),
        j AS (SELECT g.host, g.slot_start, s.host IS NOT NULL AS sampled, s.* EXCLUDE (host, slot_start)
              FROM g LEFT JOIN s ON g.host = s.host AND g.slot_start = s.slot_start)
        SELECT host, slot_start, sampled, {local}, {carried} FROM j WINDOW w AS (PARTITION BY host ORDER BY slot_start)"""


def _summary_sql(keys, width, zero, slots=None):
    fill = (lambda c: f"coalesce({c}, 0)") if zero else (lambda c: c)
    server = "count(coalesce(srv_cpu, srv_workers, srv_io)) > 0"
    peaks = ", ".join(f"CASE WHEN {server} THEN greatest(coalesce(max({c}), 0), 0) END AS peak_{c}"
                      for c in ("srv_cpu", "srv_workers", "srv_io"))
    return f"""SELECT {keys}, count(*) AS slots, avg({fill('cpu_pct')}) AS avg_cpu,
        greatest(coalesce(max(rx_mib_s), 0), 0) AS peak_rx, avg({fill('rx_mib_s')}) AS avg_rx,
        {server} AS has_server, avg(srv_cpu) AS avg_srv_cpu, {peaks}
        FROM ({slots or _slots_sql(keys, width)}) GROUP BY {keys}"""


_STATS = """
    lines AS (SELECT l_orderkey, count(*) AS executions, sum(l_quantity) AS reads FROM lineitem GROUP BY 1),
    newest AS (SELECT max(o_orderdate) AS t FROM orders),
    stats AS (SELECT chr(32) || 'SELECT' || chr(10) || c_name || chr(13) || chr(10) || 'FROM ' || n_name || '.' || r_name
            || ' WHERE o = ' || o_orderkey || ' ' AS query_text, o_totalprice * 30 / 1000.0 AS avg_duration_ms, executions,
            CASE WHEN o_orderpriority <> '5-LOW' THEN reads * 500.0 ELSE 0.0 END AS avg_reads,
            o_totalprice * 7 / 1000.0 AS avg_cpu_ms
        FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, newest
        WHERE o_orderdate >= t - INTERVAL 180 DAY AND executions >= 1),
    top AS (SELECT substr(replace(replace(trim(substr(query_text, 1, 300)), chr(10), ' '), chr(13), ''), 1, 55) AS snippet,
        avg_duration_ms, executions, avg_reads, avg_cpu_ms, avg_duration_ms > 5000 AS flagged
        FROM stats ORDER BY avg_duration_ms DESC, query_text LIMIT 10)"""
_RAMP = """
    steps AS (SELECT l_returnflag AS run, l_linenumber AS step, count(*) AS rows,
        CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS elapsed FROM lineitem GROUP BY ALL),
    rated AS (SELECT *, rows / greatest(elapsed, 0.001) AS rows_per_sec FROM steps),
    lagged AS (SELECT *, lag(rows_per_sec) OVER (PARTITION BY run ORDER BY step) AS p FROM rated),
    ramped AS (SELECT run, step, rows, elapsed, rows_per_sec, rows_per_sec / step AS per_connection,
        CASE WHEN p > 0 THEN (rows_per_sec - p) / p * 100 ELSE 100 END AS gain_pct FROM lagged)"""

ORACLES = {
    "q34_rate": f"""WITH c AS (SELECT user_id AS host, event_id, ts, {_COUNTER} AS rx, epoch_us(ts) AS us FROM events),
        l AS (SELECT *, lag(rx) OVER w AS prx, lag(event_id) OVER w AS ptx, lag(us) OVER w AS pus
            FROM c WINDOW w AS (PARTITION BY host ORDER BY ts, event_id)),
        d AS (SELECT host, event_id, CASE WHEN pus IS NOT NULL THEN greatest(rx - prx, 0) END AS drx,
            CASE WHEN pus IS NOT NULL THEN greatest(event_id - ptx, 0) END AS dtx,
            nullif(us - pus, 0) / 1000000.0::DOUBLE AS sec FROM l)
        SELECT host, event_id, drx / sec / 1048576.0::DOUBLE AS rx_bytes_mib_s,
            dtx / sec / 1048576.0::DOUBLE AS tx_bytes_mib_s FROM d""",
    "q34b_rate_odd_hosts": f"""WITH c AS (SELECT CASE WHEN user_id = 20 THEN 'only ' || event_id WHEN user_id > 20 THEN 'busy' END AS host,
            event_id, {_COUNTER} AS rx, epoch_us(CASE WHEN event_type = 'view' THEN date_trunc('day', ts) ELSE ts END) AS us FROM events),
        l AS (SELECT *, lag(rx) OVER w AS prx, lag(us) OVER w AS pus FROM c WINDOW w AS (PARTITION BY host ORDER BY us, event_id))
        SELECT host, event_id, CASE WHEN pus IS NOT NULL THEN greatest(rx - prx, 0) END
            / (nullif(us - pus, 0) / 1000000.0::DOUBLE) / 1048576.0::DOUBLE AS rx_bytes_mib_s FROM l""",
    "q35_slots": _slots_sql("host", "1 hour"),
    "q35c_full_grid": _grid_sql(24),
    "q36c_summary_of_all_slots": _summary_sql("host", "1 hour", True, _grid_sql(24)),
    "q36_summary": _summary_sql("host", "1 hour", False),
    "q36b_summary_zero_fill": _summary_sql("host", "1 hour", True),
    "q37_verdict": f"""SELECT host, day, has_server, CASE WHEN has_server AND peak_srv_cpu > 80 THEN 'server cpu'
        WHEN has_server AND peak_srv_workers > 80 THEN 'server workers' WHEN has_server AND peak_srv_io > 80 THEN 'server io'
        WHEN avg_rx < 5 THEN 'network' WHEN avg_cpu > 60 THEN 'local cpu' ELSE 'none' END AS verdict
        FROM ({_summary_sql('host, day', '10 minutes', False)})""",
    "q37b_grade": """WITH m AS (SELECT user_id, event_type, max(value) AS m FROM events GROUP BY ALL)
        SELECT user_id, CASE event_type WHEN 'view' THEN 'write_rows_per_sec' WHEN 'click' THEN 'read_rows_per_sec'
            WHEN 'error' THEN 'round_trip_ms' WHEN 'signup' THEN 'connect_ms' ELSE 'round_trip_label_ms' END AS metric,
        CASE event_type WHEN 'view' THEN m * 2500 WHEN 'click' THEN m * 300 ELSE m END AS value,
        CASE WHEN CASE event_type WHEN 'view' THEN m * 2500 >= 500000 WHEN 'click' THEN m * 300 >= 50000
            WHEN 'error' THEN m < 200 WHEN 'signup' THEN m < 500 ELSE m < 50 END THEN 'PASS' ELSE 'WARN' END AS grade FROM m""",
    "q38_top10": f"WITH {_STATS} SELECT * FROM top",
    "q38b_insights": f"""WITH {_STATS}, p AS (SELECT max(avg_duration_ms) AS max_ms, max(avg_reads) AS max_reads FROM top)
        SELECT max_ms, max_reads, max_ms > 10000 AS slow, max_reads > 100000 AS heavy_reads,
        max_ms <= 10000 AND max_reads <= 100000 AS healthy FROM p""",
    "q39_ramp": f"WITH {_RAMP} SELECT * FROM ramped",
    "q40_knee": f"""WITH {_RAMP} SELECT run, min(step) FILTER (WHERE gain_pct < 10 AND step > 1) AS knee,
        max(step) AS last_step FROM ramped GROUP BY run""",
    "q41_heartbeat": """SELECT event_type, time_bucket(INTERVAL '30 seconds', ts) AS slot_start, count(*) AS rows,
        count(*) / 30.0::DOUBLE AS rows_per_sec FROM events GROUP BY ALL""",
    "q41b_progress": """SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS done,
        (SELECT count(*) FROM events) AS total FROM events""",
    "q41c_chunk_summary": """WITH g AS (SELECT user_id, count(*) AS rows, CAST(sum(strlen(props)) AS BIGINT) AS bytes,
            (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS seconds FROM events GROUP BY 1)
        SELECT *, rows / greatest(seconds, 0.001) AS rows_per_sec, bytes / greatest(seconds, 0.001) / 1048576.0::DOUBLE
        AS mib_per_sec FROM g""",
    "q43_json_metric": """SELECT event_id,
        CASE WHEN event_type = 'view' THEN CAST(json_extract(props, '$.k') AS DOUBLE) ELSE 0 END AS view_average,
        CASE WHEN event_type = 'click' THEN CAST(json_extract(props, '$.k') AS DOUBLE) ELSE 0 END AS click_average FROM events""",
    "q45_stream_heartbeat": """SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS slot_start,
        count(*) AS rows, count(*) / 3600.0::DOUBLE AS rows_per_sec FROM events GROUP BY ALL""",
    "q45b_stream_slots": _slots_sql("host", "1 hour"),
    "q45c_stream_rate": f"""WITH g AS (SELECT user_id AS host, time_bucket(INTERVAL '1 day', ts) AS slot_start,
            arg_min({_COUNTER}, (ts, event_id)) AS a, arg_max({_COUNTER}, (ts, event_id)) AS b,
            nullif(epoch_us(max(ts)) - epoch_us(min(ts)), 0) AS us FROM events GROUP BY ALL)
        SELECT host, slot_start, greatest(b - a, 0) / (us / 1000000.0::DOUBLE) / 1048576.0::DOUBLE AS mib_per_sec
        FROM g""",
    "q46_compare_runs": """WITH r AS (SELECT l_suppkey AS run, l_linestatus AS tool, sum(l_quantity) AS wall,
            CAST(trunc(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS BIGINT) AS bytes, count(*) % 7 = 0 AS failed FROM lineitem GROUP BY ALL),
        a AS (SELECT * FROM r WHERE tool = 'O'), b AS (SELECT * FROM r WHERE tool = 'F')
        SELECT run, a.wall AS our_wall, a.bytes AS our_bytes, a.failed AS our_failed, b.wall AS other_wall,
        b.bytes AS other_bytes, b.failed AS other_failed, a.bytes / greatest(a.wall, 0.001) AS our_bytes_per_sec,
        b.bytes / greatest(b.wall, 0.001) AS other_bytes_per_sec,
        CASE WHEN NOT a.failed AND NOT b.failed THEN b.wall / greatest(a.wall, 0.001) END AS speedup
        FROM a FULL JOIN b USING (run)""",
}
ORACLES["q45d_stream_rate_over_edges"] = ORACLES["q34_rate"]
