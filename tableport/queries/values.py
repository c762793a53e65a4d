"""Type normalisation, SQL literals and names over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..functions import literals as lit, names, types as ty
from .common import load

# Declared types of an orders row as a source server would hold it.
ORDER_TYPES = T.StructType([
    ty.field("o_orderkey", "bigint", False, identity=True),
    ty.field("o_totalprice", "money"),
    ty.field("o_exact", "decimal", precision=38, scale=10),
    ty.field("o_single", "real"),
    ty.field("o_priority", "tinyint"),
    ty.field("o_open", "bit"),
    ty.field("o_day", "date"),
    ty.field("o_status", "nvarchar"),
])
EVENT_TYPES = T.StructType([
    ty.field("event_id", "bigint", False),
    ty.field("clock", "time"),
    ty.field("value", "smallmoney"),
    ty.field("day", "date"),
    ty.field("raw", "varbinary"),
])


def q17_normalize(spark, root):
    raw = load(spark, root, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_totalprice").cast("decimal(18,2)").alias("o_exact"),
        F.col("o_totalprice").cast("string").alias("o_single"),
        F.substring("o_orderpriority", 1, 1).alias("o_priority"),
        (F.col("o_orderstatus") == "O").cast("string").alias("o_open"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_status"))
    out = ty.normalise(raw, ORDER_TYPES)
    return out.select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("price_text"),
        F.col("o_exact").cast("string").alias("exact_text"), "o_single", "o_priority", "o_open",
        F.unix_date("o_day").alias("day_number"), "o_status")


def q17b_normalize_events(spark, root):
    raw = load(spark, root, "events").select(
        "event_id", F.col("ts").alias("clock"), "value", F.col("ts").cast("date").alias("day"),
        F.encode("props", "UTF-8").alias("raw"))
    out = ty.normalise(raw, EVENT_TYPES)
    return out.select("event_id", F.col("clock").alias("micros"), F.col("value").cast("string").alias("value_text"),
                      F.unix_date("day").alias("day_number"), F.hex("raw").alias("raw_hex"))


def q18_guid(spark, root):
    digits = F.md5(F.col("o_orderkey").cast("string"))
    text = F.concat_ws("-", *[F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    raw = load(spark, root, "orders").select("o_orderkey", text.alias("guid"))
    stored = ty.normalise(raw, T.StructType([ty.field("o_orderkey", "bigint"), ty.field("guid", "uniqueidentifier")]))
    return stored.select("o_orderkey", F.hex("guid").alias("stored_hex"), ty.guid_text(F.col("guid")).alias("guid"),
                         F.octet_length("guid").alias("bytes"))


def q19_literals(spark, root):
    orders = load(spark, root, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("price"),
        (F.col("o_orderstatus") == "O").alias("is_open"),
        F.concat(F.lit("it's "), "o_orderpriority").alias("note"),
        F.encode("o_orderpriority", "UTF-8").alias("raw"), "o_orderdate", F.col("o_orderdate").cast("date").alias("day"))
    return orders.select("o_orderkey", lit.row_tuple(orders).alias("row_text"))


def q19b_event_literals(spark, root):
    events = load(spark, root, "events").select("event_id", "ts", lit.micros_of_day(F.col("ts")).alias("clock"),
                                                "value", "props")
    return events.select("event_id", lit.row_tuple(events, ["event_id", "ts", "clock", "value", "props"], ["clock"])
                         .alias("row_text"))


def q20_names(spark, root):
    fqn = names.qualified_name("p_brand", F.concat("p_name", F.lit("]'.x_")))
    return load(spark, root, "part").select(
        "p_partkey", fqn.alias("fqn"), names.sql_literal_body(fqn).alias("in_literal"),
        names.file_stem(fqn).alias("stem"), names.part_path(fqn).alias("whole_path"),
        names.part_path(fqn, F.col("p_size")).alias("part_path"), names.is_valid_fqn(fqn).alias("valid"),
        names.is_valid_fqn(names.qualified_name("p_brand", "p_name")).alias("plain_valid"))


QUERIES = {f.__name__: f for f in (
    q17_normalize, q17b_normalize_events, q18_guid, q19_literals, q19b_event_literals, q20_names)}

_FLOAT_TEXT = "regexp_replace(CAST(value AS VARCHAR), '\\.0$', '')"
ORACLES = {
    "q17_normalize": """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS VARCHAR) AS price_text,
        CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,10)) AS VARCHAR) AS exact_text,
        CAST(o_totalprice AS FLOAT) AS o_single, CAST(substr(o_orderpriority, 1, 1) AS SMALLINT) AS o_priority,
        o_orderstatus = 'O' AS o_open,
        CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day_number,
        nullif(o_orderstatus, 'P') AS o_status FROM orders""",
    "q17b_normalize_events": """SELECT event_id,
        epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS micros,
        CAST(CAST(value AS DECIMAL(10,4)) AS VARCHAR) AS value_text,
        CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_number,
        hex(encode(props)) AS raw_hex FROM events""",
    "q18_guid": """WITH m AS (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)
        SELECT o_orderkey, upper(h) AS stored_hex, CAST(16 AS INTEGER) AS bytes,
        substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
        || '-' || substr(h, 21, 12) AS guid FROM m""",
    "q19_literals": """SELECT o_orderkey, '(' || o_orderkey || ', '
        || CASE WHEN o_orderstatus = 'P' THEN 'NULL' ELSE 'N''' || o_orderstatus || '''' END || ', '
        || CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) || ', '
        || CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '0' END || ', N''it''''s ' || o_orderpriority || ''', 0x'
        || hex(encode(o_orderpriority)) || ', ''' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'', '''
        || strftime(o_orderdate, '%Y-%m-%d') || ''')' AS row_text FROM orders""",
    "q19b_event_literals": f"""SELECT event_id, '(' || event_id || ', ''' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
        || 'Z'', ''' || strftime(ts, '%H:%M:%S.%f') || ''', ' || {_FLOAT_TEXT} || ', N''' || props || ''')'
        AS row_text FROM events""",
    "q20_names": """WITH n AS (SELECT *, '[' || p_brand || '].[' || p_name || ']]''.x_]' AS fqn,
        p_brand || '_' || p_name || '''_x' AS st FROM part)
        SELECT p_partkey, fqn, replace(fqn, '''', '''''') AS in_literal, st AS stem,
        'data/' || st || '.parquet' AS whole_path, 'data/' || st || '.part' || p_size || '.parquet' AS part_path,
        false AS valid, true AS plain_valid FROM n""",
}
