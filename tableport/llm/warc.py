"""WARC archives of pages, and their index by an external merge.

``write_archives`` writes WARC 1.1 files (gzip) with Spark's text writer: a record is one value and the record
end (two CRLF) is the line separator. ``read_archives`` reads the files back, checks every payload against its
digest and gives one sorted run of index entries per archive. ``merge_runs`` cuts the key space into ranges,
sends each range the slice of every run that falls in it, and merges the slices with a loser tree, so that the
entries come out in one order of URL key and capture time over all archives.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path
from .common import partitions_of, quoted, sampled, with_fields

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
INDEX = ("archive string, seq long, page_id long, url_key string, captured string, offset long, "
         "record_type string, payload_bytes long, payload_digest string, refers_to long")


def _header(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def captures(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
             min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to) of every page.

    Of pages with equal payloads of at least ``min_bytes`` the one with the largest id is the original; the others
    refer to it. A null payload counts as empty, a null id as smaller than any other. Rows repeated with the largest
    id are all originals. Only digests that occur more than once are joined back; that side is written first, so
    the join is between two plain shuffles and AQE can split a digest that holds a large part of the pages.
    """
    text = F.coalesce(F.col(quoted(payload)), F.lit(""))
    narrow = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"), F.col(quoted(url)).alias("url"),
                          text.alias("payload"), F.octet_length(text).cast("long").alias("payload_bytes"),
                          F.sha1(text).alias("payload_digest"))
    repeated = (narrow.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
                .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
                .where((F.col("n") > 1) & F.col("original").isNotNull()).drop("n"))
    repeated = materialize(repeated, "warc-originals")
    refers = F.when(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    return (narrow.join(repeated, "payload_digest", "left").withColumn("refers_to", refers).drop("original"))


def write_archives(captured: DataFrame, path: str, average_bytes: float, archive_bytes: int = 32_000_000) -> None:
    """One WARC record per row of ``captures``, in gzip files of about ``archive_bytes`` before compression.

    ``average_bytes`` is the mean payload; it only sets how many records go into a file.

    The capture time is not in the pages; ids are given out in crawl order, so the id stands for the second.
    """
    per_file = max(1, int(archive_bytes / (average_bytes + 600)))
    revisit = F.col("refers_to").isNotNull()
    own = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    when = F.date_format(F.timestamp_seconds(F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:capture:"), own, F.lit(">"))),
        _header("WARC-Date", when),
        F.coalesce(_header("WARC-Target-URI", address), F.lit("")),
        F.when(revisit, F.concat(
            _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _header("WARC-Refers-To", F.concat(F.lit("<urn:capture:"), F.col("refers_to").cast("string"), F.lit(">")))
        )).otherwise(""),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF))
    (captured.select(F.concat(head, block).alias("value")).write
     .option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def records(content: bytes):
    """(offset, headers, block) of each record of an uncompressed WARC file."""
    end, at = RECORD_END.encode(), 0
    while at < len(content):
        stop = content.index(end, at)
        lines = content[at:stop].decode("utf-8").split(CRLF)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = stop + len(end)
        finish = start + int(headers["Content-Length"])
        yield at, headers, content[start:finish]
        if content[finish:finish + len(end)] != end:
            raise ValueError(f"the record at byte {at} has no end")
        at = finish + len(end)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels backwards, then the rest; empty for null."""
    rest = (url or "").partition("://")[2]
    host = rest
    for stop in "/?#":
        host = host.partition(stop)[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host):]


def _index_entry(archive: str, offset: int, headers: dict, block: bytes) -> tuple:
    import hashlib

    number = lambda urn: int(urn[len("<urn:capture:"):-1]) if urn and not urn.endswith(":none>") else None
    http, _, payload = block.partition(RECORD_END.encode())
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload at byte {offset} of {archive} does not fit its digest")
    return (archive, number(headers["WARC-Record-ID"]), url_key(headers.get("WARC-Target-URI")), headers["WARC-Date"],
            offset, kind, size, digest, number(headers.get("WARC-Refers-To")))


def _run_order(entry: tuple) -> tuple:
    """URL key, capture time, id (null first), place."""
    _, own, key, captured, offset, *_ = entry
    return key, captured, own is not None, own or 0, entry[0], offset


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One sorted run of index entries (``seq`` numbers it) per archive below ``path``, payloads verified."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
             .select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content"))

    def parse(batches):
        import gzip

        import pyarrow as pa

        fields = [f.split() for f in INDEX.split(", ")]
        types = {"string": pa.string(), "long": pa.int64()}
        for batch in batches:
            for i in range(batch.num_rows):             # one archive at a time in memory
                name, content = batch.column(0)[i].as_py(), gzip.decompress(batch.column(1)[i].as_py())
                run = sorted((_index_entry(name, *r) for r in records(content)), key=_run_order)
                rows = [(e[0], n, *e[1:]) for n, e in enumerate(run)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], types[kind]) for k, (_, kind) in enumerate(fields)],
                    names=[n for n, _ in fields])

    return files.mapInArrow(parse, INDEX)


def loser_tree(runs: list, order):
    """Merge sorted runs: each inner node holds the loser of its match, so a step replays one leaf-to-root path."""
    k = len(runs)
    heads = [iter(r) for r in runs]
    items = [next(h, None) for h in heads]
    keys = [None if x is None else order(x) for x in items]

    def beats(a, b):                                    # an ended run loses to every other
        if keys[b] is None:
            return keys[a] is not None or a < b
        return keys[a] is not None and (keys[a], a) <= (keys[b], b)

    losers, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while k and items[best] is not None:
        yield items[best]
        items[best] = next(heads[best], None)
        keys[best] = None if items[best] is None else order(items[best])
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2


def merge_runs(runs: DataFrame, ranges_per_partition: int = 4) -> DataFrame:
    """The index entries with ``part`` and ``place``: in that order they are sorted by URL key, time and id.

    ``runs`` is read twice, so it should be a written table. The cuts are sampled (key, time, id) triples, so a URL
    with a third of the captures is spread over several ranges. Only index entries are shuffled.
    """
    partitions = partitions_of(runs)
    wanted = partitions * ranges_per_partition
    order_of = lambda r: (r[0], r[1], r[2] is not None, r[2] or 0)
    drawn = sorted(order_of(r) for r in sampled(runs, ["url_key", "captured", "page_id"], 8 * wanted))
    cuts = sorted({drawn[i * len(drawn) // wanted] for i in range(1, wanted)}) if drawn else []

    @F.pandas_udf("int")
    def range_of(key, captured, own):
        import pandas as pd

        own = own.astype("object").where(own.notna(), None)
        return pd.Series([bisect_right(cuts, order_of((k, c, None if o is None else int(o))))
                          for k, c, o in zip(key, captured, own)], dtype="int32")

    sliced = (runs.withColumn("part", range_of("url_key", "captured", F.col("page_id")))
              .repartition(partitions, "part").sortWithinPartitions("part", "archive", "seq"))
    schema = with_fields(sliced.schema, ("place", "long"))

    def merge(batches):
        import pyarrow as pa

        def merged(part, slices):
            rows = [(*r, n) for n, r in enumerate(loser_tree(slices, lambda r: _run_order((r[0], *r[2:]))))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                    names=[f.name for f in schema])

        at, slices, kinds = None, [], None
        for batch in batches:
            kinds = [*[f.type for f in batch.schema], pa.int64()]
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[-1] != at:
                    yield from merged(at, slices)
                    at, slices = row[-1], []
                if not slices or slices[-1][-1][0] != row[0]:
                    slices.append([])
                slices[-1].append(row)
        yield from merged(at, slices)

    return sliced.mapInArrow(merge, schema)


def archive_pages(pages: DataFrame, path: str | None = None, payload: str = "html", **columns) -> DataFrame:
    """Write ``pages`` as WARC archives, read them back and give the merged index, one entry per page.

    The archives stay at ``path`` (a new scratch folder by default). An empty table gives no entry.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    average = pages.agg(F.avg(F.octet_length(F.col(quoted(payload))))).first()[0] or 0
    write_archives(captures(pages, payload=payload, **columns), path, average)
    return merge_runs(materialize(read_archives(spark, path), "warc-runs"))
