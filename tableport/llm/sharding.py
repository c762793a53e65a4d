"""Shards by extendible hashing.

The directory is indexed by the leading bits of a key hash. A bucket over the byte limit splits on the next bit,
and only that bucket, until every bucket fits. The splits follow from a histogram of bytes per hash prefix: it is
taken once, a few bits finer than an even spread would need, and only cells that are still too large are counted
again, finer. The histogram has a row per cell, never one per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import quoted, without

HASH_BITS = 60


def key_hash(key: str):
    """The first 60 bits of the MD5 of the key as text, a null key like an empty one."""
    text = F.coalesce(F.col(quoted(key)).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix_bits(h: str, depth: str) -> F.Column:
    """The first ``depth`` bits of ``h`` as text."""
    number = F.expr(f"conv(cast(shiftright({h}, {HASH_BITS} - {depth}) as string), 10, 2)")
    return F.lpad(number, F.expr(depth), F.lit("0"))


def _leaves(cells: DataFrame, bits: int, limit: int, within: list[str]) -> DataFrame:
    """(within, cell, depth) for every cell of a bucket that fits while the bucket around it does not."""
    depths = F.explode(F.sequence(F.lit(0), F.lit(bits)))
    by_depth = cells.select(*within, "cell", "bytes", depths.alias("depth"))
    fits = (by_depth.groupBy(*within, "depth", F.expr(f"shiftright(cell, {bits} - depth)").alias("bucket"))
            .agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") <= limit).drop("bytes"))
    around = fits.select(*within, (F.col("depth") + 1).alias("depth"), F.explode(F.array(
        F.col("bucket") * 2, F.col("bucket") * 2 + 1)).alias("bucket"))
    leaves = fits.join(around, [*within, "depth", "bucket"], "left_anti")
    span = F.expr(f"shiftleft(1L, {bits} - depth)")
    inside = F.explode(F.sequence(F.col("bucket") * span, (F.col("bucket") + 1) * span - 1))
    return leaves.select(*within, "depth", inside.alias("cell"))


def _split(rows: DataFrame, limit: int, finer: int, within: list[str], last: bool) -> tuple[DataFrame, DataFrame]:
    """Rows with the ``depth`` of their bucket, and the rows whose full hash is still too large a bucket.

    ``last``: the latter get the full depth too.
    """
    largest = rows.groupBy(*within).agg(F.sum("bytes").alias("bytes")).agg(F.max("bytes")).first()[0] or 0
    bits = min(HASH_BITS, max(0, (largest // limit).bit_length()) + finer)
    done, pending = None, rows
    while True:
        prefix = F.shiftright(F.col("h"), HASH_BITS - bits)
        celled = pending.withColumn("cell", prefix)
        cells = materialize(celled.groupBy(*within, "cell").agg(F.sum("bytes").alias("bytes")), "shard-cells")
        joined = celled.join(_leaves(cells, bits, limit, within), [*within, "cell"], "left").drop("cell")
        fitting = joined.where(F.col("depth").isNotNull())
        done = fitting if done is None else done.unionByName(fitting)
        too_large = cells.where(F.col("bytes") > limit)
        if too_large.isEmpty():
            return done, None
        pending = celled.join(too_large, [*within, "cell"], "left_semi").drop("cell")
        if bits == HASH_BITS:
            return (done.unionByName(pending.withColumn("depth", F.lit(HASH_BITS))), None) if last else (done, pending)
        bits = min(HASH_BITS, bits + 16)


def assign_shards(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text",
                  finer: int = 6) -> DataFrame:
    """``docs`` without ``text``, with ``shard`` (hash prefix as bits), ``page`` and ``row_bytes``.

    A shard is a bucket of the directory and holds at most ``limit`` bytes of text (UTF-8; null counts 0). Rows of
    one key share their bucket. A key that alone is over the limit gets overflow pages: the hash of the whole row
    gives further bits, and ``page`` is a second prefix of as many bits as its pages need; elsewhere ``page`` is
    empty. Rows equal in every column stay together, so identical rows that outgrow the limit are one page, as is a
    single row above the limit. An empty table gives no rows; columns named like a new one are replaced.

    The documents are read once into a narrow table (no text); histogram cells are pre-aggregated before the shuffle.
    """
    rest = without(docs, "shard", "page", "row_bytes", text)
    own = [F.col(quoted(c)).alias(f"c_{i}") for i, c in enumerate(rest.columns)]
    size = F.coalesce(F.octet_length(F.col(quoted(text))), F.lit(0)).cast("long").alias("bytes")
    content = [F.col(quoted(c)) for c, kind in docs.dtypes if "map<" not in kind]
    hashed = materialize(docs.select(*own, size, key_hash(key).alias("h"), F.shiftrightunsigned(
        F.xxhash64(*content), 64 - HASH_BITS).alias("h_row")), "shard-keys")
    placed, large = _split(hashed, limit, finer, [], last=False)
    names = [F.col(f"c_{i}").alias(c) for i, c in enumerate(rest.columns)]
    out = placed.select(*names, _prefix_bits("h", "depth").alias("shard"), F.lit("").alias("page"),
                        F.col("bytes").alias("row_bytes"))
    if large is None:
        return out
    keyed = large.withColumns({"shard": _prefix_bits("h", str(HASH_BITS)), "h": F.col("h_row")})
    paged, _ = _split(keyed, limit, finer, ["shard"], last=True)
    return out.unionByName(paged.select(*names, "shard", _prefix_bits("h", "depth").alias("page"),
                                        F.col("bytes").alias("row_bytes")))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """``docs`` as Parquet folders ``shard=.../page=...``; ``key`` must be unique (a row without one is a key too).
    Overflow needs no special case, because the shuffle is by shard and page and AQE may split it."""
    where = assigned.select(F.col(quoted(key)).alias("_op_key"), "shard", "page").dropDuplicates()
    keyed = docs.join(where, docs[quoted(key)].eqNullSafe(where["_op_key"])).drop("_op_key")
    keyed.hint("rebalance", "shard", "page").write.partitionBy("shard", "page").parquet(path)
