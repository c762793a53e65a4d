"""Proofs about integer keys from bitmaps: a bucket of 32 768 neighbouring keys is 4 KB, whatever its rows.

Dense keys cross a shuffle as one bitmap per task and bucket instead of one tuple per key. Sparse keys would cost more
that way, so the share of a bucket that is used is measured first and decides between bitmaps and tuples; both give the
same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.names import column
from .constraints import orphan_keys

# a bitmap of a bucket weighs as much as this many tuples in a shuffle
DENSE_KEYS = 256


def _key(df: DataFrame, name: str) -> DataFrame:
    if not isinstance(df.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{name} is no integer column")
    return df.select(column(name).cast("bigint").alias("k")).where("k IS NOT NULL")


def is_dense(df: DataFrame, key: str) -> bool:
    """Whether a used bucket holds ``DENSE_KEYS`` keys or more on average; one pass, a sketch of buckets and of keys."""
    seen = _key(df, key).agg(
        F.approx_count_distinct("k").alias("keys"), F.approx_count_distinct(F.bitmap_bucket_number("k")).alias("buckets")).first()
    return seen["buckets"] > 0 and seen["keys"] >= DENSE_KEYS * seen["buckets"]


def key_bits(df: DataFrame, key: str) -> DataFrame:
    """(bucket, bits, rows) of an integer column without its NULLs; combined before the shuffle."""
    return _key(df, key).groupBy(F.bitmap_bucket_number("k").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"), F.count(F.lit(1)).alias("rows"))


def key_counts(df: DataFrame, key: str, dense: bool | None = None) -> DataFrame:
    """One row (rows, keys): rows with a key, and different keys. A key is unique if both are the same."""
    if is_dense(df, key) if dense is None else dense:
        per_bucket = key_bits(df, key).select("rows", F.bitmap_count("bits").alias("keys"))
    else:
        per_bucket = _key(df, key).groupBy("k").agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(1).cast("bigint").alias("keys"))
    return per_bucket.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"))


def repeated_keys(df: DataFrame, key: str, dense: bool | None = None) -> DataFrame:
    """(key, copies) of keys that several rows hold. With bitmaps, only buckets with more rows than bits are opened."""
    rows = _key(df, key)
    if is_dense(df, key) if dense is None else dense:
        doubled = key_bits(df, key).where(F.col("rows") > F.bitmap_count("bits")).select("bucket")
        rows = rows.withColumn("bucket", F.bitmap_bucket_number("k")).join(doubled, "bucket", "left_semi")
    return rows.groupBy(F.col("k").alias(key)).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, dense: bool | None = None) -> DataFrame:
    """(key, child_rows) of child keys without a parent, as ``orphan_keys`` gives them.

    With bitmaps, a bucket holds orphans if the bits of child and parent together are more than the parent's; only the
    rows of such buckets, of both sides, go on to the comparison of tuples.
    """
    child, parent = _key(child, child_key), _key(parent, parent_key)
    if (is_dense(child, "k") and is_dense(parent, "k")) if dense is None else dense:
        known = key_bits(parent, "k").select("bucket", F.bitmap_count("bits").alias("known"), "bits")
        both = key_bits(child, "k").select("bucket", F.lit(0).cast("bigint").alias("known"), "bits").unionByName(known)
        broken = both.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.max("known").alias("known")).where(
            F.bitmap_count("bits") > F.col("known")).select("bucket")
        child, parent = (side.withColumn("bucket", F.bitmap_bucket_number("k")).join(broken, "bucket", "left_semi").select("k")
                         for side in (child, parent))
    return orphan_keys(child, ["k"], parent, ["k"]).select(F.col("k").alias(child_key), "child_rows")
