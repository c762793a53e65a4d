"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns whose names clash with those an operator is about to add (in any case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in taken])


def with_fields(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    """``schema`` and further nullable fields given as (name, DDL type)."""
    added = [T.StructField(name, T.StructType.fromDDL(f"x {ddl}")[0].dataType, True) for name, ddl in fields]
    return T.StructType([*schema.fields, *added])


def sampled(df: DataFrame, columns: list[str], size: int) -> list:
    """About ``size`` rows of ``columns``, chosen by their hash: the same rows for the same data.

    Only used to place the cuts of a range partitioning, never to decide a result.
    """
    step = max(1, df.count() // max(1, size))
    kept = df.where(F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in columns]), F.lit(step)) == 0)
    return kept.select(*[F.col(quoted(c)) for c in columns]).collect()


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory to the system. Worker processes live on after a task, and the allocators keep what it freed."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                    # another C library; nothing to trim
        pass


def sub_batches(batch, column: str, max_bytes: int):
    """Slices of an Arrow batch holding at most ``max_bytes`` of ``column`` each, and one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def written(df: DataFrame, name: str, group_bytes: int = 16 << 20, **layout) -> DataFrame:
    """``df`` written to the shared folder and read again, in row groups small enough for long arrays in many tasks.

    Parquet looks at the size of a group or page only after 100 rows, unless ``layout`` (options of the writer) says otherwise.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**layout).option("parquet.block.size", group_bytes).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20):
    """Queries run within send at most ``size`` bytes at a time to Python (or one row): for rows with long arrays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
