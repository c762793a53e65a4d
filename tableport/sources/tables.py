"""Tables stored as Parquet files or folders."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..functions.names import column


def table_path(root: str, name: str) -> str:
    return f"{root}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, name))


def read_tables(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    # opening a table reads a footer in a small job of its own; several run at a time
    with ThreadPoolExecutor(8) as pool:
        return dict(zip(names, pool.map(lambda name: read_table(spark, root, name), names)))


def full_scan(df: DataFrame, columns=None) -> DataFrame:
    """Every row, columns named one by one in catalog order (never ``*``)."""
    return df.select(*[column(c) for c in (columns or df.columns)])


def footer_bounds(spark: SparkSession, path: str, key: str) -> tuple[int | None, int | None, int, int]:
    """(min, max, non-null rows, all rows) of a key from Parquet footers, without reading the column.

    Aggregate pushdown needs the V2 Parquet reader; a second session keeps that switch out of the
    caller's one. Only for a bare column of plain files: a filter would turn the pushdown off. Files
    written without column statistics are read instead.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = footers.read.parquet(path)
    df.createOrReplaceTempView("footer_source")
    quoted = "`" + key.replace("`", "``") + "`"
    summary = f"SELECT min({quoted}), max({quoted}), count({quoted}), count(*) FROM footer_source"
    try:
        row = footers.sql(summary).first()
    except Py4JJavaError as error:
        if "min/max" not in str(error):                  # what a file without statistics is refused with
            raise
        footers.conf.set("spark.sql.parquet.aggregatePushdown", "false")
        footers.read.parquet(path).createOrReplaceTempView("footer_source")
        row = footers.sql(summary).first()
    return row[0], row[1], row[2], row[3]
