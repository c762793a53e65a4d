"""Proofs that two copies of a set of tables agree."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.names import column, file_stem
from ..plans.inventory import union_all


def reconcile(archive: DataFrame, live: DataFrame, key, rows: str = "row_count") -> DataFrame:
    """Counts of both sides by key with a status; nothing is lost on either side.

    Both inputs hold one row per key already, so a frequent key does not skew the join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    left = archive.select(*keys, F.col(rows).alias("archive_rows"))
    right = live.select(*keys, F.col(rows).alias("live_rows"))
    status = (
        F.when(F.col("archive_rows").isNull(), "MISSING_IN_ARCHIVE")
        .when(F.col("live_rows").isNull(), "MISSING_IN_LIVE")
        .when(F.col("archive_rows") != F.col("live_rows"), "MISMATCH")
        .otherwise("OK"))
    return left.join(right, keys, "full_outer").withColumn("status", status)


def assert_reconciled(report: DataFrame) -> None:
    bad = report.filter("status <> 'OK'").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*report.columns)).cast("string").alias("example")).first()
    if bad["n"]:
        raise ValueError(f"{bad['n']} table(s) do not reconcile, e.g. {bad['example']}")


def missing_results(planned: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Planned tables without a result."""
    return planned.join(results.select(key).distinct(), key, "left_anti")


def stem_collisions(names: DataFrame, fqn: str = "table_fqn") -> DataFrame:
    """File stems claimed by more than one table, with the first and last claimant by name."""
    stems = names.select(F.col(fqn).alias("fqn")).distinct().withColumn("stem", file_stem("fqn"))
    return stems.groupBy("stem").agg(
        F.min("fqn").alias("first_fqn"), F.max("fqn").alias("last_fqn"), F.count(F.lit(1)).alias("tables"),
    ).filter("tables > 1")


def merge_parts(parts: DataFrame, key: str = "table_fqn") -> DataFrame:
    """Per-part rows (key, part, path, rows) -> one row per table: rows and files in part order.

    A table has one entry per planned chunk, so the collected list is bounded by the plan.
    """
    entry = F.struct("part", "path")
    return parts.groupBy(key).agg(
        F.sum("rows").alias("row_count"), F.count(F.lit(1)).alias("parts"),
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["path"]).alias("file_names"))


def _row_hash(df: DataFrame) -> str:
    quoted = ["`" + name.replace("`", "``") + "`" for name in df.columns]
    # the hash skips NULLs, so their places are hashed too
    return "xxhash64(" + ", ".join(f"{c}, {c} IS NULL" for c in quoted) + ")"


def fingerprints(tables: Mapping[str, DataFrame], sums: Mapping[str, str] | None = None) -> DataFrame:
    """(table_name, row_count, fingerprint, key_sum): order-free content summary of each table.

    The fingerprint joins the sum and the xor of 64-bit row hashes, so it sees repeated rows as well.
    ``sums`` names one integer column per table to add up. One shuffle for all tables.
    """
    frames = []
    for name, df in tables.items():
        summed = column(sums[name]) if sums and name in sums else F.lit(None)
        frames.append(df.select(F.lit(name).alias("table_name"), F.expr(_row_hash(df)).alias("h"),
                                summed.cast("bigint").alias("k")))
    return union_all(frames).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.concat_ws(":", F.sum(F.col("h").cast("decimal(38,0)")).cast("string"),
                    F.hex(F.bit_xor("h"))).alias("fingerprint"),
        F.sum("k").alias("key_sum"))
