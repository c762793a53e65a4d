"""The bundle: ``manifest.json``, ``schema.json`` and ``data/<table>/_part=<i>/*.parquet``.

The manifest is written last and marks a complete bundle; without it a folder is not a bundle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import column, fresh, is_valid_fqn, table_dir
from ..session import path_exists, pinned, read_text, small_frame, write_text

# Manifest format.
FORMAT_VERSION = 2
READABLE_VERSIONS = (1, 2)
MANIFEST_SCHEMA = """
    writer_version string, format_version int, created_at string, source_host string, source_database string,
    tables array<struct<table_fqn: string, file_names: array<string>, file_name: string, row_count: bigint,
                        has_identity: boolean, identity_columns: array<string>>>,
    total_rows bigint, schema_only boolean
"""


def data_dir(fqn: str) -> str:
    return f"data/{table_dir(fqn)}"


def part_name(columns) -> str:
    """Name of the folder level that numbers the parts: ``_part``, or a longer name if the table has such a column.

    Partition values live in folder names, so a table column of that name would be lost. Readers take the
    part folders from the manifest and never need the name.
    """
    return fresh(columns, "_part")[0]


def write_manifest(spark: SparkSession, root: str, manifest: dict) -> None:
    write_text(spark, f"{root}/manifest.json", json.dumps(manifest, indent=1))


def write_schemas(spark: SparkSession, root: str, schemas: dict[str, T.StructType]) -> None:
    write_text(spark, f"{root}/schema.json",
               json.dumps({fqn: schema.jsonValue() for fqn, schema in schemas.items()}))


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest as one row; a missing file or a mistyped field is an error."""
    path = f"{root}/manifest.json"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path}: not a complete bundle")
    return (spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST")
            .option("multiLine", True).json(path))


def manifest_tables(manifest: DataFrame) -> DataFrame:
    """One row per listed table, with ``parts``: file_names, else the older file_name, else none."""
    t = manifest.select(F.inline("tables"))
    parts = (
        F.when(F.size(F.coalesce("file_names", F.array().cast("array<string>"))) > 0, F.col("file_names"))
        .when(F.coalesce("file_name", F.lit("")) != "", F.array("file_name"))
        .otherwise(F.array().cast("array<string>")))
    return t.withColumn("parts", parts).withColumn(
        "identity_columns", F.coalesce("identity_columns", F.array().cast("array<string>")))


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of the bundle's data files, relative to the root. Contents are not read."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
               .option("pathGlobFilter", "*.parquet").load(f"{root}/data").select("path", "length"))
    inside = F.substring_index("path", "/data/", -1)
    return listing.select(F.concat(F.lit("data/"), inside).alias("path"), F.col("length").alias("bytes"))


def missing_parts(tables: DataFrame, files: DataFrame) -> DataFrame:
    """Listed parts with no stored file (a part is a file, or a folder of files)."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    present = files.select(F.explode(F.array("path", folder)).alias("part")).distinct()
    listed = tables.select("table_fqn", F.explode("parts").alias("part"))
    return listed.join(present, "part", "left_anti")


def stored_counts(spark: SparkSession, root: str, tables: dict[str, list[str]],
                  schemas: dict[str, T.StructType]) -> DataFrame:
    """(table_fqn, part, rows) of the stored parts, from Parquet footers; one shuffle for all tables."""
    from ..plans.inventory import union_all

    frames = []
    for fqn, parts in tables.items():
        folder, part = f"{root}/{data_dir(fqn)}", part_name(schemas[fqn].names)
        df = (spark.read.schema(T.StructType([*schemas[fqn].fields, T.StructField(part, T.IntegerType())]))
              .option("basePath", folder).parquet(*[f"{root}/{p}" for p in parts]))
        frames.append(df.select(F.lit(fqn).alias("table_fqn"), column(part).alias("part")))
    return union_all(frames).groupBy("table_fqn", "part").agg(F.count(F.lit(1)).alias("rows"))


@dataclass(frozen=True)
class Bundle:
    root: str
    manifest: DataFrame
    tables: DataFrame
    schemas: dict[str, T.StructType]

    def parts(self) -> dict[str, list[str]]:
        """Part folders per table: bounded by tables times planned chunks."""
        return {r[0]: list(r[1]) for r in self.tables.select("table_fqn", "parts").collect()}

    def read(self, fqn: str, parts=None) -> DataFrame:
        spark = self.manifest.sparkSession
        chosen = parts if parts is not None else self.parts()[fqn]
        if not chosen:
            return spark.createDataFrame([], self.schemas[fqn])
        return spark.read.schema(self.schemas[fqn]).parquet(*[f"{self.root}/{p}" for p in chosen])


def open_bundle(spark: SparkSession, root: str) -> Bundle:
    manifest = pinned(read_manifest(spark, root))
    schema_path = f"{root}/schema.json"
    if not path_exists(spark, schema_path):
        raise FileNotFoundError(schema_path)
    schemas = {fqn: T.StructType.fromJson(value)
               for fqn, value in json.loads(read_text(spark, schema_path)).items()}
    return Bundle(root, manifest, manifest_tables(manifest), schemas)


def manifest_problems(manifest: DataFrame) -> DataFrame:
    """(scope, problem) for everything wrong with a manifest that needs no look at the data."""
    tables = manifest_tables(manifest)
    summed = F.aggregate("tables", F.lit(0).cast("bigint"), lambda acc, t: acc + F.coalesce(t["row_count"], F.lit(0)))
    head = manifest.select("format_version", "total_rows", F.coalesce(summed, F.lit(0)).alias("summed"))
    version_bad = ~F.coalesce(F.col("format_version").between(*READABLE_VERSIONS), F.lit(False))
    head_problems = head.select(F.lit("manifest").alias("scope"), F.explode(F.array_compact(F.array(
        F.when(version_bad, "unsupported format version"),
        F.when(F.col("total_rows").isNull(), "no total"),
        F.when(F.col("total_rows") != F.col("summed"), "total differs from the sum of its tables"),
    ))).alias("problem"))
    rows = F.col("row_count")
    table_problems = tables.select(F.coalesce("table_fqn", F.lit("?")).alias("scope"), F.explode(F.array_compact(F.array(
        F.when(~is_valid_fqn("table_fqn"), "invalid table name"),
        F.when(rows.isNull(), "no row count"),
        F.when(rows < 0, "negative row count"),
        F.when((F.size("parts") == 0) & (rows > 0), "rows but no parts"),
    ))).alias("problem"))
    repeated = tables.groupBy("table_fqn").count().filter("count > 1").select(
        F.col("table_fqn").alias("scope"), F.lit("listed more than once").alias("problem"))
    return head_problems.unionByName(table_problems).unionByName(repeated)


def check_bundle(spark: SparkSession, bundle: Bundle) -> DataFrame:
    """One row per table: parts listed and missing, manifest rows against rows in the footers."""
    lost = {tuple(r) for r in missing_parts(bundle.tables, stored_files(spark, bundle.root))
            .select("table_fqn", "part").collect()}
    listed = bundle.parts()
    readable = {fqn: kept for fqn, parts in listed.items()
                if fqn in bundle.schemas and (kept := [p for p in parts if (fqn, p) not in lost])}
    stored: dict[str, int] = {}
    if readable:
        counted = stored_counts(spark, bundle.root, readable, bundle.schemas)
        for r in counted.collect():
            stored[r["table_fqn"]] = stored.get(r["table_fqn"], 0) + r["rows"]
    found = small_frame(
        spark, [(fqn, len(parts), sum(f == fqn for f, _ in lost), stored.get(fqn, 0)) for fqn, parts in listed.items()],
        "table_fqn string, parts_listed int, parts_missing bigint, stored_rows bigint")
    return (bundle.tables.select("table_fqn", "row_count").join(found, "table_fqn")
            .withColumn("ok", (F.col("parts_missing") == 0) & (F.col("row_count") == F.col("stored_rows"))))
