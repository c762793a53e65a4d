"""Where a restore writes: folders, catalog tables or a relational database."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.names import check_database_name, split_fqn, table_dir
from ..session import delete_path, move_path, path_exists
from .jdbc import JdbcDatabase


@dataclass(frozen=True)
class PathTarget:
    """One Parquet folder per table under ``root``."""

    root: str

    def location(self, fqn: str) -> str:
        return f"{self.root}/{table_dir(fqn)}"

    def exists(self, spark: SparkSession, fqn: str) -> bool:
        return path_exists(spark, self.location(fqn))

    def reset(self, spark: SparkSession, fqns) -> None:
        # only the folders about to be written, never the root itself
        for fqn in fqns:
            delete_path(spark, self.location(fqn))

    def staged(self) -> PathTarget:
        """A folder of its own beside the tables; readers of ``root`` skip its name."""
        return replace(self, root=f"{self.root}/_restore-{uuid.uuid4().hex}")

    def publish(self, spark: SparkSession, staged: PathTarget, fqns) -> None:
        """Rename tables out of ``staged``; those they replace go into it. If a rename fails, all are taken back."""
        aside, moved = replace(staged, root=f"{staged.root}/replaced"), []

        def move(source: str, place: str) -> None:
            move_path(spark, source, place)
            moved.append((source, place))

        try:
            for fqn in fqns:
                if self.exists(spark, fqn):
                    move(self.location(fqn), aside.location(fqn))
                move(staged.location(fqn), self.location(fqn))
        except Exception:
            for source, place in reversed(moved):
                move_path(spark, place, source)
            raise

    def append(self, df: DataFrame, fqn: str) -> None:
        df.write.mode("append").parquet(self.location(fqn))

    def read(self, spark: SparkSession, fqn: str, schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(self.location(fqn))


@dataclass(frozen=True)
class CatalogTarget:
    """Tables of one catalog database."""

    database: str
    default_schema: str = "main"

    def name(self, fqn: str) -> str:
        schema, table = split_fqn(fqn)
        # the database has no schemas below it, so other schemas than the default one stay in the name
        name = (table if schema == self.default_schema else f"{schema}__{table}").replace("`", "``")
        return f"`{self.database}`.`{name}`"

    def exists(self, spark: SparkSession, fqn: str) -> bool:
        return spark.catalog.tableExists(self.name(fqn))

    def reset(self, spark: SparkSession, fqns) -> None:
        check_database_name(self.database)
        spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        spark.sql(f"CREATE DATABASE `{self.database}`")

    def append(self, df: DataFrame, fqn: str) -> None:
        df.write.mode("append").format("parquet").saveAsTable(self.name(fqn))

    def read(self, spark: SparkSession, fqn: str, schema: T.StructType | None = None) -> DataFrame:
        return spark.table(self.name(fqn))


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a relational database; they must exist for a data-only restore."""

    url: str
    properties: dict = field(default_factory=dict)
    batch_size: int = 1000

    @property
    def database(self) -> JdbcDatabase:
        return JdbcDatabase(self.url, self.properties, self.batch_size)

    def exists(self, spark: SparkSession, fqn: str) -> bool:
        return self.database.exists(spark, fqn)

    def reset(self, spark: SparkSession, fqns) -> None:
        raise NotImplementedError("drop tables of a relational database with its own tools")

    def append(self, df: DataFrame, fqn: str) -> None:
        self.database.append(df, fqn)

    def read(self, spark: SparkSession, fqn: str, schema: T.StructType | None = None) -> DataFrame:
        return self.database.read(spark, fqn)
