"""Relational sources and targets through Spark's JDBC connector."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.names import split_fqn
from ..functions.types import SOURCE_CASTS
from ..plans.chunking import ChunkPlan, SINGLE, modulo_plan, split_key_range
from ..plans.order_stats import trim_overlaps


def quoted_name(fqn: str) -> str:
    """``[schema].[table]`` as a double-quoted name; a quote inside is doubled."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in split_fqn(fqn))


def quoted_column(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class JdbcDatabase:
    url: str
    properties: dict = field(default_factory=dict)
    batch_size: int = 1000  # rows per INSERT batch

    def source_sql(self, fqn: str, schema: T.StructType) -> str:
        """The declared columns one by one, with the casts their types need; computed and hidden ones are left out."""
        casts = {kind: cast for cast, kinds in SOURCE_CASTS.items() for kind in kinds}
        cells = []
        for f in schema.fields:
            meta = f.metadata or {}
            if not (meta.get("computed") or meta.get("hidden")):
                own = quoted_column(f.name)
                cast = casts.get(meta.get("sql_type", ""))
                cells.append(f"{cast.format(own)} AS {own}" if cast else own)
        return f"(SELECT {', '.join(cells)} FROM {quoted_name(fqn)}) source"

    def exists_sql(self, fqn: str) -> str:
        schema, table = ("'" + part.replace("'", "''") + "'" for part in split_fqn(fqn))
        return f"SELECT COUNT(*) AS n FROM information_schema.tables WHERE table_schema = {schema} AND table_name = {table}"

    def exists(self, spark: SparkSession, fqn: str) -> bool:
        """Asks the database's catalog; any failure to ask is an error, not a missing table."""
        return self._query(spark, self.exists_sql(fqn))[0][0] > 0

    def read(self, spark: SparkSession, fqn: str, plan: ChunkPlan | None = None,
             schema: T.StructType | None = None) -> DataFrame:
        """One partition per chunk: each task runs one query with that chunk's predicate.

        ``schema`` (declared columns) names the columns to read; without it the table is read as the driver sees it.
        """
        name = quoted_name(fqn) if schema is None else self.source_sql(fqn, schema)
        if plan is None or plan.parts == 1:
            return spark.read.jdbc(self.url, name, properties=self.properties)
        return spark.read.jdbc(self.url, name, predicates=plan.predicates(), properties=self.properties)

    def bounds_sql(self, fqn: str, key: str) -> str:
        k = quoted_column(key)
        return (f"SELECT MIN({k}) AS lo, MAX({k}) AS hi, COUNT({k}) AS known_rows, COUNT(*) AS all_rows "
                f"FROM {quoted_name(fqn)}")

    def ntile_sql(self, fqn: str, key: str, n: int) -> str:
        k = quoted_column(key)
        return (f"SELECT bk, MIN(k) AS lo, MAX(k) AS hi FROM (SELECT {k} AS k, NTILE({int(n)}) OVER (ORDER BY {k}) AS bk "
                f"FROM {quoted_name(fqn)} WHERE {k} IS NOT NULL) t GROUP BY bk")

    def _query(self, spark: SparkSession, sql: str):
        return spark.read.format("jdbc").options(url=self.url, query=sql, **self.properties).load().collect()

    def plan(self, spark: SparkSession, fqn: str, strategy: str, key: str | None, n: int) -> ChunkPlan:
        """Cuts from a small aggregate that the database itself runs; at most n rows come back."""
        if strategy == "modulo":
            return modulo_plan(key, n)
        if strategy == "range":
            (row,) = self._query(spark, self.bounds_sql(fqn, key))
            lo, hi = row[0], row[1]
            if lo is None or lo >= hi or n <= 1:
                return SINGLE
            return ChunkPlan("range", key, tuple(split_key_range(int(lo), int(hi), n)))
        if strategy == "ntile":
            rows = sorted((int(r[0]), int(r[1]), int(r[2])) for r in self._query(spark, self.ntile_sql(fqn, key, n)))
            ranges = trim_overlaps([(lo, hi) for _, lo, hi in rows])
            return ChunkPlan("ntile", key, tuple(ranges)) if ranges else SINGLE
        return SINGLE

    def append(self, df: DataFrame, fqn: str) -> None:
        df.write.mode("append").option("batchsize", self.batch_size).jdbc(
            self.url, quoted_name(fqn), properties=self.properties)
