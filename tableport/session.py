"""Session settings and the shared scratch folder."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Settings the library is written for. ANSI casts are Spark 4's default and are relied on.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "tableport", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a missing setting is
    an error, because a driver-local path would not survive (or be seen by) the executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tableport-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tableport/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a checkpoint, keeps columns prunable, and survives executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows, schema: str | T.StructType) -> DataFrame:
    """A few metadata rows as a DataFrame of one task.

    ``createDataFrame`` spreads a list over every core and carries no size, so joins with it shuffle;
    a literal document is read in place and is known to be small.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = [dict(zip(struct.names, row)) for row in rows]
    document = F.from_json(F.lit(json.dumps(records)), T.ArrayType(struct), {"mode": "FAILFAST"})
    return spark.range(0, 1, 1, 1).select(F.inline(document))


def pinned(df: DataFrame) -> DataFrame:
    """A metadata-sized result (rows per table, column or part) computed once and kept as literals."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return small_frame(df.sparkSession, [tuple(r[n] for n in df.columns) for r in rows], df.schema)


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in a folder; none if it does not exist."""
    hadoop_path, fs = _hadoop_path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder. A target that exists already is an error."""
    old, fs = _hadoop_path(spark, source)
    new, _ = _hadoop_path(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise IOError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small metadata file; it appears under its name only when complete."""
    hadoop_path, fs = _hadoop_path(spark, path)
    pending, _ = _hadoop_path(spark, f"{path}.pending")
    stream = fs.create(pending, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(pending, hadoop_path):
        raise IOError(f"could not publish {path}")


def read_text(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise FileNotFoundError(path)
    return row[0]
