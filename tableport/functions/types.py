"""Declared source types and how they become Spark types.

A column's declared type travels in field metadata under ``sql_type`` (with ``precision``, ``scale``,
``max_length``, ``identity``, ``generated``, ``default``), so a bundle keeps what Spark types drop.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .names import column
from .times import utc_instant

# Declared type -> Spark type. Types not listed become strings.
SPARK_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "bit": T.BooleanType(),
    "float": T.DoubleType(),
    "real": T.FloatType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "char": T.StringType(),
    "varchar": T.StringType(),
    "text": T.StringType(),
    "nchar": T.StringType(),
    "nvarchar": T.StringType(),
    "ntext": T.StringType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "image": T.BinaryType(),
    "timestamp": T.BinaryType(),
    "rowversion": T.BinaryType(),
    "datetime": T.TimestampType(),
    "smalldatetime": T.TimestampType(),
    "datetime2": T.TimestampType(),
    "datetimeoffset": T.TimestampType(),
    "date": T.DateType(),
    "time": T.LongType(),  # microseconds since midnight
    "uniqueidentifier": T.BinaryType(),
    "xml": T.StringType(),
    "json": T.StringType(),
    "sql_variant": T.StringType(),
    "hierarchyid": T.StringType(),
    "geography": T.BinaryType(),
    "geometry": T.BinaryType(),
}
# What a relational source computes itself, because a driver cannot read the type or reads it inexactly.
SOURCE_CASTS = {
    "CAST({} AS NVARCHAR(MAX))": ("xml", "sql_variant"),
    "CAST({} AS DECIMAL(19,4))": ("money",),
    "CAST({} AS DECIMAL(10,4))": ("smallmoney",),
    "{}.ToString()": ("hierarchyid",),
    "{}.STAsBinary()": ("geography", "geometry"),
    "CAST({} AS VARBINARY(8))": ("timestamp", "rowversion"),
}
# Types the source server must generate itself; a restore does not supply them.
GENERATED_TYPES = ("timestamp", "rowversion")
# Declared types without a length limit.
LARGE_OBJECT_TYPES = ("text", "ntext", "image")


def spark_type(sql_type: str, precision: int = 18, scale: int = 0) -> T.DataType:
    name = sql_type.lower()
    if name in ("decimal", "numeric"):
        return T.DecimalType(precision, scale)
    return SPARK_TYPES.get(name, T.StringType())


def field(name: str, sql_type: str, nullable: bool = True, precision: int = 18, scale: int = 0,
          **metadata) -> T.StructField:
    """A StructField carrying the declared type; ``metadata`` takes identity, seed, default, ..."""
    meta = {"sql_type": sql_type.lower(), "precision": precision, "scale": scale, **metadata}
    if sql_type.lower() in GENERATED_TYPES:
        meta["generated"] = True
    return T.StructField(name, spark_type(sql_type, precision, scale), nullable, meta)


def build_schema(columns: Iterable[Mapping]) -> T.StructType:
    """StructType from dictionary rows (``name``, ``sql_type``, ``nullable``, ...), order kept."""
    return T.StructType([field(**dict(column)) for column in columns])


def guid_bytes(text: Column) -> Column:
    """Canonical text GUID -> its 16 bytes in text order; NULL for a text of another length."""
    value = F.unhex(F.replace(text, F.lit("-"), F.lit("")))
    return F.when(F.octet_length(value) == 16, value)


def guid_text(value: Column) -> Column:
    """16 bytes -> canonical text; NULL for bytes of another length."""
    digits = F.lower(F.hex(value))
    pieces = [F.substring(digits, start, length)
              for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.octet_length(value) == 16, F.concat_ws("-", *pieces))


def _to_declared(column: Column, source: T.DataType, target: T.StructField) -> Column:
    sql_type = target.metadata.get("sql_type", "")
    if sql_type == "uniqueidentifier" and isinstance(source, T.StringType):
        return guid_bytes(column)
    if sql_type == "time" and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        from .literals import micros_of_day

        return micros_of_day(column, isinstance(source, T.TimestampType))
    if isinstance(target.dataType, T.TimestampType) and isinstance(source, T.TimestampNTZType):
        return utc_instant(column)
    return column.cast(target.dataType)


def normalise(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Project ``df`` onto declared columns, in declared order, cast to the declared types.

    A non-NULL value that does not convert stops the job with the column's name; a NULL stays NULL.
    tinyint is checked against 0..255 because its Spark type is wider.
    """
    sources = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for target in schema.fields:
        raw = column(target.name)
        if target.name not in sources:
            raise ValueError(f"column {target.name!r} is not in the source")
        source, value = sources[target.name], None
        special = target.metadata.get("sql_type") in ("uniqueidentifier", "time")
        if source == target.dataType and not special:
            value = raw
        elif strict and not special and not isinstance(source, T.TimestampNTZType):
            value = raw.try_cast(target.dataType)            # the error below names the column
        else:
            value = _to_declared(raw, source, target)
        bad = raw.isNotNull() & value.isNull()
        if target.metadata.get("sql_type") == "tinyint":
            bad = bad | ~value.between(0, 255)
        if strict and value is not raw or target.metadata.get("sql_type") == "tinyint":
            problem = F.lit(f"column {target.name}: value is not a {target.dataType.simpleString()}")
            value = F.when(bad, F.raise_error(problem).cast(target.dataType)).otherwise(value)
        out.append(value.alias(target.name, metadata=target.metadata))
    return df.select(*out)


# What stands in the brackets of a declared type.
SIZE_RULES = {
    "precision, scale": ("decimal", "numeric"),
    "scale": ("datetime2", "datetimeoffset", "time"),
    "bytes": ("binary", "varbinary", "char", "varchar"),
    "two-byte characters": ("nchar", "nvarchar"),
}


def declared_length(sql_type: Column, max_length: Column, precision: Column, scale: Column) -> Column:
    """Dictionary row -> declared type text: ``nvarchar(50)``, ``varchar(MAX)``, ``decimal(18,4)``."""
    def sized(units: int) -> Column:
        whole = F.floor(max_length / units).cast("bigint").cast("string")
        return F.when(max_length < 0, "MAX").otherwise(whole)

    brackets = {"precision, scale": F.concat_ws(",", precision.cast("string"), scale.cast("string")),
                "scale": scale.cast("string"), "bytes": sized(1), "two-byte characters": sized(2)}
    kinds = F.create_map(*[F.lit(x) for rule, names in SIZE_RULES.items() for name in names for x in (name, rule)])
    rule = kinds[F.lower(sql_type)]
    size = F.coalesce(*[F.when(rule == name, text) for name, text in brackets.items()])
    return F.when(rule.isNull(), sql_type).otherwise(F.concat(sql_type, F.lit("("), size, F.lit(")")))


def referential_action(action: Column) -> Column:
    """Dictionary action -> clause text; NO_ACTION and unknown give an empty text."""
    name = F.replace(F.upper(action), F.lit("_"), F.lit(" "))
    return F.when(name.isin("CASCADE", "SET NULL", "SET DEFAULT"), name).otherwise("")
