"""Joins over the data dictionary: columns, keys and foreign keys.

All inputs are a few rows per table or constraint, whatever the tables hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.types import declared_length, referential_action
from ..operators.constraints import Constraints
from ..session import small_frame


def key_columns(spark: SparkSession, constraints: Constraints) -> DataFrame:
    rows = [(key.table, key.name or "_".join((key.table, *key.columns)), key.primary, position, column,
             column in key.descending)
            for key in constraints.keys for position, column in enumerate(key.columns)]
    return small_frame(
        spark, rows, "table_name string, key_name string, is_primary boolean, position int, column_name string, "
              "is_descending boolean")


def foreign_key_columns(spark: SparkSession, constraints: Constraints) -> DataFrame:
    rows = [(fk.name, fk.child, fk.parent, position, child, parent, fk.on_delete, fk.on_update)
            for fk in constraints.foreign_keys
            for position, (child, parent) in enumerate(zip(fk.child_cols, fk.parent_cols))]
    return small_frame(
        spark, rows, "fk string, child string, parent string, position int, child_col string, parent_col string, "
              "on_delete string, on_update string")


def check_rows(spark: SparkSession, constraints: Constraints) -> DataFrame:
    rows = [(c.table, c.name, c.condition, c.disabled, c.untrusted) for c in constraints.checks]
    return small_frame(
        spark, rows, "table_name string, name string, condition string, is_disabled boolean, is_not_trusted boolean")


def describe(columns: DataFrame, keys: DataFrame, fks: DataFrame) -> DataFrame:
    """Every column with its declared type text, place in the primary key and referenced column."""
    in_key = keys.filter("is_primary").select(
        F.col("table_name").alias("kt"), F.col("column_name").alias("kc"), F.col("position").alias("key_position"))
    # the column table joins twice: once as the child's column, once as the parent's
    parent = columns.select(F.col("table_name").alias("pt"), F.col("name").alias("pc"))
    refs = fks.join(parent, (F.col("parent") == F.col("pt")) & (F.col("parent_col") == F.col("pc"))).select(
        F.col("child").alias("ft"), F.col("child_col").alias("fc"),
        F.concat_ws(".", "pt", "pc").alias("referenced"))
    c = columns
    return (
        c.join(in_key, (c.table_name == F.col("kt")) & (c.name == F.col("kc")), "left")
        # a column does not count as a reference to itself
        .join(refs, (c.table_name == F.col("ft")) & (c.name == F.col("fc"))
              & (F.concat_ws(".", c.table_name, c.name) != F.col("referenced")), "left")
        .select("table_name", "ordinal", F.col("name").alias("column_name"),
                declared_length(F.col("sql_type"), F.col("max_length"), F.col("precision"), F.col("scale"))
                .alias("declared_type"), "key_position", "referenced")
    )


def single_column_keys(keys: DataFrame) -> DataFrame:
    """Keys with no second column, candidates for a chunk key."""
    more = keys.filter("position > 0").select(F.col("table_name").alias("t"), F.col("key_name").alias("k"))
    return keys.join(more, (F.col("table_name") == F.col("t")) & (F.col("key_name") == F.col("k")), "left_anti")


def key_listing(keys: DataFrame, listing: DataFrame) -> DataFrame:
    """Key columns in order with their direction: ``a ASC, b DESC``."""
    piece = F.struct("position", F.concat_ws(
        " ", "column_name", F.when(F.col("is_descending"), "DESC").otherwise("ASC")).alias("text"))
    return (keys.join(listing.select("table_name"), "table_name")
            .groupBy("table_name", "key_name", "is_primary")
            .agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
            .select("table_name", "key_name", "is_primary",
                    F.concat_ws(", ", F.transform("pieces", lambda p: p["text"])).alias("key_columns")))


def foreign_key_listing(fks: DataFrame) -> DataFrame:
    """Column pairs of each foreign key in order: ``a=b, c=d``, with its action clauses."""
    pair = F.struct("position", F.concat_ws("=", "child_col", "parent_col").alias("text"))
    return (fks.groupBy("fk", "child", "parent", "on_delete", "on_update")
            .agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
            .select("fk", "child", "parent",
                    F.concat_ws(", ", F.transform("pairs", lambda p: p["text"])).alias("column_pairs"),
                    referential_action(F.col("on_delete")).alias("on_delete"),
                    referential_action(F.col("on_update")).alias("on_update")))


def computed_listing(spark: SparkSession, columns: DataFrame, definitions) -> DataFrame:
    """Computed columns (table -> column -> definition) with their place and type at the target."""
    rows = [(table, name, text) for table, texts in definitions.items() for name, text in texts.items()]
    defined = small_frame(spark, rows, "table_name string, name string, definition string")
    return defined.join(columns.select("table_name", "name", "ordinal", "sql_type"), ["table_name", "name"])


def check_listing(checks: DataFrame, listing: DataFrame) -> DataFrame:
    return checks.join(listing.select("table_name"), "table_name")
