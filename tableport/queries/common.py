"""Shared by the registered queries."""

from __future__ import annotations

from ..sources.tables import read_table, read_tables

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
CHUNKS = 8


def load(spark, root, name):
    return read_table(spark, root, name)


def load_all(spark, root):
    return read_tables(spark, root, TABLES)
