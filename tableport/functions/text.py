"""Text shaping for statement reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def statement_text(c: Column) -> Column:
    """First 300 characters, trimmed, on one line."""
    head = F.regexp_replace(F.substring(c, 1, 300), r"^\s+|\s+$", "")
    return F.translate(head, "\n\r", " ")


def snippet(c: Column, width: int = 55) -> Column:
    return F.substring(c, 1, width)
