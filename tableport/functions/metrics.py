"""Reading metric documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

METRIC_DOCUMENT = (
    "value array<struct<name: struct<value: string>, "
    "timeseries: array<struct<data: array<struct<average: double>>>>>>"
)


def parse_metrics(document: Column) -> Column:
    return F.from_json(document, METRIC_DOCUMENT)


def latest_average(parsed: Column, metric: str) -> Column:
    """Last non-null average of the first series of ``metric`` in a parsed document; 0 when there is none."""
    named = F.get(F.filter(parsed["value"], lambda m: m["name"]["value"] == metric), F.lit(0))
    points = F.get(named["timeseries"], F.lit(0))["data"]
    known = F.filter(points, lambda p: p["average"].isNotNull())
    return F.coalesce(F.get(known, F.size(known) - 1)["average"], F.lit(0.0))
