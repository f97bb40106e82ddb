"""Tolerant JSON access: broken input gives nulls or empties, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.text import strip


def json_text(c: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(c), path, "string")


def authors_from_json(c: Column) -> Column:
    """JSON list to array of strings; anything else gives an empty array."""
    parsed = F.try_variant_get(F.try_parse_json(c), "$", "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def external_ids(c: Column) -> Column:
    """Map entries as ``array<struct<key, value>>``: lower case, trimmed, blank values dropped."""
    cleaned = F.transform(
        F.map_entries(c),
        lambda e: F.struct(
            F.lower(strip(e["key"])).alias("key"), F.lower(strip(e["value"])).alias("value")
        ),
    )
    return F.filter(cleaned, lambda e: F.coalesce(e["value"], F.lit("")) != "")
