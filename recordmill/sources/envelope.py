"""The canonical envelope that every adapter produces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import blank_to_null

ENVELOPE = ["seq", "schemaVersion", "recordType", "source", "content", "collectedAt"]


def first_given(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def envelope(
    df: DataFrame, record_type: str, source_name: Column, url: Column, content: Column,
    collected_at: Column,
) -> DataFrame:
    return df.select(
        "seq",
        F.lit("1.0").alias("schemaVersion"),
        F.lit(record_type).alias("recordType"),
        F.struct(source_name.alias("name"), url.alias("url")).alias("source"),
        content.alias("content"),
        collected_at.alias("collectedAt"),
    )


def as_payload(records: DataFrame) -> DataFrame:
    """Envelopes of any type in one shape: the record as JSON beside its routing columns."""
    body = F.to_json(F.struct(*ENVELOPE[1:]), {"ignoreNullFields": "false"})
    return records.select(
        "seq", F.col("source.url").alias("url"), F.col("source.name").alias("source_name"),
        F.col("recordType").alias("record_type"), body.alias("payload"),
    )
