"""Validated envelopes as rows of the record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import arxiv_id, normalize_title, paper_hash

RECORD_TABLES = {
    "startups": "STARTUP", "products": "PRODUCT", "research_papers": "RESEARCH_PAPER", "jobs": "JOB", "news": "NEWS",
}


def table_rows(records: DataFrame, table: str, payload: str = "payload") -> DataFrame:
    """Rows of one record table from envelopes (``seq``, ``url``, ``payload``) of its type. What an
    envelope leaves out gets the table's default. The whole envelope is kept as ``data_json``."""
    value = F.col("_v")

    def at(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(value, f"$.{path}", kind)

    def text(path: str, default: str | None = "") -> Column:
        found = at(f"content.{path}")
        return found if default is None else F.coalesce(found, F.lit(default))

    columns = {
        "startups": {
            "entity_name": text("entityName"),
            "employee_count": at("content.data.employeeCount", "bigint"),
            "funding_total_usd": at("content.data.fundingTotalUsd", "double"),
        },
        "products": {
            "product_name": text("productName"), "startup_name": text("startupName"),
            "pricing_model": text("pricingModel", "UNKNOWN"),
        },
        "research_papers": {
            "title": text("title"),
            "authors_json": F.coalesce(F.to_json(at("content.authors", "array<string>")), F.lit("[]")),
            "paper_url": F.coalesce(at("content.paper_url"), at("source.url")),
            "github_url": text("github_url", None),
            "github_stars": at("content.github_stars", "bigint"),
            "published_date": text("published_date"),
            "abstract": text("abstract", None),
            "arxiv_id": F.coalesce(text("arxiv_id", None), arxiv_id(at("source.url"))),
            "normalized_title": F.coalesce(text("normalized_title", None), normalize_title(text("title"))),
            "primary_category": text("primaryCategory", None),
        },
        "jobs": {
            "company": text("company"), "published_date": text("date"),
            "is_remote": F.coalesce(at("content.is_remote", "boolean"), F.lit(False)),
            "role_family": text("role_family", "Engineering"),
        },
        "news": {
            "title": text("title"), "summary": text("summary"), "published_date": text("published_date"),
        },
    }[table]
    parsed = records.withColumn("_v", F.try_parse_json(payload))
    return parsed.select(
        "seq",
        F.coalesce(at("schemaVersion"), F.lit("1.0")).alias("schema_version"),
        at("source.name").alias("source_name"),
        at("source.url").alias("source_url"),
        *[c.alias(n) for n, c in columns.items()],
        F.col(payload).alias("data_json"),
        at("collectedAt").alias("collected_at"),
    )
