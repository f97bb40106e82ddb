"""Derived paper columns and standing paper queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.classify import enrichment_status
from recordmill.functions.jsonvalues import json_text
from recordmill.functions.text import (
    arxiv_id,
    blank_to_null,
    normalize_authors,
    normalize_title,
    paper_hash,
    strip,
)
from recordmill.functions.times import iso_date


def abstract_fallback(data_json: Column) -> Column:
    """First non-blank of content.abstract, content.summary, abstract, summary; null for none."""
    def at(path: str) -> Column:
        return blank_to_null(json_text(data_json, path))

    return blank_to_null(
        strip(F.coalesce(at("$.content.abstract"), at("$.content.summary"), at("$.abstract"), at("$.summary")))
    )


def category_fallback(data_json: Column) -> Column:
    return F.coalesce(
        blank_to_null(json_text(data_json, "$.content.primaryCategory")),
        blank_to_null(json_text(data_json, "$.primaryCategory")),
        F.lit("cs.AI"),
    )


def backfill_papers(df: DataFrame) -> DataFrame:
    """Recomputes the derived columns of stored papers. Needs ``source_url, title, authors,
    published_date, github_url, github_stars, data_json``."""
    return (
        df.withColumn("abstract", abstract_fallback(F.col("data_json")))
        .withColumn("primary_category", category_fallback(F.col("data_json")))
        .withColumn("authors", normalize_authors(F.col("authors")))
        .withColumn("arxiv_id", arxiv_id(F.col("source_url")))
        .withColumn("normalized_title", normalize_title(F.col("title")))
        .withColumn(
            "content_hash",
            paper_hash(
                F.col("title"), F.col("authors"), F.col("abstract"),
                iso_date(F.col("published_date")), F.col("source_url"), F.col("primary_category"),
            ),
        )
        .withColumn("enrichment_status", enrichment_status(F.col("github_url"), F.col("github_stars")))
    )


def recent_papers(df: DataFrame, since: Column, rows: int) -> DataFrame:
    """The newest papers from a date on; of equal ones those with the lowest arxiv_id, then id. What does
    not begin with a date is not dated."""
    dated = F.col("published_date").rlike(r"^\d{4}-\d{2}-\d{2}")
    found = df.filter(dated & (F.col("published_date") >= since))
    return found.orderBy(F.desc("published_date"), "arxiv_id", "id").limit(rows)


def papers_in_category(df: DataFrame, category: str) -> DataFrame:
    return df.filter(F.col("primary_category") == category)


def top_starred(df: DataFrame, rows: int) -> DataFrame:
    """The papers with the most stars; of equal ones those with the lowest arxiv_id, then id."""
    found = df.filter(F.col("github_stars").isNotNull())
    return found.orderBy(F.desc("github_stars"), "arxiv_id", "id").limit(rows)


def paper_by_id(df: DataFrame, wanted: str) -> DataFrame:
    return df.filter(F.col("arxiv_id") == wanted)


def pending_papers(df: DataFrame) -> DataFrame:
    return df.filter(F.col("enrichment_status") == "PENDING")
