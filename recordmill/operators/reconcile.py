"""Comparing tables with their exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.fixed_values import FORBIDDEN_EXPORT_TERMS
from recordmill.functions.classify import is_fixture


def ids_missing_from_export(table: DataFrame, export: DataFrame, key: str) -> DataFrame:
    return table.select(key).distinct().join(export.select(key).distinct(), key, "left_anti")


def fixtures_in_export(fixtures: DataFrame, export: DataFrame, key: str) -> DataFrame:
    return fixtures.select(key).intersect(export.select(key))


def reconcile_counts(table: DataFrame, export: DataFrame, fixture: Column) -> DataFrame:
    """One row: table = production + fixtures, and production = export. Rows of both sides are
    tagged and counted together, so nothing has to be joined."""
    tagged = table.select(
        F.lit("table").alias("side"), F.coalesce(fixture, F.lit(False)).alias("fixture")
    ).unionByName(export.select(F.lit("export").alias("side"), F.lit(False).alias("fixture")))
    mine = F.col("side") == "table"
    counts = tagged.agg(
        F.count_if(mine).alias("table_rows"),
        F.count_if(mine & ~F.col("fixture")).alias("production_rows"),
        F.count_if(mine & F.col("fixture")).alias("fixture_rows"),
        F.count_if(~mine).alias("export_rows"),
    )
    return counts.withColumn(
        "reconciled",
        (F.col("table_rows") == F.col("production_rows") + F.col("fixture_rows"))
        & (F.col("production_rows") == F.col("export_rows")),
    )


def forbidden_terms(
    df: DataFrame, key: str, terms: list[str] = FORBIDDEN_EXPORT_TERMS
) -> DataFrame:
    """``(key, term)`` for every forbidden term in the serialised row."""
    text = F.to_json(F.struct(*df.columns))
    found = F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(text, t))
    return df.select(key, F.explode(found).alias("term"))


def suspects(df: DataFrame, table: str, url: str, name: str | None = None) -> DataFrame:
    return df.filter(is_fixture(table, F.col(url), F.col(name) if name else None))


def without_fixtures(df: DataFrame, table: str, url: str, name: str | None = None) -> DataFrame:
    return df.filter(~is_fixture(table, F.col(url), F.col(name) if name else None))
