"""Startups from organisation JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import blank_to_null, strip
from recordmill.schemas import ORG
from recordmill.sources.envelope import envelope, first_given


def org_json_startups(df: DataFrame, collected_at: Column) -> DataFrame:
    """What the payload does not say stays null; nothing about staff or funding is made up."""
    org = df.withColumn("_org", F.from_json("raw_content", ORG))
    tail = F.substring_index("url", "/", -1)
    name = strip(F.coalesce(first_given(F.col("_org.name"), F.col("_org.login")), tail))
    blog = blank_to_null(F.col("_org.blog"))
    site = F.when(F.startswith(blog, F.lit("http")), blog).otherwise(F.concat(F.lit("https://"), blog))
    site = F.when(F.startswith(site, F.lit("http://")) | F.startswith(site, F.lit("https://")), site)
    description = blank_to_null(strip(F.col("_org.description")))
    raw_name = F.coalesce(first_given(F.col("_org.name"), F.col("_org.login")), tail)
    none = F.lit(None)
    content = F.struct(
        name.alias("entityName"),
        F.coalesce(description, strip(F.concat(raw_name, F.lit(" technology company")))).alias("description"),
        site.alias("website"),
        F.substring("_org.created_at", 1, 4).try_cast("bigint").alias("foundingYear"),
        blank_to_null(strip(F.col("_org.location"))).alias("hqLocation"),
        F.struct(
            none.cast("bigint").alias("employeeCount"),
            none.cast("double").alias("fundingTotalUsd"),
            none.cast("string").alias("lastFundingStage"),
            F.array(F.lit("Technology"), F.lit("Software & AI")).alias("industries"),
        ).alias("data"),
    )
    url = F.coalesce(first_given(F.col("_org.html_url")), F.col("url"))
    return envelope(org, "STARTUP", F.lit("GitHub Organizations"), url, content, collected_at)
