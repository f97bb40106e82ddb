"""Joins that attach facts to rows. A side is broadcast only after it was measured
(:func:`recordmill.session.join_side`) or where Spark itself knows it to be under its threshold;
otherwise the join shuffles, and AQE splits skewed partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import github_url
from recordmill.session import join_side


def metadata_attach(pages: DataFrame, metadata: DataFrame) -> DataFrame:
    """Feed metadata by exact URL; pages without any keep nulls. The last metadata row of a URL
    counts. Pages carry their bodies, so they are spared the shuffle where the metadata is small."""
    latest = metadata.groupBy("url").agg(
        F.max_by(F.struct("title", "pub_date", "description"), "seq").alias("feed")
    )
    return pages.join(join_side(latest, "feed-metadata"), "url", "left")


def enrichment_state(url: Column, http_status: Column, stars: Column) -> Column:
    """``struct<status, stars>`` of one repository lookup. Missing stars stay null."""
    blank = F.trim(F.coalesce(url, F.lit(""))) == ""
    status = (
        F.when(blank, F.lit("NO_DATA"))
        .when(github_url(url).isNull(), F.lit("PERMANENT_FAILURE"))
        .when(http_status == 200, F.lit("COMPLETED"))
        .when(http_status == 404, F.lit("PERMANENT_FAILURE"))
        .when(http_status.isin(403, 429) | (http_status >= 500), F.lit("RETRYABLE_FAILURE"))
        .when(http_status.isNull(), F.lit("RETRYABLE_FAILURE"))
        .otherwise(F.lit("PERMANENT_FAILURE"))
    )
    return F.struct(status.alias("status"), F.when(status == "COMPLETED", stars).alias("stars"))


def enrich_repo_stats(papers: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Papers with the state and stars of their repository, by normalised address. The snapshot
    holds the newest answer per repository. Papers without a repository get join keys of their own,
    spread over many values: as nulls they would all meet in one partition."""
    answers = (
        snapshot.withColumn("repo", github_url(F.col("github_url")))
        .filter(F.col("repo").isNotNull())
        .groupBy("repo")
        .agg(F.max_by(F.struct("http_status", "stars"), "seq").alias("answer"))
    )
    spread = F.concat(F.lit("none:"), F.pmod(F.xxhash64(*papers.columns), F.lit(4096)).cast("string"))
    keyed = papers.withColumn("repo", github_url(F.col("github_url"))).withColumn(
        "_key", F.coalesce("repo", spread)
    )
    joined = keyed.join(answers.withColumnRenamed("repo", "_key"), "_key", "left").drop("_key")
    state = enrichment_state(F.col("github_url"), F.col("answer.http_status"), F.col("answer.stars"))
    return (
        joined.withColumn("state", state)
        .withColumn("enrichment_status", F.col("state.status"))
        .withColumn("github_stars", F.col("state.stars"))
        .drop("answer", "state")
    )


def enrichment_backlog(papers: DataFrame) -> DataFrame:
    """Papers an enrichment run still has to look at."""
    return papers.filter(~F.col("enrichment_status").isin("COMPLETED", "NO_DATA", "PERMANENT_FAILURE"))


def star_metrics(papers: DataFrame) -> DataFrame:
    has_url = F.trim(F.coalesce(F.col("github_url"), F.lit(""))) != ""
    return papers.agg(
        F.count(F.lit(1)).alias("papers"),
        F.count_if(has_url).alias("with_url"),
        F.count("github_stars").alias("with_stars"),
        F.min("github_stars").alias("min_stars"),
        F.max("github_stars").alias("max_stars"),
        F.round(F.sum("github_stars") / F.count("github_stars"), 4).alias("avg_stars"),
    )


def audit_reference_join(records: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Records beside external facts about the same key; records without facts are kept."""
    return records.join(facts, key, "left")


def startups_with_starred_papers(
    startups: DataFrame, papers: DataFrame, repos: DataFrame, stars: int = 5000
) -> DataFrame:
    """Startups having a paper whose repository has more than ``stars`` stars. The repository
    filter runs before both joins."""
    starred = repos.filter(F.col("stars") > stars).select("repo", "stars")
    linked = papers.join(starred, "repo")
    best = linked.groupBy("startup_id").agg(
        F.count(F.lit(1)).alias("papers"), F.max("stars").alias("max_stars")
    )
    return startups.join(best, "startup_id")
