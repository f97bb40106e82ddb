"""Quality audits. Every report is one hash aggregate (or one per breakdown), so counting is done
before anything is shuffled. Duplicates are ``rows - distinct keys``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.classify import (
    content_defects,
    date_defect,
    evidence_strength,
    is_fixture,
    text_quality,
)
from recordmill.functions.text import is_repo_url
from recordmill.functions.times import iso8601


def _given(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _filled(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit(""))) != ""


def _accepted(condition: Column, published_at: Column) -> Column:
    """Publication time where the condition holds. As a timestamp its extremes fit a hash
    aggregate; those of a string would have all rows sorted first."""
    return F.when(condition, published_at.try_cast("timestamp"))


def fingerprint(key: Column) -> Column:
    """128 bits that stand for a value in distinct counts, so that counts of several keys, for which
    every row is repeated per key, shuffle two numbers instead of text. Null stays null."""
    return F.when(key.isNotNull(), F.struct(F.xxhash64(key), F.xxhash64(F.lit(1), key)))


def _identity(live: Column, url: str = "source_url") -> list[Column]:
    """Row counts and URL checks over the rows where ``live`` holds."""
    address = fingerprint(F.when(live, F.col(url)))
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(live).alias("production_rows"),
        F.count_if(~live).alias("fixture_rows"),
        F.count_distinct(address).alias("unique_urls"),
        (F.count_if(live) - F.count_distinct(address)).alias("duplicate_urls"),
        F.count_if(live & ~F.startswith(F.col(url), F.lit("http"))).alias("invalid_urls"),
    ]


def audit_papers(df: DataFrame) -> DataFrame:
    """Needs ``source_url, source_name, title, authors, published_date, abstract, github_url,
    github_stars``."""
    live = ~is_fixture("papers", F.col("source_url"))
    defects = content_defects(F.col("abstract"))
    dates = date_defect(F.col("published_date"))
    title = F.regexp_replace(F.lower(F.trim("title")), r"\s+", " ")
    day = F.substring(F.coalesce(F.col("published_date"), F.lit("")), 1, 10)
    rows = df.select(
        "source_url", "source_name", "github_url", "github_stars", live.alias("live"),
        defects.alias("defects"), dates.alias("dates"),
        F.coalesce(F.size("authors"), F.lit(0)).alias("n_authors"),
        fingerprint(F.when(live & _given("title"), title)).alias("title_key"),
        fingerprint(F.when(live, F.struct(F.coalesce(title, F.lit("")), day))).alias("title_day"),
        F.when(live, ~_filled("title")).alias("no_title"),
    )
    on = F.col("live")
    length = F.col("defects.length_class")
    return rows.agg(
        *_identity(on),
        F.count_if("no_title").alias("missing_title"),
        F.count_if(on & (F.col("n_authors") <= 0)).alias("missing_authors"),
        *[
            F.count_if(on & (F.col("dates") == kind)).alias(f"{kind}_dates")
            for kind in ("missing", "invalid", "future")
        ],
        F.count_if(on & ~_given("source_name")).alias("missing_source_name"),
        *[
            F.count_if(on & (length == kind)).alias(f"{kind}_abstract")
            for kind in ("missing", "empty", "short", "long")
        ],
        F.count_if(on & F.col("defects.tag_leakage")).alias("tag_leakage"),
        F.count_if(on & F.col("defects.encoding_problem")).alias("encoding_problems"),
        F.count_if(on & _filled("github_url")).alias("repo_urls"),
        F.count_if(on & is_repo_url(F.col("github_url"))).alias("valid_repo_urls"),
        F.count_if(on & F.col("github_stars").isNotNull()).alias("stars_populated"),
        F.count_if(on & (F.col("github_stars") < 0)).alias("negative_stars"),
        F.count_if(on & (F.lower("source_name") == "arxiv")).alias("arxiv_rows"),
        (F.count_if(on) - F.count_if(on & (F.lower("source_name") == "arxiv"))).alias("other_rows"),
        (F.count("title_key") - F.count_distinct("title_key")).alias("duplicate_titles"),
        (F.count("title_day") - F.count_distinct("title_day")).alias("duplicate_title_days"),
    )


def audit_products(df: DataFrame) -> DataFrame:
    live = ~is_fixture("products", F.col("source_url"), F.col("product_name"))
    return df.agg(
        *_identity(live),
        F.count_if(live & ~_filled("product_name")).alias("missing_product_name"),
        F.count_if(live & ~_filled("startup_name")).alias("missing_startup_name"),
        F.count_if(live & _given("description")).alias("descriptions_populated"),
        F.count_if(live & _given("category")).alias("categories_populated"),
        F.count_if(live & _given("launch_date")).alias("launch_dates_populated"),
    )


def breakdown(df: DataFrame, column: str, default: str, live: Column | None = None) -> DataFrame:
    """Rows per value; a missing value counts under ``default``."""
    rows = df if live is None else df.filter(live)
    label = F.when(_given(column), F.col(column)).otherwise(F.lit(default))
    return rows.groupBy(label.alias(column)).agg(F.count(F.lit(1)).alias("rows"))


def audit_startups(df: DataFrame, required: int = 1000) -> DataFrame:
    """Needs ``source_url, source_name, entity_name, evidence`` (accepted, reason)."""
    live = ~is_fixture("startups", F.col("source_url"), F.col("entity_name"))
    strength = evidence_strength(F.col("evidence.reason"))
    yc = F.contains("source_url", F.lit("ycombinator.com")) | (F.col("source_name") == "YC Directory")
    org = F.contains("source_url", F.lit("github.com")) | (
        F.col("source_name") == "GitHub Organizations"
    )
    counted = df.agg(
        *_identity(live),
        F.count_if(live & yc).alias("yc_records"),
        F.count_if(live & org).alias("github_records"),
        *[
            F.count_if(live & (strength == kind)).alias(f"{kind.lower()}_evidence")
            for kind in ("STRONG", "MODERATE", "REJECTED")
        ],
    )
    return counted.withColumn(
        "requirement_status",
        F.when(F.col("production_rows") >= required, F.lit("PASS")).otherwise(F.lit("FAIL")),
    )


def audit_jobs(df: DataFrame) -> DataFrame:
    live = ~is_fixture("jobs", F.col("source_url"), F.col("company"))
    remote = F.coalesce(F.col("is_remote"), F.lit(False))
    return df.agg(
        *_identity(live),
        F.count_if(live & ~_filled("company")).alias("missing_company"),
        F.count_if(live & ~_filled("published_date")).alias("missing_date"),
        F.count_if(live & remote).alias("remote_jobs"),
        F.count_if(live & ~remote).alias("onsite_jobs"),
        F.count_if(live & _given("job_title")).alias("titles_populated"),
        F.count_if(live & _given("location")).alias("locations_populated"),
        F.count_if(live & _given("description")).alias("descriptions_populated"),
    )


def freshness_by_source(df: DataFrame) -> DataFrame:
    """Needs ``source_name`` and the gate struct ``gate``."""
    status = F.col("gate.status")
    accepted = _accepted(status == "FRESH", F.col("gate.published_at"))
    return df.groupBy(F.coalesce("source_name", F.lit("Unknown")).alias("source_name")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "FRESH").alias("fresh"),
        F.count_if(status == "STALE").alias("stale"),
        F.count_if(status == "UNKNOWN").alias("unknown"),
        F.count_if(status != "FRESH").alias("rejected"),
        iso8601(F.min(accepted)).alias("earliest_accepted"),
        iso8601(F.max(accepted)).alias("latest_accepted"),
    )


def sorted_extremes(df: DataFrame) -> DataFrame:
    accepted = _accepted(F.col("gate.status") == "FRESH", F.col("gate.published_at"))
    return df.agg(
        iso8601(F.min(accepted)).alias("earliest"), iso8601(F.max(accepted)).alias("latest")
    )


def news_detail(df: DataFrame) -> DataFrame:
    """Per-row classification of news. Needs ``id, source_name, source_url, article_url, title,
    full_text, gate``."""
    status = F.col("gate.status")
    label = (
        F.when(is_fixture("news", F.col("source_url")), F.lit("TEST_OR_LEGACY_FIXTURE"))
        .when(status == "FRESH", F.lit("PRODUCTION_FRESH"))
        .when(status == "STALE", F.lit("PRODUCTION_STALE"))
        .otherwise(F.lit("UNKNOWN_DATE"))
    )
    return df.select(
        "id",
        F.coalesce("source_name", F.lit("UNKNOWN_SOURCE")).alias("source_name"),
        "source_url",
        F.when(_given("article_url"), F.col("article_url")).otherwise(F.col("source_url")).alias("article_url"),
        "title",
        F.col("gate.published_at").alias("published_at"),
        F.col("gate.age_hours").alias("age_hours"),
        status.alias("freshness_status"),
        label.alias("classification"),
        text_quality(F.col("full_text")).alias("text_quality"),
        F.length(F.coalesce("full_text", F.lit(""))).cast("bigint").alias("full_text_length"),
    )


def audit_news(detail: DataFrame) -> DataFrame:
    """Totals over :func:`news_detail`."""
    label, quality = F.col("classification"), F.col("text_quality")
    accepted = _accepted(label == "PRODUCTION_FRESH", F.col("published_at"))
    article = F.when(_filled("article_url"), F.col("article_url"))
    return detail.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(label != "TEST_OR_LEGACY_FIXTURE").alias("production_rows"),
        F.count_if(label == "TEST_OR_LEGACY_FIXTURE").alias("fixture_rows"),
        F.count_if(label == "PRODUCTION_FRESH").alias("fresh_rows"),
        F.count_if(label == "PRODUCTION_STALE").alias("stale_rows"),
        F.count_if(label == "UNKNOWN_DATE").alias("unknown_rows"),
        F.count_if(label != "PRODUCTION_FRESH").alias("rejected_rows"),
        F.count_distinct(F.when(_filled("source_url"), F.col("source_url"))).alias("unique_source_urls"),
        F.count_distinct(article).alias("unique_article_urls"),
        (F.count(article) - F.count_distinct(article)).alias("duplicate_article_urls"),
        F.count_if(~_filled("title")).alias("missing_titles"),
        F.count_if(F.col("published_at").isNull()).alias("missing_dates"),
        F.count_if(quality == "FULL_TEXT").alias("full_text"),
        F.count_if(quality == "PARTIAL_TEXT").alias("partial_text"),
        F.count_if(quality == "FEED_ONLY").alias("feed_only"),
        F.count_if(quality == "FETCH_FAILURE").alias("fetch_failures"),
        iso8601(F.min(accepted)).alias("earliest_accepted"),
        iso8601(F.max(accepted)).alias("latest_accepted"),
    )


def news_by_source(detail: DataFrame) -> DataFrame:
    fresh = F.col("classification") == "PRODUCTION_FRESH"
    return detail.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(fresh).alias("fresh"),
        F.count_if(~fresh).alias("rejected"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def inventory(tables: dict[str, DataFrame], url: str = "source_url") -> DataFrame:
    """Per table: rows, distinct real URLs, suspect rows, legitimate rows."""
    suspect = is_fixture("inventory", F.col(url))
    return union_all([
        df.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_distinct(F.when(~suspect, F.col(url))).alias("distinct_urls"),
            F.count_if(suspect).alias("suspect"),
            F.count_if(~suspect).alias("legitimate"),
        ).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ])


CRAWL_COUNTERS = [
    "discovered", "started", "succeeded", "failed", "retries", "status_429", "status_5xx",
    "status_403", "fresh", "stale", "unknown", "duplicates", "stored", "dlq",
]


def crawl_counters() -> list[Column]:
    """Counters over a crawl log: ``kind`` (discovered, request, freshness, duplicate, stored, dlq),
    ``status``, ``is_retry``, ``is_antibot``, ``freshness``, ``latency``."""
    kind, status = F.col("kind"), F.col("status")
    request = kind == "request"
    barred = F.coalesce(F.col("is_antibot"), F.lit(False)) | (status == 403)
    limited = ~barred & (status == 429)
    gate = kind == "freshness"
    return [
        F.count_if(kind == "discovered").alias("discovered"),
        F.count_if(request).alias("started"),
        F.count_if(request & ~barred & status.between(200, 299)).alias("succeeded"),
        F.count_if(request & (barred | ((status >= 400) & ~limited))).alias("failed"),
        F.count_if(request & F.coalesce(F.col("is_retry"), F.lit(False))).alias("retries"),
        F.count_if(request & limited).alias("status_429"),
        F.count_if(request & ~barred & (status >= 500)).alias("status_5xx"),
        F.count_if(request & barred).alias("status_403"),
        F.count_if(gate & (F.col("freshness") == "FRESH")).alias("fresh"),
        F.count_if(gate & (F.col("freshness") == "STALE")).alias("stale"),
        F.count_if(gate & ~F.coalesce(F.col("freshness").isin("FRESH", "STALE"), F.lit(False))).alias("unknown"),
        F.count_if(kind == "duplicate").alias("duplicates"),
        F.count_if(kind == "stored").alias("stored"),
        F.count_if(kind == "dlq").alias("dlq"),
        F.sum(F.when(request, F.col("latency").cast("decimal(20,6)"))).cast("double").alias("total_latency"),
    ]


def crawl_metrics(log: DataFrame) -> DataFrame:
    return log.groupBy(F.lower("source_name").alias("source_name")).agg(*crawl_counters())


def crawl_summary(metrics: DataFrame, seconds: Column) -> DataFrame:
    """Totals over :func:`crawl_metrics` and stored records per second of the run."""
    totals = metrics.agg(*[
        F.sum(c).alias(f"total_{c}")
        for c in ("discovered", "succeeded", "stored", "duplicates", "failed", "dlq")
    ])
    rate = F.col("total_stored") / F.greatest(F.lit(0.001), seconds)
    return totals.withColumn("records_per_sec", F.bround(rate, 2))


def batch_metrics(outcomes: DataFrame) -> DataFrame:
    """Counters of one batch run by final ``status`` (null: stopped before processing)."""
    status = F.col("status")
    return outcomes.agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if("fetched").alias("fetched"),
        F.count(status).alias("processed"),
        F.count_if(status == "NEW_RECORD_STORED").alias("stored"),
        F.count_if(status == "DUPLICATE_ALREADY_PROCESSED").alias("duplicates"),
        F.count_if(status == "FRESHNESS_REJECTED").alias("rejected_freshness"),
        F.count_if(status.isin("VALIDATION_FAILED", "EXTRACTION_FAILED")).alias("rejected_validation"),
        F.count_if(
            ~status.isin(
                "NEW_RECORD_STORED", "DUPLICATE_ALREADY_PROCESSED", "FRESHNESS_REJECTED",
                "VALIDATION_FAILED", "EXTRACTION_FAILED",
            )
        ).alias("failed"),
    )


def attempt_metrics(attempts: DataFrame) -> DataFrame:
    """Over an attempt log (``record_id, tier, outcome, tokens, latency_ms``): one request per
    record, one fallback per attempt after the first tier."""
    outcome = F.col("outcome")
    answered = outcome.isin("SUCCESS", "SCHEMA_INVALID", "CONTEXT_413")
    per_record = attempts.groupBy("record_id").agg(
        F.max(outcome == "SUCCESS").alias("won"),
        F.count_if(F.col("tier") > 0).alias("fallbacks"),
        F.count_if(outcome == "RATE_LIMIT_429").alias("r429"),
        F.count_if(outcome == "CONTEXT_413").alias("r413"),
        F.count_if(outcome == "SCHEMA_INVALID").alias("invalid"),
        F.sum(F.when(answered, F.col("tokens"))).alias("tokens"),
        F.sum(F.when(answered, F.col("latency_ms").cast("decimal(20,2)"))).alias("latency"),
    )
    return per_record.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("won").alias("successes"),
        F.count_if(~F.col("won")).alias("failures"),
        F.sum("fallbacks").alias("fallbacks"),
        F.sum("r429").alias("rate_limited"),
        F.sum("r413").alias("context_exceeded"),
        F.sum("invalid").alias("schema_failures"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens_in"),
        F.coalesce(F.sum("latency"), F.lit(0)).cast("double").alias("latency_ms"),
    )


def field_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(field, filled, total, empty)``: non-blank values per column, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "").alias(c)
            for c in columns
        ],
    )
    long = counts.unpivot("total", columns, "field", "filled")
    return long.select("field", "filled", "total", (F.col("filled") == 0).alias("empty"))


def duplicate_counts(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Per named key: rows beyond the first of each value."""
    return df.agg(*[
        (F.count(F.lit(1)) - F.count_distinct(F.struct(F.xxhash64(key), F.xxhash64(F.lit(1), key), key.isNull()))).alias(name)
        for name, key in keys.items()
    ])


def class_counts(df: DataFrame, label: str, nullable: list[str]) -> DataFrame:
    """Rows per class, and how many of them lack each of the given columns."""
    return df.groupBy(F.coalesce(F.col(label), F.lit("OTHER")).alias(label)).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nullable],
    )
