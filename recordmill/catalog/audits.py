"""Queries over audits and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.catalog.base import FRAMES, TABLES, Tables, on, query
from recordmill.catalog.history import sql_fixture
from recordmill.catalog.texts import (
    SQL_EVIDENCE,
    evidence,
    gated,
    on_gated,
    sql_product_class,
    sql_role,
    sql_startup_class,
)
from recordmill.functions import classify as C
from recordmill.functions.text import role_family
from recordmill.operators import audits as A

# Counts of rows that are no fixtures, in checking SQL.


def _identity(live: str) -> str:
    return f"""count(*) AS total_rows, count(*) FILTER ({live}) AS production_rows, count(*) FILTER (NOT {live}) AS fixture_rows,
      count(DISTINCT source_url) FILTER ({live}) AS unique_urls, count(*) FILTER ({live}) - count(DISTINCT source_url) FILTER ({live}) AS duplicate_urls,
      count(*) FILTER ({live} AND NOT starts_with(source_url, 'http')) AS invalid_urls"""


_PAPER_LIVE = f"(NOT {sql_fixture('papers', 'source_url')})"
_ABSTRACT = """CASE id % 9 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN substr(text, 1, 20) WHEN 3 THEN text || ' <b>bold</b>'
    WHEN 4 THEN text || ' R&amp;D' ELSE text END"""
_TITLE_KEY = r"regexp_replace(lower(trim(title)), '\s+', ' ', 'g')"


def paper_table(t: Tables) -> DataFrame:
    rows = t.frame("paper_rows").withColumn("abstract", F.expr(_ABSTRACT))
    authors = F.when(F.col("id") % 14 == 5, F.array().cast("array<string>")).when(F.col("id") % 14 != 6, F.split("author_list", ","))
    return rows.withColumn("authors", authors)


@query("audit_papers", on("paper_rows", rf""", p AS (SELECT *, {_PAPER_LIVE} AS live, {_ABSTRACT} AS a, {_TITLE_KEY} AS tk FROM f),
    q AS (SELECT *, regexp_replace(a, '^<ws>+|<ws>+$', '', 'g') AS s FROM p)
    SELECT {_identity('live')}, count(*) FILTER (live AND trim(title) = '') AS missing_title, count(*) FILTER (live AND id % 14 IN (5, 6)) AS missing_authors,
      count(*) FILTER (live AND published_date = '') AS missing_dates, count(*) FILTER (live AND published_date = 'soon') AS invalid_dates, count(*) FILTER (live AND starts_with(published_date, '2031')) AS future_dates,
      count(*) FILTER (live AND source_name = '') AS missing_source_name, count(*) FILTER (live AND a = '') AS missing_abstract, count(*) FILTER (live AND a <> '' AND s = '') AS empty_abstract,
      count(*) FILTER (live AND s <> '' AND length(s) < 50) AS short_abstract, count(*) FILTER (live AND length(s) > 10000) AS long_abstract,
      count(*) FILTER (live AND a <> '' AND regexp_matches(s, '<[a-zA-Z/][^>]*>')) AS tag_leakage,
      count(*) FILTER (live AND (contains(s, chr(65533)) OR contains(s, '&amp;') OR contains(s, '&lt;'))) AS encoding_problems,
      count(*) FILTER (live AND trim(coalesce(github_url, '')) <> '') AS repo_urls,
      count(*) FILTER (live AND regexp_full_match(trim(github_url), 'https?://github\.com/[a-zA-Z0-9_\-.]+/[a-zA-Z0-9_\-.]+')) AS valid_repo_urls,
      count(*) FILTER (live AND github_stars IS NOT NULL) AS stars_populated, count(*) FILTER (live AND github_stars < 0) AS negative_stars,
      count(*) FILTER (live AND lower(source_name) = 'arxiv') AS arxiv_rows, count(*) FILTER (live AND lower(source_name) <> 'arxiv') AS other_rows,
      count(*) FILTER (live) - count(DISTINCT tk) FILTER (live) AS duplicate_titles,
      count(*) FILTER (live) - count(DISTINCT tk || '|' || substr(published_date, 1, 10)) FILTER (live) AS duplicate_title_days FROM q"""))
def _(t: Tables):
    return A.audit_papers(paper_table(t))


_PRODUCT_LIVE = f"(NOT {sql_fixture('products', 'source_url', 'product_name')})"


@query("audit_products", on("product_rows", f"""SELECT {_identity(_PRODUCT_LIVE)}, count(*) FILTER ({_PRODUCT_LIVE} AND trim(product_name) = '') AS missing_product_name,
    count(*) FILTER ({_PRODUCT_LIVE} AND trim(startup_name) = '') AS missing_startup_name, count(*) FILTER ({_PRODUCT_LIVE} AND description <> '') AS descriptions_populated,
    count(*) FILTER ({_PRODUCT_LIVE} AND category <> '') AS categories_populated, count(*) FILTER ({_PRODUCT_LIVE} AND launch_date <> '') AS launch_dates_populated FROM f"""))
def _(t: Tables):
    return A.audit_products(t.frame("product_rows"))


@query("pricing_breakdown", on("product_rows", f"""SELECT CASE WHEN coalesce(pricing_model, '') = '' THEN 'UNKNOWN' ELSE pricing_model END AS pricing_model, count(*) AS rows
    FROM f WHERE {_PRODUCT_LIVE} GROUP BY 1"""))
def _(t: Tables):
    live = ~C.is_fixture("products", F.col("source_url"), F.col("product_name"))
    return A.breakdown(t.frame("product_rows"), "pricing_model", "UNKNOWN", live)


@query("source_breakdown", on("paper_rows", "SELECT CASE WHEN source_name = '' THEN 'Unknown' ELSE source_name END AS source_name, count(*) AS rows FROM f GROUP BY 1"))
def _(t: Tables):
    return A.breakdown(t.frame("paper_rows"), "source_name", "Unknown")


_STARTUP_LIVE = f"(NOT {sql_fixture('startups', 'source_url', 'name')})"


@query("audit_startups", on("org_rows", f""", e AS (SELECT *, url AS source_url, {SQL_EVIDENCE} AS reason FROM f)
    SELECT {_identity(_STARTUP_LIVE)}, count(*) FILTER ({_STARTUP_LIVE} AND contains(url, 'ycombinator.com')) AS yc_records, count(*) FILTER ({_STARTUP_LIVE}) AS github_records,
      count(*) FILTER ({_STARTUP_LIVE} AND (reason IN ('YC_DIRECTORY_RECORD', 'VERIFIED_COMPANY_DOMAIN') OR starts_with(reason, 'EXPLICIT'))) AS strong_evidence,
      count(*) FILTER ({_STARTUP_LIVE} AND reason = 'COMMERCIAL_WEBSITE_AND_PROFILE') AS moderate_evidence,
      count(*) FILTER ({_STARTUP_LIVE} AND reason IN ('ACADEMIC_OR_NON_PROFIT', 'INSUFFICIENT_COMPANY_EVIDENCE')) AS rejected_evidence,
      CASE WHEN count(*) FILTER ({_STARTUP_LIVE}) >= 1000 THEN 'PASS' ELSE 'FAIL' END AS requirement_status FROM e"""))
def _(t: Tables):
    rows = t.frame("org_rows").select(
        F.col("url").alias("source_url"), F.lit("GitHub Organizations").alias("source_name"), F.col("name").alias("entity_name"),
        evidence().alias("evidence"),
    )
    return A.audit_startups(rows)


_JOB_LIVE = f"(NOT {sql_fixture('jobs', 'source_url', 'company')})"


@query("audit_jobs", on("job_rows", f"""SELECT {_identity(_JOB_LIVE)}, count(*) FILTER ({_JOB_LIVE} AND trim(company) = '') AS missing_company,
    count(*) FILTER ({_JOB_LIVE} AND coalesce(published_date, '') = '') AS missing_date, count(*) FILTER ({_JOB_LIVE} AND is_remote) AS remote_jobs,
    count(*) FILTER ({_JOB_LIVE} AND NOT is_remote) AS onsite_jobs, count(*) FILTER ({_JOB_LIVE} AND job_title <> '') AS titles_populated,
    count(*) FILTER ({_JOB_LIVE} AND location <> '') AS locations_populated, count(*) FILTER ({_JOB_LIVE} AND text <> '') AS descriptions_populated FROM f"""))
def _(t: Tables):
    return A.audit_jobs(t.frame("job_rows").withColumn("description", F.col("text")))


@query("role_breakdown", on("job_rows", f"SELECT {sql_role('job_title', 'text')} AS role_family, count(*) AS rows FROM f WHERE {_JOB_LIVE} GROUP BY 1"))
def _(t: Tables):
    rows = t.frame("job_rows").withColumn("role_family", role_family(F.col("job_title"), F.col("text")))
    live = ~C.is_fixture("jobs", F.col("source_url"), F.col("company"))
    return A.breakdown(rows, "role_family", "Engineering", live)


@query("freshness_by_source", on_gated("""SELECT source_name, count(*) AS total, count(*) FILTER (status = 'FRESH') AS fresh, count(*) FILTER (status = 'STALE') AS stale,
    count(*) FILTER (status = 'UNKNOWN') AS unknown, count(*) FILTER (status <> 'FRESH') AS rejected, min(published_at) FILTER (status = 'FRESH') AS earliest_accepted,
    max(published_at) FILTER (status = 'FRESH') AS latest_accepted FROM g GROUP BY source_name"""))
def _(t: Tables):
    return A.freshness_by_source(gated(t))


@query("sorted_extremes", on_gated("SELECT min(published_at) AS earliest, max(published_at) AS latest FROM g WHERE status = 'FRESH'"))
def _(t: Tables):
    return A.sorted_extremes(gated(t))


_NEWS_TEXT = "CASE id % 4 WHEN 0 THEN repeat('long text ', 60) WHEN 1 THEN repeat('some text ', 12) WHEN 2 THEN 'short' ELSE '' END"
_SQL_NEWS = f""" , n AS (SELECT id, source_name, source_url, CASE WHEN id % 6 = 0 THEN 'https://a.example.net/' || CAST(id % 100 AS STRING) ELSE source_url END AS article_url,
      CASE WHEN id % 8 = 1 THEN ' ' ELSE 'Title' END AS title, published_at, age AS age_hours, status AS freshness_status,
      CASE WHEN {sql_fixture('news', 'source_url')} THEN 'TEST_OR_LEGACY_FIXTURE' WHEN status = 'FRESH' THEN 'PRODUCTION_FRESH' WHEN status = 'STALE' THEN 'PRODUCTION_STALE' ELSE 'UNKNOWN_DATE' END AS classification,
      CASE id % 4 WHEN 0 THEN 'FULL_TEXT' WHEN 1 THEN 'PARTIAL_TEXT' WHEN 2 THEN 'FEED_ONLY' ELSE 'FETCH_FAILURE' END AS text_quality,
      CAST(length({_NEWS_TEXT}) AS BIGINT) AS full_text_length FROM g)"""


def news_rows(t: Tables) -> DataFrame:
    rows = gated(t).withColumns({
        "full_text": F.expr(_NEWS_TEXT),
        "article_url": F.expr("CASE WHEN id % 6 = 0 THEN 'https://a.example.net/' || CAST(id % 100 AS STRING) END"),
        "title": F.expr("CASE WHEN id % 8 = 1 THEN ' ' ELSE 'Title' END"),
    })
    return A.news_detail(rows)


@query("news_detail", on_gated(_SQL_NEWS + " SELECT * FROM n"))
def _(t: Tables):
    return news_rows(t)


@query("audit_news", on_gated(_SQL_NEWS + """ SELECT count(*) AS total_rows, count(*) FILTER (classification <> 'TEST_OR_LEGACY_FIXTURE') AS production_rows,
    count(*) FILTER (classification = 'TEST_OR_LEGACY_FIXTURE') AS fixture_rows, count(*) FILTER (classification = 'PRODUCTION_FRESH') AS fresh_rows,
    count(*) FILTER (classification = 'PRODUCTION_STALE') AS stale_rows, count(*) FILTER (classification = 'UNKNOWN_DATE') AS unknown_rows, count(*) FILTER (classification <> 'PRODUCTION_FRESH') AS rejected_rows,
    count(DISTINCT source_url) FILTER (source_url <> '') AS unique_source_urls, count(DISTINCT article_url) FILTER (article_url <> '') AS unique_article_urls,
    count(*) FILTER (article_url <> '') - count(DISTINCT article_url) FILTER (article_url <> '') AS duplicate_article_urls, count(*) FILTER (trim(title) = '') AS missing_titles,
    count(*) FILTER (published_at IS NULL) AS missing_dates, count(*) FILTER (text_quality = 'FULL_TEXT') AS full_text, count(*) FILTER (text_quality = 'PARTIAL_TEXT') AS partial_text,
    count(*) FILTER (text_quality = 'FEED_ONLY') AS feed_only, count(*) FILTER (text_quality = 'FETCH_FAILURE') AS fetch_failures,
    min(published_at) FILTER (classification = 'PRODUCTION_FRESH') AS earliest_accepted, max(published_at) FILTER (classification = 'PRODUCTION_FRESH') AS latest_accepted FROM n"""))
def _(t: Tables):
    return A.audit_news(news_rows(t))


@query("news_by_source", on_gated(_SQL_NEWS + """ SELECT source_name, count(*) AS rows, count(*) FILTER (classification = 'PRODUCTION_FRESH') AS fresh,
    count(*) FILTER (classification <> 'PRODUCTION_FRESH') AS rejected FROM n GROUP BY source_name"""))
def _(t: Tables):
    return A.news_by_source(news_rows(t))


FRAMES["inventory_rows"] = """
    SELECT 'papers' AS table_name, source_url FROM (SELECT CASE WHEN doc_id % 17 = 3 THEN 'x/test-paper-' || CAST(doc_id AS STRING) ELSE 'https://d/' || CAST(doc_id % 700 AS STRING) END AS source_url FROM documents)
    UNION ALL SELECT 'news', url FROM pages
    UNION ALL SELECT 'jobs', CASE WHEN event_id % 6 = 1 THEN '' WHEN event_id % 6 = 2 THEN 'u?test_id=1' ELSE 'https://e/' || CAST(user_id AS STRING) END FROM events
    UNION ALL SELECT 'startups', s_name FROM supplier UNION ALL SELECT 'products', p_name FROM part UNION ALL SELECT 'entity_mappings', c_name FROM customer"""


@query("inventory", on("inventory_rows", f"""SELECT table_name, count(*) AS total, count(DISTINCT source_url) FILTER (NOT {sql_fixture('inventory', 'source_url')}) AS distinct_urls,
    count(*) FILTER ({sql_fixture('inventory', 'source_url')}) AS suspect, count(*) FILTER (NOT {sql_fixture('inventory', 'source_url')}) AS legitimate FROM f GROUP BY table_name"""))
def _(t: Tables):
    urls = {
        "papers": t.documents.selectExpr("CASE WHEN doc_id % 17 = 3 THEN 'x/test-paper-' || doc_id ELSE 'https://d/' || (doc_id % 700) END AS source_url"),
        "news": t.pages.select(F.col("url").alias("source_url")),
        "jobs": t.events.selectExpr("CASE WHEN event_id % 6 = 1 THEN '' WHEN event_id % 6 = 2 THEN 'u?test_id=1' ELSE 'https://e/' || user_id END AS source_url"),
        "startups": t.supplier.select(F.col("s_name").alias("source_url")),
        "products": t.part.select(F.col("p_name").alias("source_url")),
        "entity_mappings": t.customer.select(F.col("c_name").alias("source_url")),
    }
    return A.inventory(urls)


@query("table_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in TABLES))
def _(t: Tables):
    return A.table_counts({n: getattr(t, n) for n in TABLES})


# --- Metrics --------------------------------------------------------------------------------------

_BARRED = "(is_antibot OR status = 403)"
SQL_COUNTERS = f"""count(*) FILTER (kind = 'discovered') AS discovered, count(*) FILTER (kind = 'request') AS started,
    count(*) FILTER (kind = 'request' AND NOT {_BARRED} AND status BETWEEN 200 AND 299) AS succeeded, count(*) FILTER (kind = 'request' AND ({_BARRED} OR (status >= 400 AND status <> 429))) AS failed,
    count(*) FILTER (kind = 'request' AND is_retry) AS retries, count(*) FILTER (kind = 'request' AND NOT {_BARRED} AND status = 429) AS status_429,
    count(*) FILTER (kind = 'request' AND NOT {_BARRED} AND status >= 500) AS status_5xx, count(*) FILTER (kind = 'request' AND {_BARRED}) AS status_403,
    count(*) FILTER (kind = 'freshness' AND freshness = 'FRESH') AS fresh, count(*) FILTER (kind = 'freshness' AND freshness = 'STALE') AS stale,
    count(*) FILTER (kind = 'freshness' AND coalesce(freshness, '') NOT IN ('FRESH', 'STALE')) AS unknown, count(*) FILTER (kind = 'duplicate') AS duplicates,
    count(*) FILTER (kind = 'stored') AS stored, count(*) FILTER (kind = 'dlq') AS dlq, CAST(sum(CAST(latency AS DECIMAL(20, 6))) FILTER (kind = 'request') AS DOUBLE) AS total_latency"""


@query("crawl_metrics", on("crawl_log", f"SELECT lower(source_name) AS source_name, {SQL_COUNTERS} FROM f GROUP BY 1"))
def _(t: Tables):
    return A.crawl_metrics(t.frame("crawl_log"))


@query("crawl_summary", on("crawl_log", f""", m AS (SELECT {SQL_COUNTERS} FROM f)
    SELECT CAST(discovered AS BIGINT) AS total_discovered, succeeded AS total_succeeded, stored AS total_stored, duplicates AS total_duplicates, failed AS total_failed, dlq AS total_dlq,
      CAST(round_even(stored / 480.0, 2) AS DOUBLE) AS records_per_sec FROM m"""))
def _(t: Tables):
    return A.crawl_summary(A.crawl_metrics(t.frame("crawl_log")), F.lit(480.0))


FRAMES["batch_outcomes"] = """
    SELECT event_id % 7 <> 0 AS fetched, CASE WHEN event_id % 9 = 4 THEN NULL ELSE CASE event_id % 7 WHEN 0 THEN 'FETCH_FAILED' WHEN 1 THEN 'DUPLICATE_ALREADY_PROCESSED'
      WHEN 2 THEN 'FRESHNESS_REJECTED' WHEN 3 THEN 'EXTRACTION_FAILED' WHEN 4 THEN 'VALIDATION_FAILED' ELSE 'NEW_RECORD_STORED' END END AS status FROM events"""


@query("batch_metrics", on("batch_outcomes", """SELECT count(*) AS discovered, count(*) FILTER (fetched) AS fetched, count(status) AS processed, count(*) FILTER (status = 'NEW_RECORD_STORED') AS stored,
    count(*) FILTER (status = 'DUPLICATE_ALREADY_PROCESSED') AS duplicates, count(*) FILTER (status = 'FRESHNESS_REJECTED') AS rejected_freshness,
    count(*) FILTER (status IN ('EXTRACTION_FAILED', 'VALIDATION_FAILED')) AS rejected_validation, count(*) FILTER (status = 'FETCH_FAILED') AS failed FROM f"""))
def _(t: Tables):
    return A.batch_metrics(t.frame("batch_outcomes"))


@query("attempt_metrics", on("attempt_log", """, a AS (SELECT record_id, bool_or(outcome = 'SUCCESS') AS won FROM f GROUP BY record_id)
    SELECT (SELECT count(*) FROM a) AS requests, (SELECT count(*) FROM a WHERE won) AS successes, (SELECT count(*) FROM a WHERE NOT won) AS failures,
      count(*) FILTER (tier > 0) AS fallbacks, count(*) FILTER (outcome = 'RATE_LIMIT_429') AS rate_limited, count(*) FILTER (outcome = 'CONTEXT_413') AS context_exceeded,
      count(*) FILTER (outcome = 'SCHEMA_INVALID') AS schema_failures, CAST(sum(tokens) FILTER (outcome <> 'RATE_LIMIT_429') AS BIGINT) AS tokens_in,
      CAST(sum(latency_ms) FILTER (outcome <> 'RATE_LIMIT_429') AS DOUBLE) AS latency_ms FROM f"""))
def _(t: Tables):
    return A.attempt_metrics(t.frame("attempt_log"))


_COVER = ["name", "segment", "comment", "balance"]
FRAMES["covered"] = """
    SELECT c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END AS segment, CAST(NULL AS STRING) AS comment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer"""


@query("field_coverage", on("covered", " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER (trim(coalesce(CAST({c} AS STRING), '')) <> '') AS filled, count(*) AS total, count(*) FILTER (trim(coalesce(CAST({c} AS STRING), '')) <> '') = 0 AS empty FROM f"
    for c in _COVER)))
def _(t: Tables):
    return A.field_coverage(t.frame("covered"), _COVER)


@query("duplicate_counts", on("paper_rows", """SELECT count(*) - count(DISTINCT source_url) AS urls, count(*) - count(DISTINCT text) AS texts,
    count(*) - count(DISTINCT title || '|' || published_date) AS title_dates FROM f"""))
def _(t: Tables):
    keys = {
        "urls": F.col("source_url"), "texts": F.sha2("text", 256), "title_dates": F.struct("title", "published_date"),
    }
    return A.duplicate_counts(t.frame("paper_rows"), keys)


@query("semantic_class_counts", on("product_rows", f"""SELECT coalesce({sql_product_class('source_url', 'product_name', 'description')}, 'OTHER') AS class, 'products' AS table_name, count(*) AS rows,
      count(*) FILTER (category IS NULL) AS null_category, count(*) FILTER (launch_date IS NULL) AS null_launch_date FROM f GROUP BY 1
    UNION ALL SELECT coalesce({sql_startup_class('url', 'name', 'description', 'blog')}, 'OTHER'), 'startups', count(*), count(*) FILTER (company IS NULL), count(*) FILTER (created_at IS NULL)
      FROM ({FRAMES['org_rows']}) GROUP BY 1"""))
def _(t: Tables):
    products = t.frame("product_rows").withColumn("class", C.product_class(F.col("source_url"), F.col("product_name"), F.col("description")))
    startups = t.frame("org_rows").select(
        C.startup_class(F.col("url"), F.col("name"), F.col("description"), F.col("blog")).alias("class"),
        F.col("company").alias("category"), F.col("created_at").alias("launch_date"),
    )
    parts = [
        A.class_counts(df, "class", ["category", "launch_date"]).withColumn("table_name", F.lit(name))
        for name, df in (("products", products), ("startups", startups))
    ]
    return A.union_all(parts)
