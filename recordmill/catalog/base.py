"""Registration, table access and derived frames.

A derived frame is one SQL text that Spark and the checking engine both run, so that both sides
start from the same rows. It reads whole tables: variants are made by ``CASE``, never by leaving
rows out.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.fixed_values import SPACE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

REF_TEXT = "2024-01-31T00:00:00Z"


def ref():
    """The fixed reference time of the example data."""
    return F.lit(REF_TEXT).cast("timestamp")


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

FRAMES = {
    # Every page twice: the second claim differs in case and by a trailing slash.
    "pages_seen": """
        SELECT page_id * 2 AS seq, url FROM pages
        UNION ALL SELECT page_id * 2 + 1 AS seq, upper(url) || '/' AS url FROM pages""",
    # The same, with every claim replayed, and claims without a place in the order.
    "pages_replayed": """
        SELECT page_id * 2 AS seq, url FROM pages
        UNION ALL SELECT page_id * 2 AS seq, url FROM pages
        UNION ALL SELECT CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id * 2 + 1 END AS seq, upper(url) || '/' AS url FROM pages""",
    # Every page fetched twice; the second fetch changed for some.
    "pages_versions": """
        SELECT page_id * 2 AS seq, 1 AS version, page_id, url, html AS raw_content FROM pages
        UNION ALL
        SELECT page_id * 2 + 1 AS seq, 2 AS version, page_id, url,
               CASE WHEN page_id % 5 = 0 THEN html || '<!-- v2 -->' ELSE html END AS raw_content
        FROM pages""",
    "page_states": """
        SELECT url AS source_url,
               CASE page_id % 4 WHEN 0 THEN 'STORED' WHEN 1 THEN 'FAILED'
                                WHEN 2 THEN 'PROCESSING' ELSE 'STORED' END AS state
        FROM pages""",
    "raw_names": """
        SELECT c_custkey AS seq, c_name,
               CASE c_custkey % 12
                    WHEN 0 THEN 'OpenAI' WHEN 1 THEN 'Open AI' WHEN 2 THEN 'OpenAI, Inc.'
                    WHEN 3 THEN 'Anthropic PBC' WHEN 4 THEN 'OpenAI Labs'
                    WHEN 5 THEN 'Apple Records' WHEN 6 THEN 'Amazon Web Services'
                    WHEN 7 THEN 'OpenAI Capital Partners' WHEN 8 THEN ''
                    WHEN 9 THEN 'Hugging Face Co.' WHEN 10 THEN c_name
                    ELSE 'Mistral AI  Europe' END AS raw_name,
               'STARTUP' AS entity_type,
               CASE WHEN c_custkey % 12 = 11 THEN 'https://docs.mistral.ai.example.com/x'
                    WHEN c_custkey % 7 = 0 THEN 'https://www.openai.com/about?src=1'
                    WHEN c_custkey % 7 = 1 THEN 'https://shop.example.org:8080/a'
                    ELSE '' END AS domain,
               CASE WHEN c_custkey % 11 = 0 THEN ' OpenAI '
                    WHEN c_custkey % 11 = 1 THEN 'unknown-' || CAST(c_custkey AS STRING)
                    WHEN c_custkey % 11 = 2 THEN '' END AS crunchbase
        FROM customer""",
    "crawl_log": """
        SELECT event_id, ts, event_type AS source_name,
               CASE event_id % 10 WHEN 5 THEN 'freshness' WHEN 6 THEN 'stored'
                    WHEN 7 THEN 'duplicate' WHEN 8 THEN 'dlq' WHEN 9 THEN 'discovered'
                    ELSE 'request' END AS kind,
               CASE event_id % 10 WHEN 0 THEN 200 WHEN 1 THEN 403 WHEN 2 THEN 404
                    WHEN 3 THEN 429 ELSE 503 END AS status,
               user_id % 3 = 0 AS is_retry,
               event_type = 'error' AND user_id % 5 = 0 AS is_antibot,
               CASE user_id % 4 WHEN 0 THEN 'FRESH' WHEN 1 THEN 'STALE'
                    WHEN 2 THEN 'UNKNOWN' END AS freshness,
               value AS latency,
               CASE user_id % 3 WHEN 0 THEN 'Just a moment... CF-RAY ' || props
                    WHEN 1 THEN 'plain body' END AS body
        FROM events""",
    "attempt_log": """
        SELECT conv_id AS record_id, turn AS tier,
               CASE (conv_id + turn) % 4 WHEN 0 THEN 'RATE_LIMIT_429' WHEN 1 THEN 'SCHEMA_INVALID'
                    WHEN 2 THEN 'CONTEXT_413' ELSE 'SUCCESS' END AS outcome,
               CAST(length(text) AS BIGINT) AS tokens,
               CAST(turn * 10 + 5 AS BIGINT) AS latency_ms
        FROM conversations""",
    "state_events": """
        SELECT CAST(user_id AS STRING) AS source_url, event_id AS seq, ts,
               CASE event_id % 8 WHEN 0 THEN 'DISCOVERED' WHEN 1 THEN 'FETCHING'
                    WHEN 2 THEN 'FETCHED' WHEN 3 THEN 'PROCESSING' WHEN 4 THEN 'PROCESSED'
                    WHEN 5 THEN 'FAILED' WHEN 6 THEN 'DLQ' ELSE 'STORED' END AS state,
               CASE event_id % 8 WHEN 5 THEN 'timeout' WHEN 6 THEN 'HTTP 404' END AS error
        FROM events""",
    "signal_rows": """
        SELECT event_id AS id, event_type AS source_name, ts,
               CASE WHEN event_id % 40 = 7 THEN ''
                    WHEN event_id % 50 = 3
                    THEN 'https://jobs.example.org/test_raw_/' || CAST(event_id AS STRING)
                    ELSE 'https://jobs.example.org/' || CAST(event_id AS STRING)
               END AS source_url
        FROM events""",
    "order_updates": """
        SELECT o_custkey AS key, o_orderkey AS seq, o_orderstatus AS status,
               o_totalprice AS total, o_orderdate AS first_date, o_orderpriority AS priority
        FROM orders""",
    "paper_rows": """
        SELECT doc_id AS id, text, n_chars,
               CASE WHEN doc_id % 17 = 3 THEN 'https://arxiv.org/abs/test-paper-' || CAST(doc_id AS STRING)
                    WHEN doc_id % 19 = 5 THEN 'arxiv:' || CAST(doc_id AS STRING)
                    ELSE 'https://arxiv.org/abs/2301.' || CAST(10000 + doc_id % 90000 AS STRING) || 'v2'
               END AS source_url,
               CASE WHEN doc_id % 3 = 0 THEN 'arXiv' WHEN doc_id % 23 = 1 THEN '' ELSE source END AS source_name,
               CASE WHEN doc_id % 29 = 2 THEN '  '
                    ELSE '  The  ' || source || ' ' || lang || ' Study:  Part ' || CAST(doc_id % 400 AS STRING) || '. '
               END AS title,
               CASE doc_id % 5 WHEN 0 THEN '2026-09-10T14:00:00Z' WHEN 1 THEN '2031-01-02T00:00:00Z'
                    WHEN 2 THEN 'soon' WHEN 3 THEN '' ELSE '2025-01-02' END AS published_date,
               CASE doc_id % 4 WHEN 0 THEN 'https://github.com/lab' || CAST(doc_id % 50 AS STRING) || '/repo.git'
                    WHEN 1 THEN 'https://github.com/sponsors/x' WHEN 2 THEN ' ' END AS github_url,
               CASE WHEN doc_id % 4 = 0 THEN doc_id % 9000 - 5 END AS github_stars,
               CASE doc_id % 6 WHEN 0 THEN 'cs.CL' WHEN 1 THEN 'cs.CV' WHEN 2 THEN '' ELSE 'cs.AI' END AS category,
               CASE WHEN doc_id % 7 = 0 THEN ' ' || source || ',  B. Two '
                    ELSE 'A.  One,' || source || ',A. One' END AS author_list
        FROM documents""",
    "product_rows": """
        SELECT p_partkey AS seq, p_name AS product_name,
               CASE WHEN p_partkey % 31 = 4 THEN ' ' ELSE p_brand END AS startup_name,
               CASE WHEN p_partkey % 37 = 6 THEN 'http://github.com/test-product-' || CAST(p_partkey AS STRING)
                    WHEN p_partkey % 41 = 8 THEN ''
                    WHEN p_partkey % 3 = 0 THEN 'https://github.com/' || p_brand || '/' || CAST(p_partkey % 1500 AS STRING)
                    WHEN p_partkey % 3 = 1 THEN 'https://www.producthunt.com/posts/' || CAST(p_partkey AS STRING)
                    ELSE 'ftp://files.example.org/' || CAST(p_partkey AS STRING) END AS source_url,
               CASE p_size % 5 WHEN 0 THEN 'FREE' WHEN 1 THEN 'PAID' WHEN 2 THEN 'FREEMIUM'
                    WHEN 3 THEN '' END AS pricing_model,
               CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN p_type || ' developer Tool'
                    ELSE p_type END AS description,
               CASE WHEN p_size % 3 = 0 THEN p_type END AS category,
               CASE WHEN p_size % 7 = 0 THEN '2026-01-01' END AS launch_date,
               CASE p_size % 6 WHEN 0 THEN 'GitHub Repositories' WHEN 1 THEN 'Hugging Face Models'
                    WHEN 2 THEN 'Product Hunt' END AS source_name
        FROM part""",
    "org_rows": """
        SELECT s_suppkey AS seq,
               CASE WHEN s_suppkey % 43 = 9 THEN 'https://www.ycombinator.com/companies/' || CAST(s_suppkey AS STRING)
                    WHEN s_suppkey % 47 = 5 THEN 'https://github.com/test-startup-' || CAST(s_suppkey AS STRING)
                    ELSE 'https://github.com/org' || CAST(s_suppkey AS STRING) END AS url,
               CASE s_suppkey % 8 WHEN 0 THEN s_name || ' Inc.' WHEN 1 THEN s_name || ' University'
                    WHEN 2 THEN '' ELSE s_name END AS name,
               'org' || CAST(s_suppkey AS STRING) AS login,
               CASE s_suppkey % 5 WHEN 0 THEN 'https://acme.io' WHEN 1 THEN 'x.com/acme'
                    WHEN 2 THEN 'acme.ai' WHEN 3 THEN '' END AS blog,
               CASE s_suppkey % 3 WHEN 0 THEN 'A data platform for all' WHEN 1 THEN '  '
                    ELSE 'Just things' END AS description,
               CASE s_suppkey % 9 WHEN 4 THEN 'Acme GmbH' WHEN 5 THEN 'services' END AS company,
               s_suppkey % 13 = 2 AS is_verified,
               CASE s_suppkey % 4 WHEN 0 THEN '2019-05-06T07:08:09Z' WHEN 1 THEN 'n/a!'
                    WHEN 2 THEN '' END AS created_at,
               CASE s_suppkey % 3 WHEN 0 THEN ' Paris ' WHEN 1 THEN ' ' END AS location
        FROM supplier""",
    "job_rows": """
        SELECT doc_id AS seq, source AS source_name, text, lang,
               CASE WHEN doc_id % 27 = 4 THEN 'http://example.org/test-job-' || CAST(doc_id AS STRING)
                    WHEN doc_id % 33 = 8 THEN 'mailto:jobs'
                    ELSE 'https://jobs.example.org/' || CAST(doc_id % 5000 AS STRING) END AS source_url,
               CASE WHEN doc_id % 21 = 2 THEN ' ' ELSE 'Company ' || source END AS company,
               CASE WHEN doc_id % 6 <> 1 THEN '2024-01-30T12:00:00Z' END AS published_date,
               lang = 'en' AS is_remote,
               CASE doc_id % 9 WHEN 0 THEN 'Senior Data Analyst' WHEN 1 THEN 'NLP researcher'
                    WHEN 2 THEN 'Product Owner' WHEN 3 THEN 'UI/UX lead' WHEN 4 THEN 'Director'
                    WHEN 5 THEN '' ELSE 'Backend Developer' END AS job_title,
               CASE WHEN doc_id % 5 = 0 THEN 'Berlin' END AS location
        FROM documents""",
}


class Tables:
    """Tables of one data folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def frame(self, name: str) -> DataFrame:
        """A derived frame."""
        text = FRAMES[name]
        used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)]
        bound = text.replace("{", "{{").replace("}", "}}")
        for t in used:
            bound = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", bound)
        return self.spark.sql(bound, **{t: getattr(self, t) for t in used})


def on(frame: str, sql: str) -> str:
    """Checking SQL over a derived frame, available as ``f``. The SQL may start with a comma and
    further named subqueries."""
    return f"WITH f AS ({FRAMES[frame]}) {sql.lstrip()}"


def query(name: str, sql: str | None = None):
    """Registers ``fn(tables) -> DataFrame`` under ``name``. In the SQL ``<ws>`` stands for the
    white-space class."""
    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql.replace("<ws>", SPACE)
        return fn

    return add
