"""Whole batch runs, the source registry, page forms and date forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordmill.catalog.base import FRAMES, REF_TEXT, Tables, on, query, ref
from recordmill.catalog.pages import (
    SQL_LISTED,
    at,
    feed_metadata,
    page_payloads,
    sql_page_facts,
)
from recordmill.fixed_values import EXPORT_TABS, NEWS_FEEDS, STORY_TITLE
from recordmill.functions import html as H
from recordmill.functions import times as T
from recordmill.functions.jsonvalues import json_text
from recordmill.operators.resolve import seed_master
from recordmill.operators.sinks import export_csv
from recordmill.operators.validate import dead_letters
from recordmill.plans.batch import run_batch
from recordmill.session import shared_dir, shuffled
from recordmill.sources.registry import default_registry

# Every document arrives twice. The first arrival is refused by the site, undated or unproved, or good;
# the second one is good. The five kinds of records take turns.
FRAMES["arrivals"] = """
    SELECT doc_id * 2 + late AS seq, doc_id, late, lang,
           CASE WHEN late = 0 THEN doc_id % 4 ELSE 3 END AS form, doc_id % 5 AS kind,
           CASE doc_id % 5 WHEN 0 THEN 'https://jobs.example.org/' WHEN 1 THEN 'https://github.com/own/r'
             WHEN 2 THEN 'https://github.com/org' WHEN 3 THEN 'https://news.example.org/' ELSE 'https://arxiv.org/abs/2301.' END
             || CAST(10000 + doc_id AS STRING) || CASE WHEN late = 1 AND doc_id % 5 < 4 THEN '/' ELSE '' END AS url,
           CASE doc_id % 5 WHEN 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'aijobsnet' ELSE 'RemoteOKAI' END WHEN 1 THEN 'products'
             WHEN 2 THEN 'GITHUBORGS' WHEN 3 THEN 'TechCrunchAI' ELSE 'paperswithcode' END AS source_name
    FROM documents, (SELECT 0 AS late UNION ALL SELECT 1)"""

_RAW = """CASE WHEN form = 0 THEN 'denied' ELSE CASE kind
    WHEN 0 THEN '{"position":"Engineer ' || lang || '","company":"Acme ' || lang || '"' || CASE WHEN form = 1 THEN '' ELSE ',"date":"2024-01-30T12:00:00Z"' END || '}'
    WHEN 1 THEN '{"name":"tool","owner":{"login":"own"},"description":"d"}'
    WHEN 2 THEN '{"name":"Org ' || lang || CASE WHEN form = 1 THEN '' ELSE ' Inc.' END || '"}'
    WHEN 3 THEN '<html><head><title>News ' || lang || '</title>' || CASE WHEN form = 1 THEN '' ELSE '<meta property="article:published_time" content="2024-01-30T12:00:00Z">' END
      || '</head><body><p>Something new happened today.</p></body></html>'
    ELSE '<html><head><meta name="citation_title" content="Paper ' || lang || '">' || CASE WHEN form = 1 THEN '' ELSE '<meta name="citation_date" content="2024/01/02">' END
      || '</head></html>' END END"""


@query("batch_records", on("arrivals", """SELECT seq, status, CASE WHEN status = 'NEW_RECORD_STORED' THEN
      CASE kind WHEN 0 THEN 'jobs' WHEN 1 THEN 'products' WHEN 2 THEN 'startups' WHEN 3 THEN 'news' ELSE 'research_papers' END END AS record_table
    FROM (SELECT *, CASE WHEN late = 1 THEN CASE WHEN doc_id % 4 >= 2 OR (doc_id % 4 = 1 AND kind = 1) THEN 'DUPLICATE_ALREADY_PROCESSED' ELSE 'NEW_RECORD_STORED' END
        WHEN form = 0 THEN 'FETCH_FAILED' WHEN form = 1 AND kind IN (0, 3) THEN 'FRESHNESS_REJECTED'
        WHEN form = 1 AND kind = 2 THEN 'EVIDENCE_REJECTED' WHEN form = 1 AND kind = 4 THEN 'VALIDATION_FAILED'
        ELSE 'NEW_RECORD_STORED' END AS status FROM f)"""))
def _(t: Tables):
    payloads = t.frame("arrivals").selectExpr(
        "seq", "url", "source_name", f"{_RAW} AS raw_content", "'text' AS content_type",
        "CASE WHEN form = 0 THEN 403 ELSE 200 END AS http_status",
    )
    result = run_batch(payloads, default_registry(), seed_master(t.spark), None, ref(), F.lit(REF_TEXT))
    placed = None
    for table, df in result.tables.items():
        part = df.select("seq", F.lit(table).alias("record_table"))
        placed = part if placed is None else placed.unionByName(part)
    return result.statuses.select("seq", "status").join(shuffled(placed), "seq", "left")


_NAMES = [
    ("arxiv", "RESEARCH_PAPER"), ("paperswithcode", "RESEARCH_PAPER"), ("githuborgs", "STARTUP"), ("startups", "STARTUP"),
    ("githubproducts", "PRODUCT"), ("hfmodels", "PRODUCT"), ("products", "PRODUCT"), ("huggingfacedailypapers", "NEWS"),
    ("techcrunchai", "NEWS"), ("mittechreviewai", "NEWS"), ("openaiblog", "NEWS"), ("hackernewsai", "NEWS"),
    ("remoteokai", "JOB"), ("arbeitnow", "JOB"), ("jobicy", "JOB"), ("hnwhoishiring", "JOB"), ("weworkremotelyai", "JOB"),
    ("aijobsnet", "JOB"), ("ycworkatastartup", "JOB"), ("cryptojobsai", "JOB"), ("jobs", "JOB"), ("nowhere", None),
]
_NAME = "CASE doc_id % 22 " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in enumerate(_NAMES)) + " END"
_KIND = "CASE doc_id % 22 " + " ".join(f"WHEN {i} THEN '{k}'" for i, (_, k) in enumerate(_NAMES) if k) + " END"


@query("registry_names", f"SELECT doc_id, {_KIND} AS record_type FROM documents")
def _(t: Tables):
    registry = default_registry()
    kinds = F.create_map(*[F.lit(x) for n in registry.names() for x in (n, registry.get(n).record_type)])
    rows = t.documents.selectExpr("doc_id", f"upper({_NAME}) AS name")
    return rows.select("doc_id", kinds[registry.key_of(F.col("name"))].alias("record_type"))


_FEED = "CASE page_id % 5 WHEN 0 THEN 'TechCrunchAI' WHEN 1 THEN 'HuggingFaceDailyPapers' WHEN 2 THEN 'MITTechReviewAI' WHEN 3 THEN 'OpenAIBlog' ELSE 'HackerNewsAI' END"


_DEFAULTS = "CASE source_name " + " ".join(f"WHEN '{n}' THEN '{{{k}}}'" for k, n in enumerate(NEWS_FEEDS)) + " ELSE {4} END"


@query("news_sources_all", f"""SELECT seq, source_name, title,
      coalesce(CASE WHEN source_name <> 'HackerNewsAI' AND f % 4 = 0 THEN 'From OpenAI' END, nullif(d, ''), nullif(substr(m, 1, 300), ''),
        {_DEFAULTS.format(*(summary for _, summary in NEWS_FEEDS.values()), 'title')}) AS summary
    FROM (SELECT seq, source_name, m, d, f, coalesce(CASE WHEN f % 2 = 0 THEN 'Feed ' || CAST(f AS STRING) END, nullif(h, ''),
        {_DEFAULTS.format(*(title for title, _ in NEWS_FEEDS.values()), f"'{STORY_TITLE}'")}) AS title
      FROM (SELECT page_id AS seq, f, {_FEED} AS source_name, title AS h, meta_description AS d, main_text AS m FROM {sql_page_facts(SQL_LISTED)}))""")
def _(t: Tables):
    pages = page_payloads(t)
    named = pages.withColumn("source_name", F.expr(_FEED.replace("page_id", "seq")))
    found = default_registry(feed_metadata(t)).union(named, ref(), at())
    text = F.col("payload")
    return found.select(
        "seq", "source_name", json_text(text, "$.content.title").alias("title"), json_text(text, "$.content.summary").alias("summary"))


_N = "CAST(page_id AS STRING)"
_FORMS = f"""CASE page_id % 7
    WHEN 0 THEN '<div class=''content''><div>Alpha inside a division</div><p>Beta is block ' || {_N} || '</p></div><p>This is outside of it</p>'
    WHEN 1 THEN '<article><article>Inner</article><p>After the nested one ' || {_N} || '</p></article><p>This is outside of it</p>'
    WHEN 2 THEN '<main><p>Here x < 5 and y > 3 holds for ' || {_N} || '</p></main><p>This is outside of it</p>'
    WHEN 3 THEN '<div class="post"><p>Never closed at all ' || {_N} || '<div>more'
    WHEN 4 THEN '<html><body><div><p>In the body of page ' || {_N} || '</p></div></body></html>'
    WHEN 5 THEN '<p title="a > b">No container for page ' || {_N} || '</p>'
    ELSE '<div class="entry"><div>One ' || {_N} || '</div><div>Two</div></div><div>Three</div>' END"""


@query("main_text_forms", f"""SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'Beta is block ' || {_N} WHEN 1 THEN 'After the nested one ' || {_N}
    WHEN 2 THEN 'Here x < 5 and y > 3 holds for ' || {_N} WHEN 3 THEN 'Never closed at all ' || {_N}
    WHEN 4 THEN 'In the body of page ' || {_N} WHEN 5 THEN 'No container for page ' || {_N}
    ELSE 'One ' || {_N} || chr(10) || 'Two' END AS main_text FROM pages""")
def _(t: Tables):
    rows = t.pages.selectExpr("page_id", f"{_FORMS} AS html")
    return H.with_main_text(rows, "html", "main_text").select("page_id", "main_text")


_WRITTEN = """CASE event_id % 16 WHEN 8 THEN '2024-01-' || d || 'T08:00Z' WHEN 9 THEN '2024-01-' || d || ' 08:00 UTC' WHEN 10 THEN 'Tue Jan ' || d || ' 08:00:00 2024'
    WHEN 11 THEN '01/' || d || '/2024 8:00' WHEN 12 THEN d || '-Jan-2024 8 am' WHEN 13 THEN '2024.01.' || d || ' 08:00:00.25'
    WHEN 14 THEN d || ' Jan 2024 8am' WHEN 15 THEN 'Jan 2024 08:00' WHEN 0 THEN 'Tue, ' || d || ' Jan 2024 08:00 GMT' WHEN 1 THEN d || ' Jan 2024 08:00 +0000'
    WHEN 2 THEN d || ' Jan 24 08:00:00 GMT' WHEN 3 THEN 'January ' || d || ', 2024 08:00' WHEN 4 THEN d || ' January 2024 08:00:00'
    WHEN 5 THEN 'Jan ' || d || ', 2024 8:00 AM' WHEN 6 THEN '202401' || d || 'T080000Z' ELSE '40 Jan 2024 08:00 GMT' END"""


@query("written_dates", """SELECT event_id, CASE WHEN event_id % 16 NOT IN (7, 15) THEN '2024-01-' || CAST(10 + user_id % 20 AS STRING) || 'T08:00:00Z' END AS at FROM events""")
def _(t: Tables):
    rows = t.events.selectExpr("event_id", "CAST(10 + user_id % 20 AS STRING) AS d").selectExpr("event_id", f"{_WRITTEN} AS text")
    return rows.select("event_id", T.iso8601(T.parse_timestamp(F.col("text"), ref())).alias("at"))


@query("dead_letter_payloads", """SELECT page_id AS seq, url AS source_url, '{"html":' || CAST(length(html) AS STRING) || '}' AS payload_json,
    '2024-01-31T00:00:00Z' AS enqueued_at, substr(html, 1, 200) AS preview FROM pages""")
def _(t: Tables):
    rows = t.pages.selectExpr(
        "page_id AS seq", "url", "html AS raw_content", "'{\"html\":' || CAST(length(html) AS STRING) || '}' AS payload")
    letters = dead_letters(rows, F.lit("X"), F.lit("Y"), F.lit("Z"), enqueued_at=F.lit(REF_TEXT))
    return letters.select("seq", "source_url", "payload_json", "enqueued_at", "preview")


# Every tab from a table of its own; for jobs and news every second row is fresh.
_TABS = {
    "startups": ("supplier", "s_suppkey"), "products": ("part", "p_partkey"), "research_papers": ("documents", "doc_id"),
    "jobs": ("orders", "o_orderkey"), "news": ("pages", "page_id"), "entity_mappings": ("customer", "c_custkey"),
}


@query("export_all_tabs", " UNION ALL ".join(
    f"SELECT '{tab}' AS tab, CAST({key} AS STRING) AS id, 'https://x.org/' || CAST({key} AS STRING) AS source_url, "
    f"'{EXPORT_TABS[tab][-1][1]}, \"' || CAST({key} AS STRING) || '\"' AS last_cell FROM {table}"
    + (f" WHERE {key} % 2 = 0" if tab in ("jobs", "news") else "") for tab, (table, key) in _TABS.items()))
def _(t: Tables):
    tables = {}
    for tab, (table, name) in _TABS.items():
        key = F.col(name).cast("string")
        special = {
            "id": key, "source_url": F.concat(F.lit("https://x.org/"), key), "authors": F.array(F.lit("A"), F.lit("B")),
            "github_stars": F.lit(3),
        }
        cells = {c: special.get(c, F.concat(F.lit(f'{c}, "'), key, F.lit('"'))) for _, c in EXPORT_TABS[tab]}
        gate = F.struct(F.when(F.col(name) % 2 == 0, F.lit("FRESH")).otherwise(F.lit("STALE")).alias("status"))
        tables[tab] = getattr(t, table).select(*[v.alias(c) for c, v in cells.items()], gate.alias("gate"))
    folder = shared_dir(t.spark, "export")
    export_csv(tables, folder)
    out = None
    for tab in _TABS:
        headers = [h for h, _ in EXPORT_TABS[tab]]
        back = t.spark.read.schema(", ".join(f"{h} string" for h in headers)).option("header", True).option("escape", '"').csv(f"{folder}/{tab}")
        part = back.select(F.lit(tab).alias("tab"), F.col("ID").alias("id"), F.col("SourceURL").alias("source_url"), F.col(headers[-1]).alias("last_cell"))
        out = part if out is None else out.unionByName(part)
    return out
