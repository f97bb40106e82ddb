"""Queries over sources: scans, adapters, page extraction.

Adapters are checked on payloads that Spark builds from the given tables: every row is written as
the JSON, XML or HTML its source would send and read back by the adapter, while the SQL computes the
expected record from the row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.catalog.base import Tables, on, query, ref
from recordmill.catalog.texts import (
    sql_decode,
    sql_mentions,
    sql_role,
    sql_strip,
)
from recordmill.fixed_values import JSON_LD_DATE_KEYS, META_DATE_KEYS, NOISE_TAGS
from recordmill.functions.html import flatten_json_objects, json_ld_dates
from recordmill.operators.lookups import metadata_attach
from recordmill.operators.ranking import (
    discover_slice,
    first_source_wins,
    multi_facet_discovery,
)
from recordmill.operators.sinks import landed
from recordmill.sources import feeds, jobs, news, pages, papers, products, startups
from recordmill.sources.registry import default_registry
from recordmill.session import shared_dir
from recordmill.sources.tables import raw_scan, table_read

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def at() -> Column:
    return F.lit("2024-01-31T00:00:00Z")


def page_payloads(t: Tables) -> DataFrame:
    return t.pages.select(
        F.col("page_id").alias("seq"), "url", F.lit("WebPages").alias("source_name"),
        F.col("html").alias("raw_content"),
        F.when(F.col("page_id") % 4 == 0, F.lit("application/xml")).otherwise(F.lit("text/html")).alias("content_type"),
        F.lit(200).alias("http_status"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 3600).alias("fetched_at"),
    )


@query("raw_scan", "SELECT page_id AS seq, url, length(html) AS chars, 200 AS http_status FROM pages")
def _(t: Tables):
    # The payloads are landed as parquet and read back by the operator.
    path = shared_dir(t.spark, "landing")
    page_payloads(t).write.parquet(path)
    return raw_scan(t.spark, path).select(
        "seq", "url", F.length("raw_content").cast("bigint").alias("chars"), "http_status"
    )


@query("land_raw", f"""SELECT page_id AS seq, url, sha256(html) AS content_hash,
    CAST(octet_length(encode(html)) AS BIGINT) AS content_length,
    strftime(TIMESTAMP '2024-01-01' + to_hours(page_id), '%Y-%m-%d') AS fetch_date,
    substr(sha256(html), 1, 16) || CASE WHEN page_id % 4 = 0 THEN '.xml' ELSE '.html' END AS file_key
    FROM pages""")
def _(t: Tables):
    return landed(page_payloads(t)).select(
        "seq", "url", "content_hash", "content_length", "fetch_date", "file_key"
    )


# --- Papers --------------------------------------------------------------------------------------

# Texts as an XML parser sees them: no control characters, line ends normalised.
_XML_TEXT = r"""regexp_replace(text, '[^\p{L}\p{N}\p{P}\p{S}\p{Z}\n]', ' ', 'g')"""


def _xml_text(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}\p{P}\p{S}\p{Z}\n]", " ")


def _escaped(c: Column) -> Column:
    for sign, name in (("&", "amp"), ("<", "lt"), (">", "gt")):
        c = F.replace(c, F.lit(sign), F.lit(f"&{name};"))
    return c


def _element(name: str, body: Column) -> Column:
    return F.when(body.isNotNull(), F.concat(F.lit(f"<{name}>"), _escaped(body), F.lit(f"</{name}>"))).otherwise("")


def atom_payloads(t: Tables) -> DataFrame:
    doc, text = F.col("doc_id"), _xml_text(F.col("text"))
    link = F.when(doc % 3 == 0, F.concat(F.lit(" See https://github.com/lab/repo"), doc.cast("string"), F.lit(" now"))).otherwise("")
    authors = F.when(doc % 4 == 1, F.lit("")).otherwise(
        F.concat(
            F.lit("<author>"), _element("name", F.concat(F.lit(" Ann "), F.col("source"))),
            F.lit("</author><author>"), _element("name", F.col("lang")), F.lit("</author>"),
        )
    )
    body = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>Query</title><entry><id>x</id>'),
        _element("title", F.when(doc % 5 != 2, F.concat(F.lit("Paper\n"), F.col("source"), F.lit(" & more ")))),
        authors,
        _element("published", F.when(doc % 6 != 3, F.lit("2026-09-10T14:00:00Z"))),
        _element("summary", F.concat(text, link)),
        F.lit("</entry></feed>"),
    )
    return t.documents.select(
        doc.alias("seq"),
        F.concat(F.lit("https://arxiv.org/abs/"), doc.cast("string")).alias("url"),
        F.lit("ArXiv").alias("source_name"), body.alias("raw_content"),
    )


SQL_ATOM = rf"""SELECT doc_id AS seq, 'https://arxiv.org/abs/' || CAST(doc_id AS STRING) AS paper_url,
    CASE WHEN doc_id % 5 <> 2 THEN 'Paper ' || source || ' & more' ELSE 'Untitled arXiv Paper' END AS title,
    CASE WHEN doc_id % 4 = 1 THEN 'Unknown Author' ELSE 'Ann ' || source || '|' || lang END AS authors,
    CASE WHEN doc_id % 6 <> 3 THEN '2026-09-10T14:00:00Z' END AS published_date,
    CASE WHEN doc_id % 3 = 0 THEN 'https://github.com/lab/repo' || CAST(doc_id AS STRING) END AS github_url,
    replace({sql_strip(f"{_XML_TEXT} || CASE WHEN doc_id % 3 = 0 THEN ' See https://github.com/lab/repo' || CAST(doc_id AS STRING) || ' now' ELSE '' END")}, chr(10), ' ') AS abstract
    FROM documents"""


def _paper_columns(df: DataFrame) -> DataFrame:
    c = "content."
    return df.select(
        "seq", f"{c}paper_url", f"{c}title", F.array_join(f"{c}authors", "|").alias("authors"),
        f"{c}published_date", f"{c}github_url", f"{c}abstract",
    )


@query("atom_papers", SQL_ATOM)
def _(t: Tables):
    return _paper_columns(papers.atom_papers(atom_payloads(t), ref(), at()))


def paper_page_payloads(t: Tables) -> DataFrame:
    """Half with ``citation_*`` tags, half with page elements only. The rows of ``part`` are so short that
    millions of them lie in one block of a file, which one task would read: they are dealt out first."""
    p = F.col("p_partkey")
    key = p.cast("string")
    cited = F.concat(
        F.lit('<html><head><meta name="citation_title" content="Study of '), F.col("p_name"),
        F.lit(' &amp; more"/><meta content="'), F.col("p_brand"),
        F.lit('" name="citation_author"><meta name="citation_author" content="Bo, C.">'),
        F.lit('<meta name="citation_date" content="2026/09/10"><meta name="citation_abstract" content=" On '),
        F.col("p_type"), F.lit('. "></head><body>https://github.com/lab/p'), key, F.lit(" </body></html>"),
    )
    plain = F.concat(
        F.lit('<html><body><h1 class="title mathjax"><span class="descriptor">Title:</span>Study of '),
        F.col("p_name"), F.lit('</h1><div class="authors"><a href="#">'), F.col("p_brand"),
        F.lit('</a>, <a href="#">Bo, C.</a></div><div class="dateline">10 Sep 2026</div>'),
        F.lit('<blockquote class="abstract mathjax"><span class="descriptor">Abstract:</span> On '),
        F.col("p_type"), F.lit(".</blockquote></body></html>"),
    )
    dealt = t.part.select("p_partkey", "p_name", "p_brand", "p_type").repartition(3 * t.spark.sparkContext.defaultParallelism)
    return dealt.select(
        p.alias("seq"), F.concat(F.lit("https://arxiv.org/abs/p"), key).alias("url"),
        F.lit("ArXiv").alias("source_name"),
        F.when(p % 2 == 0, cited).otherwise(plain).alias("raw_content"),
    )


@query("paper_page_extract", """SELECT p_partkey AS seq, 'https://arxiv.org/abs/p' || CAST(p_partkey AS STRING) AS paper_url,
    'Study of ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' & more' ELSE '' END AS title,
    p_brand || '|Bo, C.' AS authors, '2026-09-10T00:00:00Z' AS published_date,
    CASE WHEN p_partkey % 2 = 0 THEN 'https://github.com/lab/p' || CAST(p_partkey AS STRING) END AS github_url,
    'On ' || p_type || '.' AS abstract FROM part""")
def _(t: Tables):
    return _paper_columns(pages.paper_page_extract(paper_page_payloads(t), ref(), at()))


@query("payload_dispatch", """SELECT p_partkey AS seq, 'html' AS kind FROM part
    UNION ALL SELECT doc_id, 'atom' FROM documents
    UNION ALL SELECT page_id + 1000000000000, 'html' FROM pages""")
def _(t: Tables):
    html = t.pages.select(
        (F.col("page_id") + 1000000000000).alias("seq"), F.col("html").alias("raw_content")
    )
    both = paper_page_payloads(t).select("seq", "raw_content").unionByName(
        atom_payloads(t).select("seq", "raw_content")
    ).unionByName(html)
    return both.select("seq", papers.payload_kind(F.col("raw_content")).alias("kind"))


# --- Feeds ------------------------------------------------------------------------------------------


def rss_payloads(t: Tables) -> DataFrame:
    """One feed per document with two items; some items have no link."""
    doc = F.col("doc_id")
    key = doc.cast("string")

    def item(n: int) -> Column:
        return F.concat(
            F.lit("<item>"),
            _element("title", F.concat(F.lit(f" Item {n}: "), F.col("source"), F.lit(" <b> "))),
            _element("link", F.when(doc % 7 != n, F.concat(F.lit("https://news.example.org/"), key, F.lit(f"/{n}")))),
            _element("pubDate", F.when(doc % 3 == 0, F.lit("Thu, 10 Sep 2026 00:00:37 +0000"))),
            _element("dc:date", F.when(doc % 3 < 2, F.lit("2026-09-11"))),
            _element("description", F.when(doc % 4 != 0, _xml_text(F.col("text")))),
            F.lit("</item>"),
        )

    body = F.concat(
        F.lit('<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>All</title>'),
        item(1), item(2), F.lit("</channel></rss>"),
    )
    return t.documents.select(doc.alias("seq"), body.alias("raw_content"))


@query("rss_items", rf"""SELECT doc_id AS seq, n - 1 AS pos,
    'https://news.example.org/' || CAST(doc_id AS STRING) || '/' || CAST(n AS STRING) AS url,
    'Item ' || CAST(n AS STRING) || ': ' || source || ' <b>' AS title,
    CASE WHEN doc_id % 3 = 0 THEN 'Thu, 10 Sep 2026 00:00:37 +0000' WHEN doc_id % 3 = 1 THEN '2026-09-11' END AS pub_date,
    CASE WHEN doc_id % 4 <> 0 THEN nullif({sql_strip(_XML_TEXT)}, '') END AS description
    FROM documents, (VALUES (1), (2)) v(n) WHERE doc_id % 7 <> n""")
def _(t: Tables):
    return feeds.rss_items(rss_payloads(t))


def daily_payloads(t: Tables) -> DataFrame:
    """One listing per turn of a conversation."""
    turn = F.col("turn")
    odd = turn % 3
    paper = F.struct(
        F.when(turn % 5 != 4, F.concat_ws(".", "conv_id", "turn")).alias("id"),
        F.when(odd == 0, F.col("text")).alias("title"),
        F.when(odd != 1, F.col("role")).alias("summary"),
        F.when(odd == 0, F.lit("2024-01-30T10:00:00Z")).alias("submittedOnDailyAt"),
        F.when(odd != 2, F.lit("2024-01-29T00:00:00.000Z")).alias("publishedAt"),
    )
    item = F.struct(
        paper.alias("paper"), F.lit("Outer title").alias("title"), F.lit("Outer summary").alias("summary"),
        F.lit("2024-01-28").alias("publishedAt"),
    )
    return t.conversations.select(
        F.col("conv_id").alias("seq"), F.to_json(F.array(item)).alias("raw_content")
    )


@query("daily_papers_json", """SELECT conv_id AS seq,
    'https://huggingface.co/papers/' || CAST(conv_id AS STRING) || '.' || CAST(turn AS STRING) AS url,
    CASE WHEN turn % 3 = 0 THEN text ELSE 'Outer title' END AS title,
    CASE turn % 3 WHEN 0 THEN '2024-01-30T10:00:00Z' WHEN 1 THEN '2024-01-29T00:00:00Z' ELSE '2024-01-28T00:00:00Z' END AS pub_date,
    CASE WHEN turn % 3 <> 1 THEN role ELSE 'Outer summary' END AS description
    FROM conversations WHERE turn % 5 <> 4""")
def _(t: Tables):
    return feeds.daily_papers_json(daily_payloads(t), ref()).drop("pos")


def story_payloads(t: Tables) -> DataFrame:
    e = F.col("event_id")
    title = F.concat(
        F.element_at(F.array(F.lit("New AI: "), F.lit("Said "), F.lit("GPT-4o beats "), F.lit("Email ")), (e % 4 + 1).cast("int")),
        F.col("event_type"),
    )
    story = F.struct(
        e.alias("id"),
        F.when(e % 3 == 0, F.concat(F.lit("https://blog.example.org/"), e.cast("string"))).when(e % 3 == 1, "").alias("url"),
        title.alias("title"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
    )
    return t.events.select(e.alias("seq"), F.to_json(story).alias("raw_content"))


@query("story_json", f"""SELECT event_id AS seq, CASE WHEN event_id % 3 = 0 THEN 'https://blog.example.org/' || CAST(event_id AS STRING)
      ELSE 'https://news.ycombinator.com/item?id=' || CAST(event_id AS STRING) END AS url,
    CASE event_id % 4 WHEN 0 THEN 'New AI: ' ELSE 'GPT-4o beats ' END || event_type AS title,
    strftime(ts, {_ISO}) AS pub_date FROM events WHERE event_id % 2 = 0""")
def _(t: Tables):
    return feeds.story_json(story_payloads(t))


# --- Jobs -------------------------------------------------------------------------------------------------


def board_payloads(t: Tables) -> DataFrame:
    """Rows of all three boards in turn, each in its board's own field names."""
    rows = t.frame("job_rows").withColumn("kind", F.col("seq") % 3)

    def body(title, company, date, place, text, *more) -> Column:
        return F.to_json(F.struct(
            F.col("job_title").alias(title),
            F.when(F.col("seq") % 4 != 0, F.col("company")).alias(company),
            F.col("published_date").alias(date),
            F.col("location").alias(place),
            F.when(F.col("seq") % 2 == 0, F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>"))).alias(text),
            *more,
        ))

    ok = body("position", "company", "date", "location", "description")
    now = body("title", "company_name", "created_at", "location", "description", F.col("is_remote").alias("remote"))
    icy = body("jobTitle", "companyName", "pubDate", "jobGeo", "jobDescription")
    return rows.select(
        "seq", F.col("source_url").alias("url"),
        F.element_at(F.array(F.lit("RemoteOKAI"), F.lit("Arbeitnow"), F.lit("Jobicy")), (F.col("kind") + 1).cast("int")).alias("source_name"),
        F.when(F.col("kind") == 0, ok).when(F.col("kind") == 1, now).otherwise(icy).alias("raw_content"),
    )


def _job_columns(df: DataFrame) -> DataFrame:
    c = "content."
    return df.select(
        "seq", F.col("source.name").alias("board"), f"{c}jobTitle", f"{c}company", f"{c}date",
        f"{c}is_remote", f"{c}role_family", f"{c}location", f"{c}descriptionSnippet",
    )


@query("jobs_json_flat", on("job_rows", f"""
    SELECT seq, board, title AS "jobTitle", company, date, is_remote, {sql_role('title', 'description')} AS role_family,
           location, nullif(substr(description, 1, 500), '') AS "descriptionSnippet"
    FROM (SELECT seq, board, title, company, date, is_remote, location,
          CASE WHEN board = 'RemoteOKAI' OR d = title THEN d ELSE {sql_strip("regexp_replace(d, '<[^>]+>', ' ', 'g')")} END AS description
      FROM (SELECT seq, board, title, company, date, is_remote, location,
            CASE WHEN seq % 2 = 0 THEN '<p>' || text || '</p>' ELSE title END AS d
        FROM (SELECT seq, text, CASE seq % 3 WHEN 0 THEN 'RemoteOKAI' WHEN 1 THEN 'Arbeitnow' ELSE 'Jobicy' END AS board,
              coalesce(nullif(job_title, ''), CASE WHEN seq % 3 = 2 THEN 'Remote Specialist' ELSE 'Software Engineer' END) AS title,
              CASE WHEN seq % 4 <> 0 THEN company ELSE CASE seq % 3 WHEN 0 THEN 'Remote OK Client' WHEN 1 THEN 'Arbeitnow Employer' ELSE 'Jobicy Employer' END END AS company,
              published_date AS date, CASE WHEN seq % 3 = 1 THEN is_remote ELSE true END AS is_remote,
              coalesce(location, CASE seq % 3 WHEN 0 THEN 'Worldwide Remote' WHEN 1 THEN CASE WHEN is_remote THEN 'Remote' ELSE 'Europe' END ELSE 'Remote' END) AS location
              FROM f)))"""))
def _(t: Tables):
    return _job_columns(jobs.jobs_json_flat(board_payloads(t), None, ref(), at()))


# A first line of parts, and the document below it.
_POST = """CASE doc_id % 6 WHEN 0 THEN '<p>Acme ' || source || ' | ML Engineer | Paris (REMOTE)</p>'
    WHEN 1 THEN 'Solo ' || lang WHEN 2 THEN 'A company name that is far too long to be taken for a company name | Dev | '
    WHEN 3 THEN '' WHEN 4 THEN '  x  |  y  |z| remote' ELSE 'One | Two' END"""
_POST_TEXT = sql_strip("regexp_replace(p || chr(10) || text, '<[^>]+>', ' ', 'g')")


def post_payloads(t: Tables) -> DataFrame:
    rows = t.documents.selectExpr("doc_id", "text", f"{_POST} AS p")
    post = F.struct(
        F.col("doc_id").cast("string").alias("objectID"),
        F.concat("p", F.lit("\n"), "text").alias("comment_text"),
        F.lit("2024-01-30T12:00:00Z").alias("created_at"),
    )
    return rows.select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("doc_id").cast("string")).alias("url"),
        F.to_json(post).alias("raw_content"),
    )


@query("jobs_pipe_posts", f"""
    SELECT seq, 'HNWhoIsHiring' AS board, title AS "jobTitle", company, '2024-01-30T12:00:00Z' AS date,
           contains(lower(s), 'remote') AS is_remote, {sql_role('title', 's')} AS role_family, location,
           nullif(substr(s, 1, 500), '') AS "descriptionSnippet"
    FROM (SELECT seq, s,
      CASE WHEN length(l[1]) <= 50 THEN l[1] ELSE 'HN Tech Company' END AS company,
      CASE WHEN length(l[2]) <= 80 THEN l[2] ELSE 'Software Engineer' END AS title,
      CASE WHEN length(l[3]) <= 80 THEN l[3] ELSE 'Remote / Onsite' END AS location
      FROM (SELECT seq, s, list_transform(string_split(coalesce(list_filter(list_transform(string_split(s, chr(10)),
              lambda x: {sql_strip('x')}), lambda x: x <> '')[1], 'HN Tech Company'), '|'), lambda x: {sql_strip('x')}) AS l
        FROM (SELECT doc_id AS seq, {_POST_TEXT} AS s FROM (SELECT doc_id, text, {_POST} AS p FROM documents)
              WHERE length(p || chr(10) || text) >= 30)))""")
def _(t: Tables):
    return _job_columns(jobs.jobs_pipe_posts(post_payloads(t), ref(), at()))


_COLON = """CASE p_partkey % 4 WHEN 0 THEN p_brand || ': ' || p_name WHEN 1 THEN p_name
    WHEN 2 THEN p_brand || ' :a: ' || p_type ELSE '' END"""


@query("jobs_colon_titles", f"""SELECT p_partkey AS seq, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 2 THEN p_brand ELSE 'WeWorkRemotely Client' END AS company,
    CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN 'a: ' || p_type ELSE 'WeWorkRemotely Position' END AS "jobTitle",
    '2026-09-10T00:00:37Z' AS date FROM part""")
def _(t: Tables):
    items = t.part.selectExpr(
        "p_partkey AS seq", "'https://wwr.example.org/' || p_partkey AS url", f"{_COLON} AS title",
        "'Thu, 10 Sep 2026 00:00:37 +0000' AS pub_date", "p_type AS description",
    )
    return jobs.jobs_colon_titles(items, ref(), at()).select(
        "seq", "content.company", "content.jobTitle", "content.date"
    )


# --- Startups and products -----------------------------------------------------------------------------------


def org_payloads(t: Tables) -> DataFrame:
    body = F.to_json(F.struct("name", "login", "blog", "description", "created_at", "location", "company", "is_verified"))
    return t.frame("org_rows").select("seq", "url", F.lit("GitHub Organizations").alias("source_name"), body.alias("raw_content"))


@query("org_json_startups", on("org_rows", """
    SELECT seq, url, coalesce(nullif(name, ''), login) AS "entityName",
      coalesce(nullif(trim(description), ''), coalesce(nullif(name, ''), login) || ' technology company') AS description,
      CASE WHEN coalesce(blog, '') = '' THEN NULL WHEN starts_with(blog, 'http') THEN blog ELSE 'https://' || blog END AS website,
      try_cast(substr(created_at, 1, 4) AS BIGINT) AS "foundingYear", nullif(trim(location), '') AS "hqLocation",
      CAST(NULL AS BIGINT) AS "employeeCount" FROM f"""))
def _(t: Tables):
    c = "content."
    return startups.org_json_startups(org_payloads(t), at()).select(
        "seq", "source.url", f"{c}entityName", f"{c}description", f"{c}website", f"{c}foundingYear",
        f"{c}hqLocation", f"{c}data.employeeCount",
    )


def repo_payloads(t: Tables) -> DataFrame:
    body = F.to_json(F.struct(
        F.when(F.col("seq") % 6 != 5, F.col("product_name")).alias("name"),
        F.when(F.col("seq") % 4 != 1, F.struct(F.col("startup_name").alias("login"))).alias("owner"),
        "description",
        F.when(F.col("seq") % 5 == 0, "2024-05-06T07:08:09Z").when(F.col("seq") % 5 == 1, "garbage").alias("created_at"),
        F.when(F.col("seq") % 2 == 0, F.col("source_url")).alias("html_url"),
    ))
    return t.frame("product_rows").select(
        "seq", F.concat(F.lit("https://github.com/o/r"), F.col("seq").cast("string")).alias("url"),
        F.lit("GitHub Repositories").alias("source_name"), body.alias("raw_content"),
    )


@query("repo_json_products", on("product_rows", """
    SELECT seq, CASE WHEN seq % 2 = 0 AND source_url <> '' THEN source_url ELSE 'https://github.com/o/r' || CAST(seq AS STRING) END AS url,
      CASE WHEN seq % 6 <> 5 THEN product_name ELSE 'r' || CAST(seq AS STRING) END AS "productName",
      trim(CASE WHEN seq % 4 <> 1 THEN startup_name ELSE 'Independent' END) AS "startupName", 'FREE' AS "pricingModel",
      CASE WHEN description <> '' THEN description ELSE CASE WHEN seq % 6 <> 5 THEN product_name ELSE 'r' || CAST(seq AS STRING) END || ' software product' END AS description,
      CASE WHEN seq % 5 = 0 THEN '2024-05-06T07:08:09Z' END AS "launchDate" FROM f"""))
def _(t: Tables):
    c = "content."
    return products.repo_json_products(repo_payloads(t), at()).select(
        "seq", "source.url", f"{c}productName", f"{c}startupName", f"{c}pricingModel",
        f"{c}description", f"{c}launchDate",
    )


_MODEL = "CASE WHEN page_id % 3 = 0 THEN 'https://huggingface.co/model-' || CAST(page_id AS STRING) ELSE replace(url, 'http://', 'https://huggingface.co/') END"


@query("model_id_products", f"""SELECT page_id AS seq, CASE WHEN len(p) > 1 THEN p[1] ELSE 'Community' END AS "startupName",
    CASE WHEN len(p) > 1 THEN p[2] ELSE m END AS "productName", m || ' AI model product hosted on Hugging Face' AS description
    FROM (SELECT page_id, m, string_split(m, '/') AS p FROM
      (SELECT page_id, replace({_MODEL}, 'https://huggingface.co/', '') AS m FROM pages))""")
def _(t: Tables):
    rows = t.pages.selectExpr("page_id AS seq", f"{_MODEL} AS url")
    c = "content."
    return products.model_id_products(rows, at()).select(
        "seq", f"{c}startupName", f"{c}productName", f"{c}description"
    )


# --- Pages -------------------------------------------------------------------------------------------------------

# The rules of ``sources.pages`` for an engine without look-around: names in either case, a tag's name ended
# by what is no word character, and tags whose quotes are closed.
_WORD = r"\p{L}\p{Nd}\p{Mn}_"
_END = rf"(?:[^{_WORD}>][^>]*)?>"
_BEFORE = rf"(?:^|[^{_WORD}])"
_AFTER = rf"(?:$|[^{_WORD}])"
_GAP = r"[\t-\r ]*"
_QUOTED = "(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
_META = rf"""<[mM][eE][tT][aA](?:(?:[^{_WORD}>"']|"[^"]*"|'[^']*'){_QUOTED}|>)"""
_WELL_FORMED = rf"^(?:[^<]|<+[^a-zA-Z/!?<]|<+[a-zA-Z/!?]{_QUOTED})*"


def _name(text: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


def _named(*tags: str) -> str:
    return "(?:" + "|".join(_name(t) for t in tags) + ")" + _END


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_first_element(html: str, tag: str) -> str:
    found = f"regexp_extract({html}, {_quote(rf'(?s)<{_named(tag)}(.*?)</{_name(tag)}{_GAP}>')}, 1)"
    return sql_strip(_sql_without_tags(found, "''"))


def _sql_without_tags(c: str, sign: str) -> str:
    """Tags end as they should up to the first whose quotes are not closed; from there on at the next sign."""
    closed = _quote(f"<[a-zA-Z/!?]{_QUOTED}")
    return (
        f"list_transform([{c}], lambda t: list_transform([regexp_extract(t, {_quote(_WELL_FORMED)}, 0)], lambda g: "
        f"regexp_replace(g, {closed}, {sign}, 'g') || regexp_replace(substr(t, length(g) + 1), '<[a-zA-Z/!?][^>]*>', {sign}, 'g'))[1])[1]"
    )


def _sql_attribute(tag: str, name: str) -> str:
    given = _BEFORE + _name(name) + _GAP + "=" + _GAP
    return " || ".join(
        f"regexp_extract({tag}, {_quote(given + value)}, 1)" for value in (r"""(?:"([^"]*)"|'[^']*'|[^\t-\r >]+)""", "'([^']*)'"))


def _sql_contents(attribute: str, value: str) -> str:
    given = _BEFORE + _name(attribute) + _GAP + "=" + _GAP + "[\"']?" + _name(value.replace(".", r"\.")) + r"""["'\t-\r />]"""
    return (
        f"list_transform(list_filter(tags, lambda x: regexp_matches(x, {_quote(given)})), "
        f"lambda x: nullif({_sql_attribute('x', 'content')}, ''))"
    )


def _sql_json_ld_dates(html: str) -> str:
    """How many dates the JSON-LD objects of a page give: a script is one object or a list of them."""
    pattern = rf"""(?s)<{_name('script')}[^{_WORD}>][^>]*{_name('type')}{_GAP}={_GAP}["']{_name('application/ld')}\+{_name('json')}["'][^>]*>(.*?)</{_name('script')}{_GAP}>"""
    objects = (
        f"flatten(list_transform(list_filter(regexp_extract_all({html}, {_quote(pattern)}, 1), lambda x: json_valid(x)), lambda x: "
        "CASE WHEN json_type(x) = 'ARRAY' THEN json_extract(x, '$[*]') ELSE [CAST(x AS JSON)] END))"
    )
    given = " + ".join(f"CASE WHEN json_type(x, '$.{key}') = 'VARCHAR' THEN 1 ELSE 0 END" for key in JSON_LD_DATE_KEYS)
    return f"coalesce(list_sum(list_transform(list_filter({objects}, lambda x: json_type(x) = 'OBJECT'), lambda x: {given})), 0)"


_NOISE = "(?s)<!--.*?-->|" + "|".join(f"<{_named(tag)}.*?</{_name(tag)}{_GAP}>" for tag in NOISE_TAGS)
_CONTAINERS = [
    ("article", _named("article")), ("main", _named("main")),
    ("div", rf"""{_name('div')}[^{_WORD}>][^>]*{_name('class')}{_GAP}={_GAP}["'][^"'>]*(?:{'|'.join(map(_name, ('content', 'post', 'article', 'body', 'entry')))})[^>]*>"""),
    ("body", _named("body")),
]
_BLOCKS = ("p", "h1", "h2", "h3", "h4", "li", "section")
_EDGES = (*_BLOCKS, "article", "main", "body", "ul", "ol", "div", "table", "tr", "td")
_BREAKS = r"[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def sql_page_facts(table: str) -> str:
    """The rows of ``table`` with title, canonical_url, meta_description, dates (how many) and main_text of
    their page: the text of the first container, block by block, or all of its lines when it has no block."""
    heads = [f"o{k}" for k in range(len(_CONTAINERS))]
    found = " ".join(f"WHEN {o} <> '' THEN '{tag}'" for o, (tag, _) in zip(heads, _CONTAINERS, strict=True))
    behind = " ".join(f"WHEN {o} <> '' THEN substr(clean, length({o}) + 1)" for o in heads)
    opened = ", ".join(f"regexp_extract(clean, {_quote(f'(?s)^.*?<{opening}')}, 0) AS {o}" for o, (_, opening) in zip(heads, _CONTAINERS, strict=True))

    def at_edges(cut: str) -> str:
        """``cut`` at the tags of the container's name."""
        return "CASE tag " + " ".join(f"WHEN '{tag}' THEN {cut}(tail, {_quote(f'</?{_named(tag)}')})" for tag, _ in _CONTAINERS) + " END"

    block, edge = f"<({_named(*_BLOCKS)})", f"</?{_named(*_EDGES)}"
    # A block's own tag is written with another sign, so that it is no edge.
    marked = f"regexp_replace(regexp_replace(container, {_quote(block)}, chr(1) || 'O' || chr(1114109) || '\\1', 'g'), {_quote(edge)}, chr(1) || 'C', 'g')"
    text = sql_strip(_sql_without_tags("replace(substr(x, 2), chr(1114109), '<')", "''"))
    lines = f"regexp_split_to_array({_sql_without_tags('container', 'chr(10)')}, '{_BREAKS}')"
    dates = " + ".join(f"CASE WHEN {_sql_contents(a, v)}[1] IS NOT NULL THEN 1 ELSE 0 END" for a, v in META_DATE_KEYS)
    named, shared = _sql_contents("name", "description"), _sql_contents("property", "og:description")
    related = _quote(_BEFORE + _name("rel") + _GAP + "=" + _GAP + "[\"']?" + _name("canonical") + _AFTER)
    canonical = f"list_filter(regexp_extract_all(page, {_quote('<' + _named('link'))}), lambda x: regexp_matches(x, {related}))"
    return f"""(SELECT * EXCLUDE (page, tags, clean, {', '.join(heads)}, tag, tail, edges, pieces, closing, container, blocks),
      {sql_decode(f"coalesce(nullif({sql_strip(_sql_contents('property', 'og:title') + '[1]')}, ''), nullif({_sql_first_element('page', 'title')}, ''), {_sql_first_element('page', 'h1')}, '')")} AS title,
      coalesce(nullif({_sql_attribute(canonical + '[1]', 'href')}, ''), url) AS canonical_url,
      {sql_decode(sql_strip(f"coalesce(CASE WHEN len({named}) > 0 THEN {named}[1] ELSE {shared}[1] END, '')"))} AS meta_description,
      CAST({dates} + {_sql_json_ld_dates('page')} AS BIGINT) AS dates,
      {sql_decode(f"CASE WHEN len(blocks) > 0 THEN array_to_string(blocks, chr(10) || chr(10)) ELSE array_to_string(list_filter(list_transform({lines}, lambda x: {sql_strip('x')}), lambda x: x <> ''), chr(10)) END")} AS main_text
    FROM (SELECT *, list_filter(list_transform(list_filter(string_split({marked}, chr(1)), lambda x: x[1] = 'O'), lambda x: {text}), lambda x: length(x) > 10) AS blocks
    FROM (SELECT *, CASE WHEN tag IS NULL THEN clean WHEN closing IS NULL THEN tail
        ELSE array_to_string(list_transform(list_zip(pieces[1:closing], edges[1:closing - 1]), lambda z: z[1] || coalesce(z[2], '')), '') END AS container
    FROM (SELECT *, list_filter(range(1, len(edges) + 1), lambda i: list_sum(list_transform(edges[1:i], lambda x: CASE WHEN starts_with(x, '</') THEN -1 ELSE 1 END)) < 0)[1] AS closing
    FROM (SELECT *, {at_edges('regexp_extract_all')} AS edges, {at_edges('regexp_split_to_array')} AS pieces
    FROM (SELECT *, CASE {found} END AS tag, CASE {behind} END AS tail
    FROM (SELECT *, {opened}
    FROM (SELECT *, coalesce(html, '') AS page, regexp_extract_all(coalesce(html, ''), {_quote(_META)}) AS tags,
        regexp_replace(coalesce(html, ''), {_quote(_NOISE)}, '', 'g') AS clean FROM {table}))))))))"""


@query("html_page_extract", f"SELECT page_id AS seq, title, canonical_url, meta_description, dates, main_text FROM {sql_page_facts('pages')}")
def _(t: Tables):
    found = pages.html_page_extract(page_payloads(t))
    dates = F.size("meta_dates") + F.size("json_ld_dates")
    return found.select(
        "seq", "title", "canonical_url", "meta_description", dates.cast("bigint").alias("dates"), "main_text"
    )


def dated_pages(t: Tables) -> DataFrame:
    """The pages, with meta tags and JSON-LD put into some."""
    p = F.col("page_id")
    meta = F.when(
        p % 4 == 0, F.lit('<meta content="2024-01-30T06:00:00Z" property="article:published_time">')
    ).when(p % 4 == 1, F.lit("<meta name='pubdate' content=' Tue, 30 Jan 2024 08:00:00 GMT '>")).otherwise("")
    data = F.when(
        p % 3 == 0, F.lit('[{"@type":"X","dateCreated":"2024-01-29","datePublished":"2024-01-28T01:02:03Z"},7,{"a":1}]')
    ).when(p % 3 == 1, F.lit('{"datePosted":"2024-01-27","dateModified":5}')).otherwise(F.lit('{broken'))
    extra = F.concat(
        meta, F.lit('<meta name="description" content=" About &lt;it&gt; "><link href="https://canon.example.org/'), p.cast("string"),
        F.lit('" rel="canonical"><script type="application/ld+json">'), data, F.lit("</script></head>"),
    )
    return page_payloads(t).withColumn("page_id", F.col("seq")).withColumn(
        "raw_content", F.replace("raw_content", F.lit("</head>"), extra)
    )


@query("published_at", """SELECT page_id AS seq, 'https://canon.example.org/' || CAST(page_id AS STRING) AS canonical_url, 'About <it>' AS meta_description,
    CASE WHEN page_id % 5 = 0 THEN '2024-01-26T00:00:00Z' WHEN page_id % 4 = 0 THEN '2024-01-30T06:00:00Z'
      WHEN page_id % 4 = 1 THEN '2024-01-30T08:00:00Z' WHEN page_id % 3 = 0 THEN '2024-01-28T01:02:03Z'
      WHEN page_id % 3 = 1 THEN '2024-01-27T00:00:00Z' END AS published_at FROM pages""")
def _(t: Tables):
    found = pages.html_page_extract(dated_pages(t))
    feed = F.when(F.col("seq") % 5 == 0, F.lit("2024-01-26")).when(F.col("seq") % 5 == 1, F.lit("no date"))
    return found.select(
        "seq", "canonical_url", "meta_description", pages.published_at(found, feed, ref()).alias("published_at")
    )


_LD = """CASE event_id % 4 WHEN 0 THEN '[' || props || ',5,{"datePublished":"d' || CAST(event_id AS STRING) || '"}]'
    WHEN 1 THEN '{"datePosted":"p","dateCreated":"c","v":' || props || '}' WHEN 2 THEN '"text"' ELSE '{bad' END"""


@query("json_ld_flatten", """SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS objects,
    CASE event_id % 4 WHEN 0 THEN 'd' || CAST(event_id AS STRING) WHEN 1 THEN 'c|p' ELSE '' END AS dates FROM events""")
def _(t: Tables):
    rows = t.events.selectExpr("event_id", f"{_LD} AS script")
    objects = rows.select("event_id", flatten_json_objects(F.array("script")).alias("o"))
    return objects.select(
        "event_id", F.size("o").cast("bigint").alias("objects"),
        F.array_join(json_ld_dates(F.col("o")), "|").alias("dates"),
    )


def feed_metadata(t: Tables) -> DataFrame:
    """Feed items for all pages, each listed twice; the later item counts. A third of the items
    give another address than the page has."""
    p = F.col("page_id")
    url = F.when(p % 3 == 2, F.concat("url", F.lit("#moved"))).otherwise(F.col("url")).alias("url")
    first = t.pages.select(
        url, p.alias("seq"), F.lit("Old").alias("title"), F.lit("2024-01-01").alias("pub_date"),
        F.lit("Old text").alias("description"),
    )
    second = t.pages.select(
        url, (p + 1000000000000).alias("seq"),
        F.when(p % 2 == 0, F.concat(F.lit("Feed "), p.cast("string"))).alias("title"),
        F.lit("2024-01-30").alias("pub_date"),
        F.when(p % 4 == 0, F.lit("From OpenAI")).alias("description"),
    )
    return first.unionByName(second)


#: The pages with ``f``, the page whose feed item counts for their address: the last that is listed under it.
SQL_LISTED = """(SELECT pages.*, f FROM pages LEFT JOIN
    (SELECT CASE WHEN page_id % 3 = 2 THEN url || '#moved' ELSE url END AS url, max(page_id) AS f FROM pages GROUP BY 1) USING (url))"""


@query("metadata_attach", f"""SELECT page_id, CASE WHEN f % 2 = 0 THEN 'Feed ' || CAST(f AS STRING) END AS feed_title,
    CASE WHEN f IS NOT NULL THEN '2024-01-30' END AS feed_date FROM {SQL_LISTED}""")
def _(t: Tables):
    joined = metadata_attach(t.pages, feed_metadata(t))
    return joined.select("page_id", F.col("feed.title").alias("feed_title"), F.col("feed.pub_date").alias("feed_date"))


@query("rss_news", f"""SELECT seq, title, summary, full_text, CASE WHEN f IS NOT NULL THEN '2024-01-30T00:00:00Z' ELSE '' END AS published_date,
      {sql_mentions("title || ' ' || summary || ' ' || full_text")} AS entities
    FROM (SELECT *, coalesce(nullif(m, ''), summary) AS full_text
    FROM (SELECT page_id AS seq, f, main_text AS m, coalesce(CASE WHEN f % 2 = 0 THEN 'Feed ' || CAST(f AS STRING) END, nullif(title, ''), 'TechCrunch AI News') AS title,
        coalesce(CASE WHEN f % 4 = 0 THEN 'From OpenAI' END, nullif(meta_description, ''), nullif(substr(main_text, 1, 300), ''), 'TechCrunch AI News article') AS summary
      FROM {sql_page_facts(SQL_LISTED)}))""")
def _(t: Tables):
    found = news.rss_news(page_payloads(t), feed_metadata(t), "TechCrunchAI", ref(), at())
    c = "content."
    return found.select(
        "seq", f"{c}title", f"{c}summary", f"{c}full_text", f"{c}published_date",
        F.array_join(f"{c}entities_mentioned", ";").alias("entities"),
    )


# --- Registry and discovery ---------------------------------------------------------------------------------------


@query("source_union", on("org_rows", """SELECT seq, 'STARTUP' AS record_type, 'GitHub Organizations' AS source_name FROM f
    UNION ALL SELECT doc_id, 'RESEARCH_PAPER', 'ArXiv' FROM documents
    UNION ALL SELECT doc_id, 'JOB', CASE doc_id % 3 WHEN 0 THEN 'RemoteOKAI' WHEN 1 THEN 'Arbeitnow' ELSE 'Jobicy' END FROM documents
    UNION ALL SELECT p_partkey, 'PRODUCT', 'GitHub Repositories' FROM part"""))
def _(t: Tables):
    columns = ["seq", "url", "source_name", "raw_content"]
    everything = org_payloads(t).select(columns)
    for more in (atom_payloads(t), board_payloads(t), repo_payloads(t)):
        everything = everything.unionByName(more.select(columns))
    shouted = everything.withColumn("source_name", F.upper("source_name"))
    return default_registry().union(shouted, ref(), at()).select("seq", "record_type", "source_name")


@query("discover_slice", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 100 OFFSET 40""")
def _(t: Tables):
    page = discover_slice(t.orders, [F.desc("o_orderdate"), F.asc("o_orderkey")], rows=100, offset=40)
    return page.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("multi_facet_discovery", """SELECT url, facet, pos FROM (
      SELECT url, facet, pos, row_number() OVER (PARTITION BY url ORDER BY facet, pos) AS rn FROM
        (SELECT p_brand || '/' || p_name AS url, p_size % 7 AS facet, p_partkey AS pos FROM part))
    WHERE rn = 1 ORDER BY facet, pos LIMIT 120""")
def _(t: Tables):
    listed = t.part.selectExpr("p_brand || '/' || p_name AS url", "p_size % 7 AS facet", "p_partkey AS pos")
    return multi_facet_discovery(listed, rows=120)


@query("first_source_wins", """SELECT url, arg_min(source_name, priority) AS source_name FROM (
      SELECT 'https://n/' || CAST(c_nationkey AS STRING) || '/' || c_mktsegment AS url, 'customers' AS source_name, 2 AS priority FROM customer
      UNION ALL SELECT 'https://n/' || CAST(s_nationkey AS STRING) || '/BUILDING', 'suppliers', 1 FROM supplier) GROUP BY url""")
def _(t: Tables):
    customers = t.customer.selectExpr(
        "'https://n/' || c_nationkey || '/' || c_mktsegment AS url", "'customers' AS source_name", "2 AS priority"
    )
    suppliers = t.supplier.selectExpr(
        "'https://n/' || s_nationkey || '/BUILDING' AS url", "'suppliers' AS source_name", "1 AS priority"
    )
    return first_source_wins(customers.unionByName(suppliers))


@query("table_read", "SELECT * FROM customer")
def _(t: Tables):
    return table_read(t.spark, t.folder, "customer", extra=("customer",))


@query("union_sources", """SELECT page_id AS seq, url, 'pages' AS source_name FROM pages
    UNION ALL SELECT doc_id, 'doc:' || CAST(doc_id AS STRING), source FROM documents""")
def _(t: Tables):
    a = t.pages.select(F.col("page_id").alias("seq"), "url", F.lit("pages").alias("source_name"))
    b = t.documents.select(
        F.col("doc_id").alias("seq"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("source_name"),
    )
    return a.unionByName(b)
