"""Queries over records: validation, routing, JSON values, enrichment, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.catalog.base import FRAMES, Tables, on, query
from recordmill.catalog.texts import SQL_PAPER_HASH, sql_arxiv_id, sql_github, sql_title
from recordmill.functions import classify as C
from recordmill.functions.text import github_url
from recordmill.functions.jsonvalues import authors_from_json, external_ids, json_text
from recordmill.operators import lookups as L
from recordmill.operators import papers as P
from recordmill.operators import sinks as K
from recordmill.operators import validate as V
from recordmill.operators.audits import audit_jobs, union_all
from recordmill.operators.chunks import merge_partials
from recordmill.operators.vector_index import build_index, search
from recordmill.operators.vectors import similar_vectors
from recordmill.schemas import RECORD_RULES, Rule
from recordmill.session import shared_dir
from recordmill.sources.feeds import unreadable

# --- Validation ---------------------------------------------------------------------------------


def _wrap(kind: str, content: str, extra: str = "''") -> str:
    """SQL text of a record around its content, valid in both engines."""
    return (
        f"""'{{"schemaVersion":"1.0","recordType":"{kind}","source":{{"name":"S","url":"https://s.example.org/"}},"content":{{' || """
        f"""{content} || '}},"collectedAt":"2026-01-01T00:00:00Z"' || {extra} || '}}'"""
    )


PAYLOADS = {
    "STARTUP": f"""SELECT s_suppkey AS seq, CASE WHEN s_suppkey % 12 = 10 THEN '{{oops' ELSE {_wrap('STARTUP', '''CASE s_suppkey % 12
        WHEN 0 THEN '"entityName":"' || s_name || '","data":{"employeeCount":5,"industries":["a"]}'
        WHEN 1 THEN '"entityName":"A","data":{"employeeCount":"many"}' WHEN 2 THEN '"entityName":"A","data":{"employeeCount":true}'
        WHEN 3 THEN '"entityName":"A","data":{"employeeCount":5.0}' WHEN 4 THEN '"entityName":"A","data":{"employeeCount":-1}'
        WHEN 5 THEN '"entityName":"A","more":1,"data":{"employeeCount":null,"x":{}}' WHEN 6 THEN '"entityName":"A","foundingYear":1800,"data":{"employeeCount":1}'
        WHEN 7 THEN '"entityName":"","data":{"employeeCount":1,"fundingTotalUsd":"1"}' WHEN 8 THEN '"entityName":"A"'
        WHEN 9 THEN '"entityName":"A","foundingYear":2020,"data":{"employeeCount":null,"fundingTotalUsd":1.5}'
        ELSE '"entityName":5,"foundingYear":2020.5,"website":null,"data":{"employeeCount":2,"industries":["a",5]}' END''',
        '''CASE WHEN s_suppkey % 5 = 0 THEN ',"extra":1' ELSE '' END''')} END AS payload FROM supplier""",
    "PRODUCT": f"""SELECT p_partkey AS seq, {_wrap('PRODUCT', '''CASE p_partkey % 7
        WHEN 0 THEN '"productName":"' || p_name || '","startupName":"' || p_brand || '","pricingModel":"FREE"'
        WHEN 1 THEN '"productName":"a","startupName":"b","pricingModel":"CHEAP"' WHEN 2 THEN '"productName":"","startupName":"","pricingModel":"PAID"'
        WHEN 3 THEN '"productName":"a","pricingModel":"PAID","category":7' WHEN 4 THEN '"productName":"a","startupName":"b","pricingModel":5,"launchDate":null'
        WHEN 5 THEN '"productName":null,"startupName":"b","pricingModel":"UNKNOWN","tags":[]' ELSE '"productName":"a","startupName":"b","pricingModel":"ENTERPRISE","description":"d"' END''')} AS payload FROM part""",
    "RESEARCH_PAPER": f"""SELECT doc_id AS seq, {_wrap('RESEARCH_PAPER', '''CASE doc_id % 6
        WHEN 0 THEN '"title":"' || source || '","authors":["a","b"],"paper_url":"u","github_url":null,"github_stars":null,"published_date":"d"'
        WHEN 1 THEN '"title":"t","authors":"a","paper_url":"u","github_url":null,"github_stars":-3,"published_date":"d"'
        WHEN 2 THEN '"title":"t","authors":[1,null],"paper_url":"u","github_stars":7,"published_date":null'
        WHEN 3 THEN '"title":"","authors":[],"paper_url":"u","github_url":"g","github_stars":1.5,"published_date":"d"'
        WHEN 4 THEN '"title":"t","authors":[],"paper_url":"u","github_url":"g","github_stars":12.0,"published_date":"d","abstract":null'
        ELSE '"title":"t","authors":[],"paper_url":{},"github_url":"g","github_stars":true,"published_date":"d","primaryCategory":[]' END''')} AS payload FROM documents""",
    "JOB": f"""SELECT event_id AS seq, {_wrap('JOB', '''CASE event_id % 6
        WHEN 0 THEN '"company":"' || event_type || '","date":"d","is_remote":true,"role_family":"r"'
        WHEN 1 THEN '"company":"c","date":null,"is_remote":false,"role_family":"r"' WHEN 2 THEN '"company":"c","date":"d","is_remote":1,"role_family":""'
        WHEN 3 THEN '"company":"","date":"d","is_remote":"true","role_family":"r","location":5' WHEN 4 THEN '"company":"c","role_family":"r","jobTitle":null'
        ELSE '"company":"c","date":"d","is_remote":false,"role_family":"r","salary":1' END''')} AS payload FROM events""",
    "NEWS": f"""SELECT conv_id * 1000 + turn AS seq, {_wrap('NEWS', '''CASE turn % 6
        WHEN 0 THEN '"title":"' || role || '","summary":"","full_text":"f","published_date":"","entities_mentioned":[]'
        WHEN 1 THEN '"title":"","summary":"s","full_text":"","published_date":"d","entities_mentioned":["a"]' WHEN 2 THEN '"title":"t","summary":null,"full_text":"f","published_date":"d","entities_mentioned":["a",2]'
        WHEN 3 THEN '"title":"t","summary":"s","full_text":"f","entities_mentioned":{}' WHEN 4 THEN '"title":"t","summary":"s","full_text":"f","published_date":"d","entities_mentioned":[],"topics":["x"],"authors":[]'
        ELSE '"title":"t","summary":"s","full_text":"f","published_date":5,"entities_mentioned":[],"topics":"x"' END''',
        '''CASE WHEN turn % 7 = 6 THEN ',"id":1' ELSE '' END''')} AS payload FROM conversations""",
}
FRAMES.update({f"payload_{k.lower()}": v for k, v in PAYLOADS.items()})
FRAMES["payload_mixed"] = """
    SELECT doc_id AS seq, CASE doc_id % 3 WHEN 0 THEN 'JOB' WHEN 1 THEN 'PODCAST' ELSE 'PRODUCT' END AS record_type,
      '{"schemaVersion":"1.0","recordType":"JOB","source":{"name":"S","url":"u"},"content":{"company":"' || source || '","date":"d","is_remote":true,"role_family":"r"},"collectedAt":"c"}' AS payload
    FROM documents"""
FRAMES["candidates"] = f"""
    SELECT conv_id AS record_id, turn AS tier, CASE (conv_id + turn) % 4
      WHEN 0 THEN 'not json' WHEN 1 THEN '{{"recordType":"NEWS"}}'
      ELSE {_wrap('NEWS', '''CASE WHEN (conv_id + turn) % 4 = 2 THEN '"title":"","summary":"s"' ELSE '"title":"' || role || '","summary":"s","full_text":"f","published_date":"","entities_mentioned":[]' END''')} END AS payload
    FROM conversations"""


def _sql_kind(j: str, path: str) -> str:
    number = f"CAST(json_extract({j}, '{path}') AS DOUBLE)"
    return (
        f"CASE json_type({j}, '{path}') WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' "
        f"WHEN 'HUGEINT' THEN 'integer' WHEN 'DOUBLE' THEN CASE WHEN {number} = floor({number}) THEN 'integer' ELSE 'number' END "
        f"WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' END"
    )


def _sql_checks(j: str, path: str, rule: Rule) -> list[str]:
    kind = _sql_kind(j, path)
    label = path.lstrip("$").lstrip(".") or "record"
    text = f"json_extract_string({j}, '{path}')"

    def when(condition: str, message: str) -> str:
        return f"CASE WHEN {condition} THEN '{label}: {message}' END"

    def among(values) -> str:
        return "(" + ", ".join(f"'{v}'" for v in values) + ")"

    accepted = [*rule.types, "integer"] if "number" in rule.types else list(rule.types)
    out = [when(f"({kind}) NOT IN {among(accepted)}", "type")]
    if rule.allowed is not None:
        out.append(when(f"({kind}) IS NOT NULL AND NOT (({kind}) = 'string' AND {text} IN {among(rule.allowed)})", "allowed"))
    if rule.min_length is not None:
        out.append(when(f"({kind}) = 'string' AND length({text}) < {rule.min_length}", "length"))
    if rule.minimum is not None:
        out.append(when(f"({kind}) IN ('integer', 'number') AND CAST({text} AS DOUBLE) < {rule.minimum}", "minimum"))
    if rule.maximum is not None:
        out.append(when(f"({kind}) IN ('integer', 'number') AND CAST({text} AS DOUBLE) > {rule.maximum}", "maximum"))
    if rule.items is not None:
        out.append(when(
            f"({kind}) = 'array' AND len(list_filter(json_extract({j}, '{path}[*]'), lambda x: json_type(x) <> 'VARCHAR')) > 0", "items"
        ))
    if rule.fields:
        known = "[" + ", ".join(f"'{f}'" for f in rule.fields) + "]"
        out.append(when(
            f"({kind}) = 'object' AND len(list_filter(json_keys({j}, '{path}'), lambda k: NOT list_contains({known}, k))) > 0", "extra keys"
        ))
    for name in rule.required:
        out.append(when(f"({kind}) = 'object' AND json_type({j}, '{path}.{name}') IS NULL", f"missing {name}"))
    for name, below in rule.fields.items():
        out.extend(_sql_checks(j, f"{path}.{name}", below))
    return out


def sql_errors(kind: str, payload: str = "payload") -> str:
    j = f"(CASE WHEN json_valid({payload}) THEN {payload} END)"
    checks = ", ".join(_sql_checks(j, "$", RECORD_RULES[kind]))
    return (
        f"CASE WHEN NOT json_valid({payload}) THEN 'record: not JSON' ELSE "
        f"array_to_string(list_sort(list_filter([{checks}], lambda x: x IS NOT NULL)), '; ') END"
    )


def _register_validation(kind: str, name: str) -> None:
    frame = f"payload_{kind.lower()}"

    @query(name, on(frame, f"SELECT seq, errors, errors = '' AS valid FROM (SELECT seq, {sql_errors(kind)} AS errors FROM f)"))
    def _(t: Tables):
        checked = V.validate(t.frame(frame), kind)
        return checked.select("seq", F.array_join("errors", "; ").alias("errors"), "valid")


for _kind, _name in (
    ("STARTUP", "validate_startup"), ("PRODUCT", "validate_product"),
    ("RESEARCH_PAPER", "validate_paper"), ("JOB", "validate_job"), ("NEWS", "validate_news"),
):
    _register_validation(_kind, _name)


@query("validate_unknown_type", on("payload_mixed", f"""
    SELECT seq, errors, errors = '' AS valid FROM (SELECT seq, CASE record_type WHEN 'JOB' THEN {sql_errors('JOB')}
      WHEN 'PRODUCT' THEN {sql_errors('PRODUCT')} ELSE 'no schema registered for ''' || record_type || '''' END AS errors FROM f)"""))
def _(t: Tables):
    mixed = t.frame("payload_mixed")
    checked = V.validate_by_type(mixed, types=V.present_types(mixed))
    return checked.select("seq", F.array_join("errors", "; ").alias("errors"), "valid")


FRAMES["page_records"] = f"""
    SELECT page_id AS seq, url, html AS raw_content, {_wrap('NEWS', '''CASE WHEN page_id % 3 = 0 THEN '"title":"","summary":"s"' ELSE '"title":"t","summary":"s","full_text":"f","published_date":"","entities_mentioned":[]' END''')} AS payload
    FROM pages"""


@query("route_dlq", on("page_records", f"""
    SELECT seq, 'EXTRACTION_OR_VALIDATION_FAILED' AS error_category, errors AS error_message, 'ExtractionLayer' AS failed_component,
      substr(raw_content, 1, 200) AS preview, CAST(3 AS BIGINT) AS attempts FROM (SELECT *, {sql_errors('NEWS')} AS errors FROM f) WHERE errors <> ''
    UNION ALL SELECT seq, NULL, NULL, NULL, NULL, NULL FROM (SELECT *, {sql_errors('NEWS')} AS errors FROM f) WHERE errors = ''"""))
def _(t: Tables):
    good, bad = V.route(V.validate(t.frame("page_records"), "NEWS"))
    columns = ["error_category", "error_message", "failed_component", "preview"]
    kept = good.select(
        "seq", *[F.lit(None).cast("string").alias(c) for c in columns], F.lit(None).cast("bigint").alias("attempts")
    )
    return bad.select("seq", *columns, "attempts").unionByName(kept)


@query("append_dlq", on("crawl_log", r"""
    SELECT 'dlq_' || substr(sha256(concat_ws('|', sha256('https://c.example.org/' || CAST(event_id AS STRING)), CAST(event_id AS STRING), 'FETCH_FAILED')), 1, 32) AS dlq_id,
      'https://c.example.org/' || CAST(event_id AS STRING) AS source_url, 'HTTP ' || CAST(status AS STRING) AS error_message, 'AsyncCrawlerLayer' AS failed_component
    FROM f WHERE kind = 'request' AND status >= 400"""))
def _(t: Tables):
    failed = t.frame("crawl_log").filter("kind = 'request' AND status >= 400").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("https://c.example.org/"), F.col("event_id").cast("string")).alias("url"),
        F.col("body").alias("raw_content"), "status",
    )
    rows = V.dead_letters(
        failed, F.lit("FETCH_FAILED"), F.lit("AsyncCrawlerLayer"), F.concat(F.lit("HTTP "), F.col("status").cast("string"))
    )
    return rows.select("dlq_id", "source_url", "error_message", "failed_component")


FRAMES["listings"] = """
    SELECT page_id AS seq, url, CASE page_id % 3 WHEN 0 THEN 'rss' WHEN 1 THEN 'papers' ELSE 'story' END AS kind,
      CASE page_id % 9 WHEN 0 THEN '<rss><channel><item><link>' || url || '</link></item></channel></rss>' WHEN 3 THEN '<rss><channel></channel></rss>'
        WHEN 6 THEN html WHEN 1 THEN '[]' WHEN 4 THEN '{"error":1}' WHEN 7 THEN '[{' WHEN 2 THEN '{"id":1}' WHEN 5 THEN '[1]' ELSE '' END AS raw_content
    FROM pages"""


@query("unreadable_listings", on("listings", """SELECT seq, url AS source_url, 'EXTRACTION_OR_VALIDATION_FAILED' AS error_category,
    'unreadable ' || kind || ' listing' AS error_message, substr(raw_content, 1, 200) AS preview FROM f WHERE page_id % 9 IN (6, 4, 7, 5, 8)""".replace("page_id", "seq")))
def _(t: Tables):
    rows = t.frame("listings")
    bad = union_all([unreadable(rows.filter(F.col("kind") == k), k) for k in ("rss", "papers", "story")])
    letters = V.dead_letters(
        bad, F.lit("EXTRACTION_OR_VALIDATION_FAILED"), F.lit("ExtractionLayer"), F.col("reason"))
    return letters.select("seq", "source_url", "error_category", "error_message", "preview")


_STEPS = """SELECT event_id, user_id % 5 = 0 AS duplicate, event_id % 7 <> 0 AS fetched, event_type IN ('click', 'view') AS needs_gate,
    CASE event_id % 3 WHEN 0 THEN 'FRESH' WHEN 1 THEN 'STALE' ELSE 'UNKNOWN' END AS gate, event_id % 11 <> 1 AS extracted, event_id % 13 <> 2 AS valid FROM events"""
FRAMES["steps"] = _STEPS


@query("record_status", on("steps", """SELECT event_id, CASE WHEN duplicate THEN 'DUPLICATE_ALREADY_PROCESSED' WHEN NOT fetched THEN 'FETCH_FAILED'
    WHEN needs_gate AND gate <> 'FRESH' THEN 'FRESHNESS_REJECTED' WHEN NOT extracted THEN 'EXTRACTION_FAILED'
    WHEN NOT valid THEN 'VALIDATION_FAILED' ELSE 'NEW_RECORD_STORED' END AS status FROM f"""))
def _(t: Tables):
    names = ("duplicate", "fetched", "needs_gate", "gate", "extracted", "valid")
    return t.frame("steps").select("event_id", V.pipeline_status(*[F.col(c) for c in names]).alias("status"))


@query("first_valid_candidate", on("candidates", f"""
    SELECT record_id, min(CASE WHEN e = '' THEN tier END) AS tier, arg_min(CASE WHEN e = '' THEN payload END, CASE WHEN e = '' THEN tier END) AS payload
    FROM (SELECT *, {sql_errors('NEWS')} AS e FROM f) GROUP BY record_id"""))
def _(t: Tables):
    chosen, exhausted = V.first_valid_candidate(t.frame("candidates"), "NEWS")
    none = exhausted.select(
        "record_id", F.lit(None).cast(chosen.schema["tier"].dataType).alias("tier"), F.lit(None).cast("string").alias("payload")
    )
    return chosen.unionByName(none)


# --- JSON and arrays ----------------------------------------------------------------------------------

_PROPS = "CASE WHEN event_id % 5 = 0 THEN 'k=' || props WHEN event_id % 5 = 1 THEN '' ELSE props END"


@query("parse_data_json", f"""SELECT event_id, CASE WHEN json_valid(j) THEN CAST(json_extract(j, '$.k') AS BIGINT) END AS k
    FROM (SELECT event_id, {_PROPS} AS j FROM events)""")
def _(t: Tables):
    rows = t.events.selectExpr("event_id", f"{_PROPS} AS j")
    return rows.select("event_id", json_text(F.col("j"), "$.k").try_cast("bigint").alias("k"))


_AUTHORS = """CASE c_custkey % 4 WHEN 0 THEN '["' || c_name || '", "B"]' WHEN 1 THEN '[]' WHEN 2 THEN 'broken [' ELSE '{"a":1}' END"""


@query("authors_json", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name || ';B' ELSE '' END AS authors FROM customer")
def _(t: Tables):
    rows = t.customer.selectExpr("c_custkey", f"{_AUTHORS} AS j")
    return rows.select("c_custkey", F.array_join(authors_from_json(F.col("j")), ";").alias("authors"))


@query("external_id_explode", on("raw_names", """SELECT seq, 'crunchbase' AS id_kind, lower(trim(crunchbase)) AS id_value FROM f WHERE trim(crunchbase) <> ''
    UNION ALL SELECT seq, 'custkey', 'k' || CAST(seq AS STRING) FROM f"""))
def _(t: Tables):
    ids = F.create_map(F.lit("CrunchBase"), F.col("crunchbase"), F.lit(" CustKey"), F.concat(F.lit("K"), F.col("seq").cast("string")))
    rows = t.frame("raw_names").select("seq", F.explode(external_ids(ids)).alias("e"))
    return rows.select("seq", F.col("e.key").alias("id_kind"), F.col("e.value").alias("id_value"))


FRAMES["partials"] = """
    SELECT conv_id, turn, CASE WHEN turn % 4 = 1 THEN NULL WHEN turn % 4 = 0 THEN '' ELSE text END AS summary,
      CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 3 = 1 THEN role || ',x' || CAST(turn AS STRING) || ',' || role
           ELSE 'y,' || role || ',x' || CAST(turn - 1 AS STRING) || ',y' END AS tags,
      CASE WHEN turn > 0 THEN length(text) END AS size
    FROM conversations"""


@query("merge_partials", on("partials", """,
    items AS (SELECT conv_id, turn, unnest(l) AS item, generate_subscripts(l, 1) AS i FROM
      (SELECT conv_id, turn, CASE WHEN tags = '' THEN [] ELSE string_split(tags, ',') END AS l FROM f)),
    base AS (SELECT conv_id, min(turn) AS b FROM items GROUP BY conv_id),
    firsts AS (SELECT conv_id, item, turn, i FROM items QUALIFY row_number() OVER (PARTITION BY conv_id, item ORDER BY turn, i) = 1),
    placed AS (SELECT * FROM firsts UNION SELECT conv_id, item, turn, i FROM items JOIN base USING (conv_id) WHERE turn = b),
    lists AS (SELECT conv_id, string_agg(item, ',' ORDER BY turn, i) AS tags FROM placed GROUP BY conv_id),
    scalars AS (SELECT conv_id, arg_max(summary, (length(summary), -turn)) FILTER (summary IS NOT NULL) AS summary,
      CAST(arg_min(size, turn) FILTER (size IS NOT NULL) AS BIGINT) AS size FROM f GROUP BY conv_id)
    SELECT conv_id, summary, coalesce(tags, '') AS tags, size FROM scalars LEFT JOIN lists USING (conv_id)"""))
def _(t: Tables):
    empty = F.array().cast("array<string>")
    rows = t.frame("partials").withColumn(
        "tags", F.when(F.col("tags") == "", empty).otherwise(F.split("tags", ","))
    )
    merged = merge_partials(rows, "conv_id", "turn", ["summary"], ["tags"], ["size"])
    return merged.select("conv_id", "summary", F.array_join("tags", ",").alias("tags"), F.col("size").cast("bigint").alias("size"))


# --- Defects and quality ---------------------------------------------------------------------------------

_BODY = """CASE doc_id % 9 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN substr(text, 1, 20) WHEN 3 THEN text || ' <b>bold</b>'
    WHEN 4 THEN text || ' R&amp;D' WHEN 5 THEN text || text || text ELSE text END"""


@query("content_defects", rf"""SELECT doc_id, CASE WHEN b = '' THEN 'missing' WHEN length(s) = 0 THEN 'empty' WHEN length(s) < 50 THEN 'short'
      WHEN length(s) > 10000 THEN 'long' ELSE 'ok' END AS length_class,
    b <> '' AND regexp_matches(s, '<[a-zA-Z/][^>]*>') AS tag_leakage,
    b <> '' AND (contains(s, chr(65533)) OR contains(s, '&amp;') OR contains(s, '&lt;')) AS encoding_problem
    FROM (SELECT doc_id, b, regexp_replace(b, '^<ws>+|<ws>+$', '', 'g') AS s FROM (SELECT doc_id, {_BODY} AS b FROM documents))""")
def _(t: Tables):
    rows = t.documents.selectExpr("doc_id", f"{_BODY} AS b")
    return rows.select("doc_id", C.content_defects(F.col("b")).alias("d")).select("doc_id", "d.*")


@query("text_quality_class", f"""SELECT doc_id, CASE WHEN length(b) >= 500 THEN 'FULL_TEXT' WHEN length(b) >= 100 THEN 'PARTIAL_TEXT'
    WHEN length(b) > 0 THEN 'FEED_ONLY' ELSE 'FETCH_FAILURE' END AS quality FROM (SELECT doc_id, {_BODY} AS b FROM documents)""")
def _(t: Tables):
    rows = t.documents.selectExpr("doc_id", f"{_BODY} AS b")
    return rows.select("doc_id", C.text_quality(F.col("b")).alias("quality"))


@query("date_defects", on("paper_rows", """SELECT id, CASE WHEN published_date = '' THEN 'missing' WHEN try_cast(replace(published_date, 'Z', '') AS TIMESTAMP) IS NULL THEN 'invalid'
    WHEN year(CAST(replace(published_date, 'Z', '') AS TIMESTAMP)) > 2027 THEN 'future' ELSE 'ok' END AS defect FROM f"""))
def _(t: Tables):
    return t.frame("paper_rows").select("id", C.date_defect(F.col("published_date")).alias("defect"))


@query("pending_enrichment", on("paper_rows", """SELECT id, CASE WHEN github_stars IS NOT NULL THEN 'COMPLETED'
    WHEN trim(coalesce(github_url, '')) <> '' THEN 'PENDING' ELSE 'NO_DATA' END AS status FROM f"""))
def _(t: Tables):
    status = C.enrichment_status(F.col("github_url"), F.col("github_stars"))
    return t.frame("paper_rows").select("id", status.alias("status"))


def stored_papers(t: Tables) -> DataFrame:
    """Papers as stored: most fields only inside ``data_json``."""
    kind = F.col("id") % 5
    content = F.struct(
        F.when(kind == 0, F.concat(F.lit(" "), F.col("text"))).alias("abstract"),
        F.when(kind.isin(0, 1), F.col("text")).when(kind == 2, F.lit("")).alias("summary"),
        F.col("category").alias("primaryCategory"),
    )
    body = F.to_json(F.struct(
        content.alias("content"), F.when(kind == 2, F.col("text")).alias("abstract"), F.when(kind == 3, F.col("text")).alias("summary"),
    ))
    return t.frame("paper_rows").withColumn("data_json", F.when(F.col("id") % 10 == 9, F.lit("{bad")).otherwise(body)).withColumn(
        "authors", F.split("author_list", ",")
    )


_SQL_ABSTRACT = "CASE WHEN id % 5 < 4 AND id % 10 <> 9 THEN nullif(regexp_replace(text, '^<ws>+|<ws>+$', '', 'g'), '') END"
_SQL_CATEGORY = "CASE WHEN id % 10 <> 9 AND category <> '' THEN category ELSE 'cs.AI' END"


@query("abstract_fallback", on("paper_rows", f"SELECT id, {_SQL_ABSTRACT} AS abstract, {_SQL_CATEGORY} AS category FROM f"))
def _(t: Tables):
    return stored_papers(t).select(
        "id", P.abstract_fallback(F.col("data_json")).alias("abstract"), P.category_fallback(F.col("data_json")).alias("category")
    )


@query("backfill_papers", on("paper_rows", f"""
    SELECT id, {sql_arxiv_id('source_url')} AS arxiv_id, {sql_title('title')} AS normalized_title, category AS primary_category, abstract,
      {SQL_PAPER_HASH} AS content_hash, CASE WHEN github_stars IS NOT NULL THEN 'COMPLETED' WHEN trim(coalesce(github_url, '')) <> '' THEN 'PENDING' ELSE 'NO_DATA' END AS enrichment_status
    FROM (SELECT * REPLACE ({_SQL_CATEGORY} AS category), {_SQL_ABSTRACT} AS abstract FROM f)"""))
def _(t: Tables):
    return P.backfill_papers(stored_papers(t)).select(
        "id", "arxiv_id", "normalized_title", "primary_category", "abstract", "content_hash", "enrichment_status"
    )


# --- Enrichment ---------------------------------------------------------------------------------------------

_ANSWER = """CASE doc_id % 7 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 503 WHEN 4 THEN 302 ELSE 200 END"""
FRAMES["repo_status"] = f"""
    SELECT doc_id AS seq, 'https://github.com/lab' || CAST(doc_id % 60 AS STRING) || CASE WHEN doc_id % 2 = 0 THEN '/repo.git' ELSE '/repo' END AS github_url,
      {_ANSWER} AS http_status, CASE WHEN doc_id % 7 IN (0, 5) THEN doc_id * 3 END AS stars FROM documents"""
_SQL_ENRICHED = f"""r AS ({FRAMES['repo_status']}),
    a AS (SELECT {sql_github('github_url')} AS repo, arg_max(http_status, seq) AS http_status, arg_max((stars, 1), seq)[1] AS stars FROM r GROUP BY 1),
    e AS (SELECT f.id, f.source_url, f.published_date, a.repo, CASE WHEN trim(coalesce(f.github_url, '')) = '' THEN 'NO_DATA' WHEN p.repo IS NULL THEN 'PERMANENT_FAILURE'
      WHEN http_status = 200 THEN 'COMPLETED' WHEN http_status = 404 THEN 'PERMANENT_FAILURE' WHEN http_status IN (403, 429) OR http_status >= 500 OR http_status IS NULL THEN 'RETRYABLE_FAILURE'
      ELSE 'PERMANENT_FAILURE' END AS enrichment_status, CASE WHEN http_status = 200 THEN stars END AS github_stars, f.github_url
      FROM f LEFT JOIN (SELECT id, {sql_github('github_url')} AS repo FROM f) p USING (id) LEFT JOIN a ON a.repo = p.repo)"""


def enriched(t: Tables) -> DataFrame:
    return L.enrich_repo_stats(t.frame("paper_rows").drop("github_stars"), t.frame("repo_status"))


def on_enriched(sql: str) -> str:
    return on("paper_rows", f", {_SQL_ENRICHED} {sql}")


@query("enrich_repo_stats", on_enriched("SELECT id, github_stars FROM e"))
def _(t: Tables):
    return enriched(t).select("id", "github_stars")


@query("enrichment_state", on_enriched("SELECT id, enrichment_status AS status FROM e"))
def _(t: Tables):
    return enriched(t).select("id", F.col("enrichment_status").alias("status"))


@query("enrichment_backlog", on_enriched("SELECT id FROM e WHERE enrichment_status = 'RETRYABLE_FAILURE'"))
def _(t: Tables):
    return L.enrichment_backlog(enriched(t)).select("id")


@query("star_metrics", on_enriched("""SELECT count(*) AS papers, count(*) FILTER (trim(coalesce(github_url, '')) <> '') AS with_url, count(github_stars) AS with_stars,
    min(github_stars) AS min_stars, max(github_stars) AS max_stars, round(CAST(sum(github_stars) AS DOUBLE) / count(github_stars), 4) AS avg_stars FROM e"""))
def _(t: Tables):
    return L.star_metrics(enriched(t))


@query("audit_reference_join", "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def _(t: Tables):
    facts = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return L.audit_reference_join(t.supplier, facts, "s_nationkey").select("s_suppkey", "s_name", "n_name")


@query("paper_lookups", on("paper_rows", f"""
    , p AS (SELECT id, {sql_arxiv_id('source_url')} AS arxiv_id, category, published_date, github_stars, CASE WHEN github_stars IS NOT NULL THEN 'COMPLETED' WHEN trim(coalesce(github_url, '')) <> '' THEN 'PENDING' ELSE 'NO_DATA' END AS st FROM f)
    SELECT 'recent' AS lookup, id FROM (SELECT id FROM p WHERE published_date >= '2026-01-01' AND published_date < '3' ORDER BY published_date DESC, arxiv_id NULLS FIRST, id LIMIT 20)
    UNION ALL SELECT 'category', id FROM p WHERE category = 'cs.CL'
    UNION ALL SELECT 'starred', id FROM (SELECT id FROM p WHERE github_stars IS NOT NULL ORDER BY github_stars DESC, arxiv_id NULLS FIRST, id LIMIT 20)
    UNION ALL SELECT 'by_id', id FROM p WHERE arxiv_id = '2301.10007'
    UNION ALL SELECT 'pending', id FROM p WHERE st = 'PENDING'"""))
def _(t: Tables):
    papers = P.backfill_papers(
        t.frame("paper_rows").withColumn("authors", F.split("author_list", ",")).withColumn(
            "data_json", F.to_json(F.struct(F.struct(F.col("category").alias("primaryCategory")).alias("content")))
        )
    )
    found = {
        "recent": P.recent_papers(papers, F.lit("2026-01-01"), 20),
        "category": P.papers_in_category(papers, "cs.CL"),
        "starred": P.top_starred(papers, 20),
        "by_id": P.paper_by_id(papers, "2301.10007"),
        "pending": P.pending_papers(papers),
    }
    out = None
    for name, df in found.items():
        rows = df.select(F.lit(name).alias("lookup"), "id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("startups_with_starred_papers", on("repo_status", f"""
    , r AS (SELECT {sql_github('github_url')} AS repo, max(stars) AS stars FROM f GROUP BY 1),
    p AS (SELECT doc_id % 10007 AS startup_id, 'https://github.com/lab' || CAST(doc_id % 60 AS STRING) || '/repo' AS repo FROM documents)
    SELECT s_suppkey AS startup_id, s_name, count(*) AS papers, max(stars) AS max_stars FROM supplier JOIN p ON startup_id = s_suppkey JOIN r USING (repo)
    WHERE stars > 1500 GROUP BY ALL"""))
def _(t: Tables):
    repos = t.frame("repo_status").groupBy(github_url(F.col("github_url")).alias("repo")).agg(F.max("stars").alias("stars"))
    papers = t.documents.selectExpr(
        "doc_id % 10007 AS startup_id", "'https://github.com/lab' || CAST(doc_id % 60 AS STRING) || '/repo' AS repo"
    )
    startups = t.supplier.select(F.col("s_suppkey").alias("startup_id"), "s_name")
    return L.startups_with_starred_papers(startups, papers, repos, 1500)


@query("similar_vectors", """WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, round(score, 6) AS similarity FROM (
      SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM q)) AS score FROM embeddings)
    ORDER BY score DESC, vec_id LIMIT 20""")
def _(t: Tables):
    wanted = t.embeddings.filter("vec_id = 0").select("embedding").first()
    return similar_vectors(t.embeddings, "vec_id", "embedding", list(wanted[0]), 20)


@query("similar_vectors_indexed")
def _(t: Tables):
    # Every twentieth row asks all rows for its ten most similar ones.
    index = build_index(t.embeddings, "vec_id", "embedding", 10)
    return search(index, index.table.filter("vec_id % 20 = 0"), 10)


# --- Exports -----------------------------------------------------------------------------------------------------


@query("export_projection", on("paper_rows", f"""
    SELECT id AS "ID", replace(author_list, ',', '; ') AS "Authors", CASE WHEN category = '' THEN 'cs.AI' ELSE category END AS "PrimaryCategory",
      replace(text, chr(10), ' ') AS "Abstract", coalesce(github_url, '') AS "GitHubURL", coalesce(CAST(github_stars AS STRING), '') AS "GitHubStars", 'PENDING' AS "EnrichmentStatus"
    FROM f WHERE NOT contains(source_url, 'test-paper-')"""))
def _(t: Tables):
    tab = K.export_tab(export_papers(t), "research_papers")
    return tab.select("ID", "Authors", "PrimaryCategory", "Abstract", "GitHubURL", "GitHubStars", "EnrichmentStatus")


def export_papers(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    return t.frame("paper_rows").select(
        "id", F.lit("1.0").alias("schema_version"), "source_name", "source_url", "title", none.alias("arxiv_id"),
        none.alias("normalized_title"), F.split("author_list", ",").alias("authors"), F.col("source_url").alias("paper_url"),
        "github_url", "github_stars", F.col("category").alias("primary_category"), F.col("text").alias("abstract"),
        none.alias("content_hash"), none.alias("enrichment_status"), "published_date", F.lit("2026-01-01T00:00:00Z").alias("collected_at"),
    )


@query("export_tabs_csv", """SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS "ID", 'https://github.com/p/' || CAST(l_partkey AS STRING) AS "SourceURL",
    'Item, "' || l_linestatus || '"' AS "ProductName", l_returnflag AS "PricingModel" FROM lineitem""")
def _(t: Tables):
    rows = t.lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", "'1.0' AS schema_version", "'lineitem' AS source_name",
        "'https://github.com/p/' || l_partkey AS source_url", "'Item, \"' || l_linestatus || '\"' AS product_name",
        "CAST(l_suppkey AS STRING) AS startup_name", "l_returnflag AS pricing_model", "'2026-01-01T00:00:00Z' AS collected_at",
    )
    folder = shared_dir(t.spark, "export")
    K.export_csv({"products": rows}, folder)
    schema = ", ".join(f"{header} string" for header, _ in K.EXPORT_TABS["products"])
    back = t.spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{folder}/products")
    return back.select("ID", "SourceURL", "ProductName", "PricingModel")


@query("export_papers_json", on("paper_rows", """
    SELECT id, title, replace(author_list, ',', '|') AS authors, text AS abstract, github_stars, (SELECT count(*) FROM f WHERE NOT contains(source_url, 'test-paper-')) AS record_count
    FROM f WHERE NOT contains(source_url, 'test-paper-')"""))
def _(t: Tables):
    folder = shared_dir(t.spark, "export")
    K.export_papers_json(export_papers(t), F.lit("2026-01-01T00:00:00Z"), folder)
    records = t.spark.read.schema("id bigint, title string, authors array<string>, abstract string, github_stars bigint").json(f"{folder}/research_papers.jsonl")
    metadata = t.spark.read.schema("record_count bigint").json(f"{folder}/metadata.json")
    count = metadata.select("record_count").first()[0]
    return records.withColumn("authors", F.array_join("authors", "|")).withColumn("record_count", F.lit(count).cast("bigint"))


@query("report_json", on("job_rows", """
    SELECT '{"timestamp":"2026-01-01T00:00:00Z","identity":{"total_rows":' || CAST(count(*) AS STRING) || '},"completeness":{"remote_jobs":' ||
      CAST(count(*) FILTER (NOT contains(source_url, 'test-job-') AND is_remote) AS STRING) || ',"titles_populated":' ||
      CAST(count(*) FILTER (NOT contains(source_url, 'test-job-') AND job_title <> '') AS STRING) || '}}' AS document FROM f"""))
def _(t: Tables):
    report = audit_jobs(t.frame("job_rows").withColumn("description", F.col("text")))
    groups = {"identity": ["total_rows"], "completeness": ["remote_jobs", "titles_populated"]}
    return K.report_document(report, groups, F.lit("2026-01-01T00:00:00Z"))
