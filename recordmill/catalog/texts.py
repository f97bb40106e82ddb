"""Queries over text, URL, hash and date expressions."""

from __future__ import annotations

from html import _invalid_charrefs, _invalid_codepoints
from html.entities import html5

from pyspark.sql import functions as F

from recordmill.catalog.base import Tables, on, query, ref
from recordmill.fixed_values import (
    AI_TITLE_TERMS,
    ANTI_BOT_MARKERS,
    COMMERCIAL_TERMS,
    KNOWN_ENTITIES,
    LEGAL_ENTITY_TERMS,
    LEGAL_SUFFIXES,
    NOISE_TAGS,
    NON_STARTUP_TERMS,
    PRODUCT_WORDS,
    RESERVED_REPO_OWNERS,
    ROLE_FAMILIES,
    SKIPPED_WEBSITES,
    STARTUP_WORDS,
    TRACKING_PARAMETERS,
    WEBSITE_ENDINGS,
)
from recordmill.functions import classify as C
from recordmill.functions import html as H
from recordmill.functions import names as N
from recordmill.functions import text as X
from recordmill.functions import times as T
from recordmill.operators.chunks import chunk_rows
from recordmill.operators.fingerprints import near_dup_window, near_duplicates, simhash64
from recordmill.session import cut_lineage

# --- SQL pieces ---------------------------------------------------------------------------------


def sql_any(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^<ws>+|<ws>+$', '', 'g')"


def sql_space(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '<ws>+', ' ', 'g'))"


def sql_title(c: str) -> str:
    return rf"regexp_replace(lower({sql_space(c)}), '[.,:;\s]+$', '')"


def sql_words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({sql_strip(c)}, '<ws>+'), lambda w: w <> '')"


def sql_fingerprint(c: str) -> str:
    return f"CASE WHEN coalesce({c}, '') = '' THEN '' ELSE sha256(regexp_replace(lower({sql_strip(c)}), '/+$', '')) END"


def sql_arxiv_id(c: str) -> str:
    return (
        rf"coalesce(nullif(regexp_extract({c}, '(\d{{4}}\.\d{{4,5}})(v\d+)?', 1), ''), "
        rf"nullif(regexp_extract({c}, '([a-zA-Z\-]+/\d{{7}})(v\d+)?', 1), ''))"
    )


def sql_github(c: str) -> str:
    cleaned = rf"regexp_replace(regexp_replace({c}, '\.git/?$', ''), '/+$', '')"
    pattern = r"https?://github\.com/([a-zA-Z0-9_\-.]+)/([a-zA-Z0-9_\-.]+)"
    owner, repo = (f"regexp_extract({cleaned}, '{pattern}', {i})" for i in (1, 2))
    barred = ", ".join(f"'{o}'" for o in RESERVED_REPO_OWNERS)
    return (
        f"CASE WHEN {owner} <> '' AND lower({owner}) NOT IN ({barred}) "
        f"THEN 'https://github.com/' || {owner} || '/' || {repo} END"
    )


def sql_domain(c: str) -> str:
    bare = f"regexp_replace(lower({sql_strip(f'coalesce({c}, {chr(39)*2})')}), '^https?://', '')"
    return rf"regexp_replace(regexp_extract({bare}, '^[^/?#:]*'), '^www\.', '')"


def sql_entity(c: str) -> str:
    text = rf"regexp_replace(lower(coalesce({c}, '')), '\b&\b', 'and', 'g')"
    text = rf"regexp_replace({text}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    text = rf"regexp_replace({text}, '\b({'|'.join(LEGAL_SUFFIXES)})\b', '', 'g')"
    return sql_space(text)


def sql_entity_id(kind: str, name: str) -> str:
    return f"'cent_' || substr(sha256(lower({kind}) || ':' || trim(lower({name}))), 1, 12)"


def sql_capitalised(c: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({c}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


def _sql_map(pairs: dict) -> str:
    def cell(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return f"MAP {{{', '.join(f'{cell(k)}: {cell(v)}' for k, v in pairs.items())}}}"


def sql_decode(c: str) -> str:
    """Character references by the rules of HTML, in one pass: numbers, names, and the old names that need
    no semicolon, of which the longest counts that the reference begins with."""
    reference = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
    old = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    number = (
        r"CASE WHEN lower(r[3]) = 'x' THEN TRY_CAST('0x' || regexp_extract(r, '[0-9a-fA-F]+', 0) AS BIGINT) "
        r"ELSE TRY_CAST(regexp_extract(r, '[0-9]+', 0) AS BIGINT) END"
    )
    by_number = (
        f"list_transform([{number}], lambda n: CASE WHEN n IN ({', '.join(map(str, _invalid_charrefs))}) THEN {_sql_map(_invalid_charrefs)}[n] "
        f"WHEN n IS NULL OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN chr(65533) "
        f"WHEN n IN ({', '.join(map(str, sorted(_invalid_codepoints)))}) THEN '' ELSE chr(CAST(n AS INTEGER)) END)[1]"
    )
    begun = f"regexp_extract(r, '^&({'|'.join(old)})', 1)"
    by_old_name = f"CASE WHEN {begun} = '' THEN r ELSE {_sql_map({n: html5[n] for n in old})}[{begun}] || r[length({begun}) + 2:] END"
    named = {n: v for n, v in html5.items() if n.endswith(";")}
    decoded = (
        "CASE r " + " ".join(f"WHEN '&{n};' THEN {v}" for n, v in (("amp", "'&'"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)")))
        + f" ELSE CASE WHEN r[2] = '#' THEN {by_number} ELSE coalesce({_sql_map(named)}[r[2:]], {by_old_name}) END END"
    )
    return (
        f"list_transform([{c}], lambda t: array_to_string(list_transform(list_zip(regexp_split_to_array(t, '{reference}'), "
        f"regexp_extract_all(t, '{reference}')), lambda z: z[1] || coalesce(list_transform([z[2]], lambda r: {decoded})[1], '')), ''))[1]"
    )


def sql_denoise(c: str) -> str:
    c = f"regexp_replace({c}, '<!--.*?-->', '', 'gs')"
    for tag in NOISE_TAGS:
        c = rf"regexp_replace({c}, '<{tag}\b[^>]*>.*?</{tag}\s*>', '', 'gis')"
    return c


def sql_lines(c: str) -> str:
    lines = f"string_split(regexp_replace({c}, '<[^>]+>', chr(10), 'g'), chr(10))"
    return (
        f"array_to_string(list_filter(list_transform({lines}, lambda x: {sql_strip('x')}), "
        "lambda x: x <> ''), chr(10))"
    )


def sql_clean_html(c: str) -> str:
    return sql_decode(sql_lines(sql_denoise(c)))


def sql_truncate(c: str, size: int) -> str:
    top = int(size * 0.8)
    bottom = size - top
    return (
        f"CASE WHEN len({sql_words(c)}) <= {size} THEN {c} ELSE "
        f"array_to_string(({sql_words(c)})[1:{top}], ' ') || chr(10) || chr(10) || "
        f"'[... TRUNCATED FOR CONTEXT WINDOW ...]' || chr(10) || chr(10) || "
        f"array_to_string(({sql_words(c)})[-{bottom}:], ' ') END"
    )


def sql_role(title: str, description: str) -> str:
    text = f"lower(coalesce({title}, '') || ' ' || coalesce({description}, ''))"
    cases = " ".join(f"WHEN {sql_any(text, words)} THEN '{name}'" for name, words in ROLE_FAMILIES)
    return f"CASE {cases} ELSE 'Engineering' END"


def sql_whole(c: str, term: str) -> str:
    term = term.replace(".", r"\.")
    return rf"regexp_matches(lower({c}), '(^|[^\p{{L}}\p{{N}}_]){term}($|[^\p{{L}}\p{{N}}_])')"


def sql_mentions(c: str) -> str:
    items = ", ".join(f"CASE WHEN {sql_whole(c, n.lower())} THEN '{n}' END" for n in KNOWN_ENTITIES)
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ';')"


def sql_simhash(key: str, text: str, table: str) -> str:
    """CTE ``prints(key, simhash)``."""
    sums = ", ".join(f"sum((h >> {i}) & 1) AS b{i}" for i in range(64))
    bits = " + ".join(
        f"CASE WHEN b{i} * 2 >= n THEN CAST({1 << i} AS HUGEINT) ELSE 0 END" for i in range(64)
    )
    return (
        f"toks AS (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')) AS w "
        f"FROM {table}), "
        f"hs AS (SELECT {key}, CAST('0x' || substr(md5(w), 17, 16) AS UBIGINT) AS h FROM toks), "
        f"sums AS (SELECT {key}, count(*) AS n, {sums} FROM hs GROUP BY {key}), "
        f"vals AS (SELECT {key}, {bits} AS v FROM sums), "
        f"prints AS (SELECT t.{key}, CAST(coalesce(CASE WHEN v >= 9223372036854775808 "
        f"THEN v - 18446744073709551616 ELSE v END, 0) AS BIGINT) AS simhash "
        f"FROM {table} t LEFT JOIN vals USING ({key}))"
    )


# --- Text and URL ---------------------------------------------------------------------------------


@query("normalize_whitespace", f"SELECT doc_id, {sql_space('text')} AS text FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", X.normalize_whitespace(F.col("text")).alias("text"))


@query("normalize_title", on("paper_rows", f"SELECT id, {sql_title('title')} AS title FROM f"))
def _(t: Tables):
    return t.frame("paper_rows").select("id", X.normalize_title(F.col("title")).alias("title"))


@query("normalize_authors", on("paper_rows", f"""
    SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS authors
    FROM (SELECT id, list_filter(list_transform(string_split(author_list, ','),
                 lambda a: {sql_space('a')}), lambda a: a <> '') AS l FROM f)"""))
def _(t: Tables):
    authors = X.normalize_authors(F.split("author_list", ","))
    return t.frame("paper_rows").select("id", F.array_join(authors, "|").alias("authors"))


_ID_TEXT = """CASE WHEN id % 5 = 1 THEN 'math-ph/' || CAST(1000000 + id % 8000000 AS STRING) || 'v3'
              WHEN id % 5 = 2 THEN 'nothing ' || source_name ELSE source_url END"""


@query("arxiv_id", on("paper_rows", f"SELECT id, {sql_arxiv_id('u')} AS arxiv_id FROM (SELECT id, {_ID_TEXT} AS u FROM f)"))
def _(t: Tables):
    rows = t.frame("paper_rows").selectExpr("id", f"{_ID_TEXT} AS u")
    return rows.select("id", X.arxiv_id(F.col("u")).alias("arxiv_id"))


@query("arxiv_url", on("paper_rows", f"""
    SELECT id, coalesce('https://arxiv.org/abs/' || {sql_arxiv_id('u')}, u) AS arxiv_url
    FROM (SELECT id, {_ID_TEXT} AS u FROM f)"""))
def _(t: Tables):
    rows = t.frame("paper_rows").selectExpr("id", f"{_ID_TEXT} AS u")
    return rows.select("id", X.arxiv_url(F.col("u")).alias("arxiv_url"))


_REPO_TEXT = "CASE WHEN id % 3 = 0 THEN 'Code: ' || github_url || ' and more' ELSE github_url END"


@query("github_url", on("paper_rows", f"SELECT id, {sql_github('u')} AS github_url FROM (SELECT id, {_REPO_TEXT} AS u FROM f)"))
def _(t: Tables):
    rows = t.frame("paper_rows").selectExpr("id", f"{_REPO_TEXT} AS u")
    return rows.select("id", X.github_url(F.col("u")).alias("github_url"))


_DATE_TEXT = """CASE WHEN id % 11 = 3 THEN '2025-03-04T05:06:07+05:00'
                WHEN id % 11 = 4 THEN '2025-03-04 05:06:07.250' ELSE published_date END"""
_SQL_ISO = r"""CASE WHEN regexp_matches(d, '^\d{4}-\d{2}-\d{2}')
               THEN strftime(CAST(substr(d, 1, 19) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ')
               WHEN d <> '' THEN d END"""


@query("iso_date", on("paper_rows", f"SELECT id, {_SQL_ISO} AS iso FROM (SELECT id, {_DATE_TEXT} AS d FROM f)"))
def _(t: Tables):
    rows = t.frame("paper_rows").selectExpr("id", f"{_DATE_TEXT} AS d")
    return rows.select("id", T.iso_date(F.col("d")).alias("iso"))


@query("url_fingerprint", on("pages_seen", f"SELECT seq, {sql_fingerprint('url')} AS url_hash FROM f"))
def _(t: Tables):
    return t.frame("pages_seen").select("seq", X.url_fingerprint(F.col("url")).alias("url_hash"))


@query("content_hash", "SELECT page_id, sha256(html) AS content_hash FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", X.content_hash(F.col("html")).alias("content_hash"))


@query("content_bytes", "SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS bytes FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", X.content_bytes(F.col("text")).alias("bytes"))


SQL_PAPER_HASH = rf"""sha256(concat_ws(chr(1), {sql_title('title')},
    array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(author_list, ','),
        lambda a: {sql_space('a')}), lambda a: a <> ''))), chr(2)),
    {sql_space('abstract')},
    coalesce({_SQL_ISO.replace('(d', '(published_date').replace(' d ', ' published_date ')}, ''),
    coalesce({sql_arxiv_id('source_url')}, source_url, ''), lower({sql_space('category')})))"""


@query("paper_hash", on("paper_rows", f"SELECT id, {SQL_PAPER_HASH} AS content_hash FROM (SELECT *, text AS abstract FROM f)"))
def _(t: Tables):
    return t.frame("paper_rows").select(
        "id",
        X.paper_hash(
            F.col("title"), F.split("author_list", ","), F.col("text"),
            T.iso_date(F.col("published_date")), F.col("source_url"), F.col("category"),
        ).alias("content_hash"),
    )


@query("simhash64", f"WITH {sql_simhash('doc_id', 'text', 'documents')} SELECT doc_id, simhash FROM prints")
def _(t: Tables):
    return simhash64(t.documents, "doc_id", "text")


@query("hamming64", f"""WITH {sql_simhash('doc_id', 'text', 'documents')}
    SELECT a.doc_id, CAST(bit_count(xor(a.simhash, b.simhash)) AS BIGINT) AS distance
    FROM prints a JOIN prints b ON b.doc_id = a.doc_id + 1""")
def _(t: Tables):
    prints = cut_lineage(simhash64(t.documents, "doc_id", "text"), "prints")
    following = prints.select((F.col("doc_id") - 1).alias("doc_id"), F.col("simhash").alias("next"))
    return prints.join(following, "doc_id").select(
        "doc_id", X.hamming64(F.col("simhash"), F.col("next")).alias("distance")
    )


@query("near_duplicates", f"""WITH RECURSIVE {sql_simhash('doc_id', 'text', 'documents')},
    g AS (SELECT simhash, count(*) AS docs FROM prints GROUP BY simhash),
    e AS MATERIALIZED (SELECT a.simhash AS a, b.simhash AS b FROM g a JOIN g b ON a.simhash <> b.simhash AND bit_count(xor(a.simhash, b.simhash)) <= 3),
    r AS (SELECT simhash AS origin, simhash AS reached FROM g UNION SELECT r.origin, e.b FROM r JOIN e ON e.a = r.reached)
    SELECT g.simhash AS fingerprint, c.cluster, g.docs
    FROM g JOIN (SELECT origin, min(reached) AS cluster FROM r GROUP BY origin) c ON c.origin = g.simhash""")
def _(t: Tables):
    prints = cut_lineage(simhash64(t.documents, "doc_id", "text"), "prints")
    return near_duplicates(prints)


@query("near_dup_window", f"""WITH {sql_simhash('doc_id', 'text', 'documents')},
    d AS (SELECT doc_id, simhash, doc_id * 3 AS h FROM prints)
    SELECT a.doc_id, a.simhash, coalesce(bool_or(b.doc_id IS NOT NULL), false) AS is_duplicate
    FROM d a LEFT JOIN d b ON b.doc_id < a.doc_id AND a.h - b.h <= 168
         AND bit_count(xor(a.simhash, b.simhash)) <= 3
    GROUP BY ALL""")
def _(t: Tables):
    # The documents carry no time: one is taken to arrive every three hours.
    arrival = F.timestamp_seconds(F.col("doc_id") * 3 * 3600).alias("ts")
    prints = simhash64(t.documents, "doc_id", "text").select("doc_id", "simhash", arrival)
    return near_dup_window(cut_lineage(prints, "prints"), "doc_id", "ts")


@query("record_identity", f"SELECT page_id, 'webpages:' || {sql_fingerprint('url')} AS identity FROM pages")
def _(t: Tables):
    return t.pages.select(
        "page_id", X.record_identity(F.lit("WebPages"), F.col("url")).alias("identity")
    )


@query("strip_tags", f"""SELECT page_id, s AS text, substr(s, 1, 500) AS snippet
    FROM (SELECT page_id, {sql_strip("regexp_replace(html, '<[^>]+>', ' ', 'g')")} AS s FROM pages)""")
def _(t: Tables):
    rows = t.pages.select("page_id", X.strip_tags(F.col("html")).alias("text"))
    return rows.withColumn("snippet", X.snippet(F.col("text")))


@query("role_family", on("job_rows", f"SELECT seq, {sql_role('job_title', 'text')} AS role_family FROM f"))
def _(t: Tables):
    return t.frame("job_rows").select(
        "seq", X.role_family(F.col("job_title"), F.col("text")).alias("role_family")
    )


_NEWS_TEXT = """text || CASE doc_id % 6 WHEN 0 THEN ' OpenAI and GPT-4o, not GPT-4x.'
    WHEN 1 THEN ' meta: Scale AI / stability ai' WHEN 2 THEN ' NVIDIA''s CUDA; xai GPT-4'
    WHEN 3 THEN ' metadata pineapple appleé éapple' ELSE '' END"""


@query("entities_mentioned", f"SELECT doc_id, {sql_mentions('t')} AS entities FROM (SELECT doc_id, {_NEWS_TEXT} AS t FROM documents)")
def _(t: Tables):
    rows = t.documents.selectExpr("doc_id", f"{_NEWS_TEXT} AS t")
    found = X.entities_mentioned(F.col("t"))
    return rows.select("doc_id", F.array_join(found, ";").alias("entities"))


_TITLE_TEXT = """CASE doc_id % 5 WHEN 0 THEN 'New GPT-4o: ' || lang WHEN 1 THEN 'Said ' || source
    WHEN 2 THEN 'Deep  learning' WHEN 3 THEN 'Deep learning for ' || lang ELSE substr(text, 1, 80) END"""


@query("ai_title_filter", f"""SELECT doc_id FROM (SELECT doc_id, {_TITLE_TEXT} AS t FROM documents)
    WHERE {' OR '.join(sql_whole('t', w) for w in AI_TITLE_TERMS)}""")
def _(t: Tables):
    rows = t.documents.selectExpr("doc_id", f"{_TITLE_TEXT} AS t")
    return rows.filter(X.is_ai_title(F.col("t"))).select("doc_id")


@query("min_length_filter", "SELECT conv_id, turn FROM conversations WHERE length(text) >= 30")
def _(t: Tables):
    return t.conversations.filter(X.has_length(F.col("text"))).select("conv_id", "turn")


_LEGAL = rf"(?i)\b({LEGAL_ENTITY_TERMS})\b"
SQL_EVIDENCE = rf"""CASE WHEN contains(url, 'ycombinator.com') THEN 'YC_DIRECTORY_RECORD'
    WHEN regexp_matches(name || ' ' || login || ' ' || trim(description) || ' ' || coalesce(company, '') || ' ' || coalesce(blog, ''),
         '(?i)\b({NON_STARTUP_TERMS})\b') THEN 'ACADEMIC_OR_NON_PROFIT'
    WHEN is_verified THEN 'VERIFIED_COMPANY_DOMAIN'
    WHEN regexp_matches(name, '{_LEGAL}') THEN 'EXPLICIT_LEGAL_ENTITY(' || regexp_extract(name, '{_LEGAL}') || ')'
    WHEN regexp_matches(coalesce(company, ''), '{_LEGAL}') THEN 'EXPLICIT_LEGAL_ENTITY(' || regexp_extract(company, '{_LEGAL}') || ')'
    WHEN coalesce(blog, '') <> '' AND NOT {sql_any('lower(blog)', SKIPPED_WEBSITES)} AND {sql_any('lower(blog)', WEBSITE_ENDINGS)}
         AND (regexp_matches(description, '(?i)\b({COMMERCIAL_TERMS})\b') OR regexp_matches(coalesce(company, ''), '(?i)\b({COMMERCIAL_TERMS})\b'))
         THEN 'COMMERCIAL_WEBSITE_AND_PROFILE'
    ELSE 'INSUFFICIENT_COMPANY_EVIDENCE' END"""


def evidence():
    return C.startup_evidence(
        *[F.col(c) for c in ("url", "name", "login", "blog", "description", "company", "is_verified")]
    )


@query("startup_evidence", on("org_rows", f"""
    SELECT seq, reason NOT IN ('ACADEMIC_OR_NON_PROFIT', 'INSUFFICIENT_COMPANY_EVIDENCE') AS accepted, reason
    FROM (SELECT seq, {SQL_EVIDENCE} AS reason FROM f)"""))
def _(t: Tables):
    return t.frame("org_rows").select("seq", evidence().alias("e")).select("seq", "e.*")


@query("token_estimate", """SELECT conv_id, turn, CAST(CASE WHEN length(text) = 0 THEN 0
    ELSE greatest(1, length(text) // 4) END AS BIGINT) AS tokens FROM conversations""")
def _(t: Tables):
    return t.conversations.select("conv_id", "turn", X.token_estimate(F.col("text")).alias("tokens"))


@query("clean_html_text", f"SELECT page_id, {sql_clean_html('html')} AS text FROM pages")
def _(t: Tables):
    return H.with_clean_text(t.pages, "html", "text").select("page_id", "text")


@query("truncate_middle", f"SELECT doc_id, {sql_truncate('text', 100)} AS text FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", X.truncate_middle(F.col("text"), 100).alias("text"))


@query("prepare_payload", f"""SELECT page_id, {sql_truncate('c', 60)} AS text
    FROM (SELECT page_id, {sql_clean_html('html')} AS c FROM pages)""")
def _(t: Tables):
    return H.with_prepared_payload(t.pages, "html", "text", 60).select("page_id", "text")


@query("structural_chunks", f"""WITH RECURSIVE paras AS (
      SELECT doc_id, unnest(p) AS para, generate_subscripts(p, 1) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
    c AS (SELECT doc_id, i, para, len({sql_words('para')}) AS wc FROM paras),
    walk AS (
      SELECT doc_id, i, wc AS used, 0 AS pos FROM c WHERE i = 1
      UNION ALL
      SELECT c.doc_id, c.i, CASE WHEN used + wc > 80 THEN wc ELSE used + wc END,
             CASE WHEN used + wc > 80 THEN pos + 1 ELSE pos END
      FROM walk JOIN c ON c.doc_id = walk.doc_id AND c.i = walk.i + 1)
    SELECT c.doc_id, pos, string_agg(para, chr(10) ORDER BY c.i) AS chunk
    FROM walk JOIN c ON c.doc_id = walk.doc_id AND c.i = walk.i GROUP BY c.doc_id, pos""")
def _(t: Tables):
    return chunk_rows(t.documents, "doc_id", "text", max_words=80, separator="\n")


def sql_startup_class(url: str, name: str, description: str, website: str) -> str:
    text = f"lower(coalesce({name}, '') || ' ' || coalesce({description}, ''))"
    return (
        f"CASE WHEN contains({url}, 'ycombinator.com') THEN 'CLEARLY' "
        f"WHEN contains({url}, 'github.com') AND (coalesce({website}, '') <> '' OR {sql_any(text, STARTUP_WORDS)}) THEN 'PLAUSIBLY' "
        f"WHEN contains({url}, 'github.com') THEN 'NOT_DEMONSTRABLY' END"
    )


def sql_product_class(url: str, name: str, description: str) -> str:
    text = f"lower(coalesce({name}, '') || ' ' || coalesce({description}, ''))"
    return (
        f"CASE WHEN contains({url}, 'producthunt.com') THEN 'CLEARLY' "
        f"WHEN contains({url}, 'github.com') AND {sql_any(text, PRODUCT_WORDS)} THEN 'PLAUSIBLY' "
        f"WHEN contains({url}, 'github.com') THEN 'NOT_DEMONSTRABLY' END"
    )


@query("semantic_class", on("product_rows", f"SELECT seq, {sql_product_class('source_url', 'product_name', 'description')} AS class FROM f"))
def _(t: Tables):
    label = C.product_class(F.col("source_url"), F.col("product_name"), F.col("description"))
    return t.frame("product_rows").select("seq", label.alias("class"))


@query("fetch_class", on("crawl_log", f"""
    SELECT event_id, o AS outcome, o IN ('rate_limited', 'transient') AS retryable
    FROM (SELECT event_id, CASE WHEN status = 403 AND {sql_any("lower(coalesce(body, ''))", ANTI_BOT_MARKERS)} THEN 'anti_bot'
          WHEN status = 403 THEN 'blocked' WHEN status = 429 THEN 'rate_limited'
          WHEN status IN (408, 500, 502, 503, 504) THEN 'transient'
          WHEN status >= 400 THEN 'permanent' ELSE 'ok' END AS o FROM f)"""))
def _(t: Tables):
    found = C.fetch_class(F.col("status"), F.col("body"))
    return t.frame("crawl_log").select("event_id", found.alias("c")).select("event_id", "c.*")


# --- Names -------------------------------------------------------------------------------------------

_NAME_TEXT = """raw_name || CASE seq % 5 WHEN 0 THEN ' R&D, Ltd.' WHEN 1 THEN ' GmbH & Co' WHEN 2 THEN ' s.a.' ELSE '' END"""


@query("normalize_entity", on("raw_names", f"SELECT seq, {sql_entity('n')} AS name FROM (SELECT seq, {_NAME_TEXT} AS n FROM f)"))
def _(t: Tables):
    rows = t.frame("raw_names").selectExpr("seq", f"{_NAME_TEXT} AS n")
    return rows.select("seq", N.normalize_entity(F.col("n")).alias("name"))


@query("normalize_domain", f"SELECT page_id, {sql_domain('url')} AS domain FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", N.normalize_domain(F.col("url")).alias("domain"))


@query("entity_id", on("raw_names", f"SELECT seq, {sql_entity_id('entity_type', 'raw_name')} AS entity_id FROM f"))
def _(t: Tables):
    return t.frame("raw_names").select(
        "seq", N.entity_id(F.col("entity_type"), F.col("raw_name")).alias("entity_id")
    )


@query("title_case", on("raw_names", f"SELECT seq, {sql_capitalised(sql_entity('raw_name'))} AS name FROM f"))
def _(t: Tables):
    return t.frame("raw_names").select(
        "seq", N.title_case(N.normalize_entity(F.col("raw_name"))).alias("name")
    )


@query("jaro_winkler", on("raw_names", "SELECT seq, round(jaro_winkler_similarity(lower(c_name), lower(c_name || raw_name)), 6) AS similarity FROM f"))
def _(t: Tables):
    # The checking engine gives no prefix bonus to low scores, so the pairs compared score high.
    score = N.jaro_winkler(F.lower("c_name"), F.lower(F.concat("c_name", "raw_name")))
    return t.frame("raw_names").select("seq", F.round(score, 6).alias("similarity"))


# --- Dates -------------------------------------------------------------------------------------------

_PHRASE = """CASE event_id % 12 WHEN 0 THEN CAST(user_id AS STRING) || ' hours ago'
    WHEN 1 THEN CAST(user_id AS STRING) || ' min ago' WHEN 2 THEN 'Yesterday' WHEN 3 THEN ' just now '
    WHEN 4 THEN 'posted ' || CAST(user_id AS STRING) || ' weeks ago' WHEN 5 THEN CAST(user_id AS STRING) || 'd ago'
    WHEN 6 THEN 'today' WHEN 7 THEN CAST(user_id AS STRING) || ' secs ago' WHEN 8 THEN 'invalid-date-string-xyz'
    WHEN 9 THEN 'seen yesterday at noon' WHEN 10 THEN '' END"""
_REF = "TIMESTAMP '2024-01-31 00:00:00'"
_ISO = "'%Y-%m-%dT%H:%M:%SZ'"


@query("relative_strict", f"""SELECT event_id, strftime(CASE event_id % 12
      WHEN 0 THEN {_REF} - to_hours(user_id) WHEN 1 THEN {_REF} - to_minutes(user_id)
      WHEN 2 THEN {_REF} - to_days(1) WHEN 3 THEN {_REF} WHEN 5 THEN {_REF} - to_days(CAST(user_id AS INTEGER))
      WHEN 6 THEN {_REF} END, {_ISO}) AS at FROM events""")
def _(t: Tables):
    rows = t.events.selectExpr("event_id", f"{_PHRASE} AS d")
    return rows.select("event_id", T.iso8601(T.relative_strict(F.col("d"), ref())).alias("at"))


@query("relative_loose", f"""SELECT event_id, strftime(CASE event_id % 12
      WHEN 0 THEN {_REF} - to_hours(user_id) WHEN 1 THEN {_REF} - to_minutes(user_id)
      WHEN 2 THEN {_REF} - to_days(1) WHEN 3 THEN {_REF}
      WHEN 4 THEN {_REF} - to_days(CAST(7 * user_id AS INTEGER)) WHEN 6 THEN {_REF}
      WHEN 7 THEN {_REF} - to_seconds(user_id) WHEN 9 THEN {_REF} - to_days(1) END, {_ISO}) AS at FROM events""")
def _(t: Tables):
    rows = t.events.selectExpr("event_id", f"{_PHRASE} AS d")
    return rows.select("event_id", T.iso8601(T.relative_loose(F.col("d"), ref())).alias("at"))


def written_date():
    """``ts`` written in the ways the sources use, by event."""
    ts = F.col("ts")
    kind = F.col("event_id") % 8
    return (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .when(kind == 2, F.date_format(ts, "'Thu, 'dd MMM yyyy HH:mm:ss '+0000'"))
        .when(kind == 3, F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd HH:mm:ss'-0500'"))
        .when(kind == 4, F.date_format(ts, "MMM d, yyyy"))
        .when(kind == 5, F.date_format(ts, "d MMM yyyy HH:mm:ss 'GMT'"))
        .when(kind == 6, F.lit("no date"))
    )


@query("parse_timestamp", f"""SELECT event_id, CASE WHEN event_id % 8 = 4 THEN strftime(date_trunc('day', ts), {_ISO})
      WHEN event_id % 8 < 6 THEN strftime(ts, {_ISO}) END AS at FROM events""")
def _(t: Tables):
    parsed = T.parse_timestamp(written_date(), ref())
    return t.events.select("event_id", T.iso8601(parsed).alias("at"))


@query("iso8601_utc", f"SELECT event_id, strftime(ts, {_ISO}) AS at FROM events")
def _(t: Tables):
    return t.events.select("event_id", T.iso8601(F.col("ts")).alias("at"))


# One row in four is moved around the reference time, so that every outcome occurs.
SIGNAL_TS = "CASE WHEN id % 4 = 0 THEN ts + INTERVAL '30' HOUR ELSE ts END"
SQL_AGE = "CAST(printf('%.2f', CAST((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(p)) AS DOUBLE) / CAST(3600000000 AS DOUBLE)) AS DOUBLE) + 0.0"
SQL_STATUS = "CASE WHEN age >= -1.0 AND age <= 24.0 THEN 'FRESH' WHEN age < 0.0 THEN 'UNKNOWN' ELSE 'STALE' END"
SQL_GATED = f"""g AS (SELECT *, {SQL_STATUS} AS status, strftime(p, {_ISO}) AS published_at
    FROM (SELECT *, CAST({SQL_AGE} AS DOUBLE) AS age FROM (SELECT *, {SIGNAL_TS} AS p FROM f)))"""


def gated(t: Tables):
    rows = t.frame("signal_rows").withColumn("p", F.expr(SIGNAL_TS))
    return rows.withColumn("gate", T.freshness_of_timestamp(F.col("p"), ref()))


def on_gated(sql: str) -> str:
    return on("signal_rows", f", {SQL_GATED} {sql}")


@query("freshness_gate", on_gated("SELECT id, status, 'METADATA' AS reason, published_at, age AS age_hours FROM g"))
def _(t: Tables):
    return gated(t).select("id", "gate.status", "gate.reason", "gate.published_at", "gate.age_hours")


@query("is_fresh", on_gated("SELECT id, status = 'FRESH' AS fresh, published_at FROM g"))
def _(t: Tables):
    return gated(t).select("id", T.is_fresh(F.col("gate")).alias("x")).select("id", "x.*")


@query("fresh_only", on_gated("""SELECT id, source_url, published_at FROM g WHERE status = 'FRESH'
    AND source_url <> '' AND NOT contains(source_url, 'test_raw_')"""))
def _(t: Tables):
    live = ~C.is_fixture("export", F.col("source_url"))
    kept = gated(t).filter((F.col("gate.status") == "FRESH") & live)
    return kept.select("id", "source_url", "gate.published_at")


# --- URL rules ----------------------------------------------------------------------------------------

_TRACKED = ", ".join(f"'{p}'" for p in TRACKING_PARAMETERS)
SQL_CANONICAL = rf"""'https://' || regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^www\.', '')
    || regexp_replace(regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/index\.html$', '/'), '/+$', '')
    || CASE WHEN len(k) > 0 THEN '?' || array_to_string(k, '&') ELSE '' END"""


@query("canonicalize_url", rf"""SELECT page_id, {SQL_CANONICAL} AS url FROM (
    SELECT page_id, b, list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ({_TRACKED}))) AS k
    FROM (SELECT page_id, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i)https?://', '') AS b FROM pages))""")
def _(t: Tables):
    return t.pages.select("page_id", X.canonicalize_url(F.col("url")).alias("url"))


_PATH = """CASE WHEN page_id % 3 = 0 THEN url || '/2026/09/' || CAST(10 + page_id % 30 AS STRING) || '/x' ELSE url END"""


@query("url_path_date", f"""SELECT page_id, CASE WHEN page_id % 3 = 0 AND 10 + page_id % 30 <= 30
    THEN '2026-09-' || CAST(10 + page_id % 30 AS STRING) END AS day FROM pages""")
def _(t: Tables):
    rows = t.pages.selectExpr("page_id", f"{_PATH} AS u")
    day = X.url_path_date(F.col("u"))
    return rows.select("page_id", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query("valid_url", "SELECT page_id, starts_with(url, 'http') AS valid FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", X.is_web_url(F.col("url")).alias("valid"))


@query("valid_repo_url", on("paper_rows", r"""SELECT id, coalesce(regexp_full_match(trim(github_url),
    'https?://github\.com/[a-zA-Z0-9_\-.]+/[a-zA-Z0-9_\-.]+'), false) AS valid FROM f"""))
def _(t: Tables):
    return t.frame("paper_rows").select("id", X.is_repo_url(F.col("github_url")).alias("valid"))
