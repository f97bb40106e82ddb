"""One query per operator over its whole table, and equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import (
    bpe,
    conversations,
    decontaminate,
    langid,
    mixing,
    packing,
    pii,
    quality,
    secret_scan,
    simhash,
    tokencount,
    warc,
    whitening,
)
from recordmill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Tokens from which a text is over the limit, and the fold that is held out of training.
TOKEN_LIMIT, LM_FOLDS, LANG_FOLDS, HELD_OUT = 4096, 7, 4, 2


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


_WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS_SQL} AS w FROM documents),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY doc_id),
c AS (SELECT l.doc_id, l.t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(lines) AS n_lines FROM l LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * len(list_filter({_WORDS_SQL.replace("coalesce(text, '')", "t")}, lambda x: regexp_matches(x, '\p{{Lu}}.*\p{{Lu}}') AND NOT regexp_matches(x, '\p{{Ll}}'))) > 50 * n_words
            OR 2 * len(regexp_extract_all(t, '\p{{L}}+')) < n_words
            OR 10 * len(regexp_extract_all(t, '(?m)^[\x20\x09]*[-*•]')) > 9 * n_lines
            OR 10 * len(regexp_extract_all(t, '(?m)(\.\.\.|…)[\x20\x09]*$')) > 3 * n_lines) AS kept
FROM b
"""


@query("op1_quality_rules", OP1_SQL)
def op1(spark, folder):
    return quality.quality(table(spark, folder, "documents")).drop("rejected_by")


@query("op2_token_counts")
def op2(spark, folder):
    counts = tokencount.token_counts(table(spark, folder, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op3_context_mixing")
def op3(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = langid.fold(F.col("doc_id"), LM_FOLDS) == HELD_OUT
    scored = mixing.score(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


@query("op4_secret_scan")
def op4(spark, folder):
    return secret_scan.digest(secret_scan.find_secrets(table(spark, folder, "documents")))


@query("op5_simhash")
def op5(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op6_pii")
def op6(spark, folder):
    return pii.digest(pii.find_pii(table(spark, folder, "documents")))


@query("op7_packing")
def op7(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


OP8_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM dw WHERE len(w) > 0)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM iw WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, round(n_shared / n_item, 9) AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= n_item * 0.8 - 1e-9
"""


@query("op8_decontamination", OP8_SQL)
def op8(spark, folder):
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


#: An archive of every page: a full response, a changed full response for some, and two revisits by
#: other spellings of the URL, with validators that agree, differ or are missing.
ARCHIVE = """
SELECT page_id * 4 AS record_id, 'response' AS record_type, url AS target_uri, page_id * 60 AS ts,
       'ETag: W/"' || md5(html) || '"' || chr(10) || 'Content-Type: text/html' || chr(10) || 'Cache-Control: max-age=60'
       || chr(10) || 'Last-Modified: day ' || CAST(page_id % 28 AS STRING) AS http_headers
FROM pages
UNION ALL
SELECT page_id * 4 + 1, 'response', url, page_id * 60 + 172800,
       'ETag: "' || md5(html || '2') || '"' || chr(10) || 'Content-Type: text/html'
FROM pages WHERE page_id % 3 = 0
UNION ALL
SELECT page_id * 4 + 2, 'revisit', CASE WHEN page_id % 2 = 0 THEN url || '#again' ELSE replace(url, 'http://', 'HTTP://') END,
       page_id * 60 + 86400,
       CASE WHEN page_id % 7 = 0 THEN 'ETag: "other"' WHEN page_id % 11 = 0 THEN 'Date: today'
            WHEN page_id % 5 = 0 THEN 'Last-Modified: day ' || CAST(page_id % 28 AS STRING)
            ELSE 'etag: "' || md5(html) || '"' END || chr(10) || 'Cache-Control: no-store' || chr(10) || 'Server: edge'
FROM pages
UNION ALL
SELECT page_id * 4 + 3, 'revisit', CASE WHEN page_id % 13 = 0 THEN 'mailto:x' ELSE url END,
       page_id * 60 + CASE WHEN page_id % 17 = 0 THEN -100 ELSE 259200 END,
       'ETag: "' || md5(html || '2') || '"' || chr(10) || 'Vary: Accept'
FROM pages
"""

OP9_SQL = rf"""
WITH a AS ({ARCHIVE}),
f AS (SELECT *, regexp_extract(trim(target_uri), '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) AS front FROM a),
h AS (SELECT *, regexp_replace(regexp_replace(lower(front), '^[a-z][a-z0-9+.-]*://(www[0-9]*\.)?', ''), ':(80|443)$', '') AS host,
             regexp_replace(substr(trim(target_uri), length(front) + 1), '#.*$', '', 's') AS rest FROM f),
c AS (SELECT record_id, record_type, ts,
             CASE WHEN front <> '' THEN host || CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END END AS canonical,
             list_transform(list_filter(string_split(http_headers, chr(10)), lambda x: strpos(x, ':') > 1),
                            lambda x: {{'name': lower(trim(split_part(x, ':', 1))), 'value': trim(substr(x, strpos(x, ':') + 1))}}) AS own
      FROM h),
j AS (SELECT r.*, p.record_id AS pid, p.own AS stored,
             row_number() OVER (PARTITION BY r.record_id ORDER BY p.ts DESC, p.record_id DESC) AS k
      FROM c r LEFT JOIN c p ON p.record_type = 'response' AND p.canonical = r.canonical
           AND (p.ts < r.ts OR p.ts = r.ts AND p.record_id < r.record_id)
      WHERE r.record_type = 'revisit'),
v AS (SELECT *, regexp_replace(list_filter(own, lambda x: x.name = 'etag')[1].value, '^W/', '') AS e1,
             regexp_replace(list_filter(stored, lambda x: x.name = 'etag')[1].value, '^W/', '') AS e2,
             list_filter(own, lambda x: x.name = 'last-modified')[1].value AS m1,
             list_filter(stored, lambda x: x.name = 'last-modified')[1].value AS m2 FROM j WHERE k = 1),
s AS (SELECT *, CASE WHEN canonical IS NULL THEN 'no_url' WHEN pid IS NULL THEN 'no_response'
                     WHEN e1 IS NOT NULL AND e2 IS NOT NULL THEN CASE WHEN e1 = e2 THEN 'resolved' ELSE 'mismatch' END
                     WHEN m1 IS NOT NULL AND m2 IS NOT NULL THEN CASE WHEN m1 = m2 THEN 'resolved' ELSE 'mismatch' END
                     ELSE 'no_validator' END AS status,
             list_filter(own, lambda x: x.name IN ('cache-control', 'content-location', 'date', 'etag', 'expires', 'last-modified', 'vary')) AS allowed
      FROM v)
SELECT record_id, canonical, ts, pid AS response_id, status,
       array_to_string(list_transform(list_sort(CASE WHEN status = 'resolved' THEN list_concat(
           list_filter(stored, lambda x: NOT list_contains(list_transform(allowed, lambda y: y.name), x.name)), allowed) ELSE own END),
           lambda x: x.name || ': ' || x.value), chr(10)) AS headers
FROM s
"""


@query("op9_warc_revisits", OP9_SQL)
def op9(spark, folder):
    pages = table(spark, folder, "pages")
    archive = spark.sql(ARCHIVE.replace("FROM pages", "FROM {pages}"), pages=pages)
    done = warc.resolve_revisits(archive)
    return done.withColumn("headers", warc.header_block(F.col("headers")))


@query("op10_language_id")
def op10(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = langid.fold(F.col("doc_id"), LANG_FOLDS) == HELD_OUT
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op11_conversations")
def op11(spark, folder):
    repaired = conversations.repair(conversations.damage(table(spark, folder, "conversations")))
    return repaired.withColumnRenamed("conv", "conv_id")


@query("op12_whitening")
def op12(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op13_bpe")
def op13(spark, folder):
    tokens = bpe.decode(bpe.encode(table(spark, folder, "documents")))
    return tokens.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
