"""Queries over arrivals in order: duplicates, changes, merges, samples, comparisons of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.catalog.base import FRAMES, Tables, on, query
from recordmill.catalog.texts import sql_domain, sql_fingerprint
from recordmill.fixed_values import FIXTURE_KEYWORDS, FORBIDDEN_EXPORT_TERMS, UPSERT_UPDATED
from recordmill.functions.classify import is_fixture
from recordmill.functions.names import normalize_domain
from recordmill.operators import dedup as D
from recordmill.operators import membership
from recordmill.operators import ranking as R
from recordmill.operators import reconcile as Z
from recordmill.operators import upsert as U
from recordmill.operators.bucketed import BucketTable
from recordmill.session import shared_dir

# --- Duplicates and changes ----------------------------------------------------------------------

_SQL_FIRST = f"""h AS (SELECT *, {sql_fingerprint('url')} AS url_hash FROM f),
    d AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY seq) = 1)"""


@query("dedup_by_url", on("pages_replayed", f""", h AS (SELECT *, {sql_fingerprint('url')} AS url_hash FROM f),
    d AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY seq NULLS FIRST, url) = 1) SELECT seq, url, url_hash FROM d"""))
def _(t: Tables):
    return D.dedup_by_url(t.frame("pages_replayed")).select("seq", "url", "url_hash")


@query("domain_counts", on("pages_seen", f", {_SQL_FIRST} SELECT {sql_domain('url')} AS domain, count(*) AS pages FROM d GROUP BY 1"))
def _(t: Tables):
    first = D.dedup_by_url(t.frame("pages_seen"))
    return first.groupBy(normalize_domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("pages"))


@query("dedup_report", on("pages_seen", f", {_SQL_FIRST} SELECT seq, url_hash, seq > min(seq) OVER (PARTITION BY url_hash) AS is_duplicate FROM h"))
def _(t: Tables):
    return D.dedup_report(t.frame("pages_seen")).select("seq", "url_hash", "is_duplicate")


@query("latest_content_hash", on("pages_versions", "SELECT url, arg_max(sha256(raw_content), seq) AS content_hash, max(seq) AS seq FROM f GROUP BY url"))
def _(t: Tables):
    return D.latest_content_hash(D.ledger(t.frame("pages_versions")))


def fetched_again(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The second fetch of every page, and the ledger of the first."""
    rows = t.frame("pages_versions")
    again = rows.filter("version = 2").select(
        "seq", "url", F.sha2("raw_content", 256).alias("content_hash"), (F.col("page_id") % 2 == 0).alias("force_refetch")
    )
    return again, D.ledger(rows.filter("version = 1"))


@query("unchanged_content", on("pages_versions", """SELECT seq, url FROM f WHERE version = 2
    AND EXISTS (SELECT 1 FROM f g WHERE g.version = 1 AND g.url = f.url AND g.raw_content = f.raw_content)"""))
def _(t: Tables):
    again, known = fetched_again(t)
    return D.unchanged_content(again, known).select("seq", "url")


@query("change_cases", on("pages_versions", f"""
    , s AS ({FRAMES['page_states']})
    SELECT f.seq, CASE WHEN state = 'STORED' AND page_id % 2 <> 0 THEN 'SKIP' WHEN state = 'STORED' AND page_id % 5 <> 0 THEN 'UNCHANGED'
      WHEN state = 'STORED' THEN 'REPROCESS' ELSE 'PROCESS' END AS "case" FROM f JOIN s ON source_url = url WHERE version = 2"""))
def _(t: Tables):
    again, known = fetched_again(t)
    return D.change_cases(again, known, t.frame("page_states")).select("seq", "case")


_STORED_URL = "CASE WHEN page_id % 3 = 0 THEN url ELSE url || '#other' END"


@query("skip_known_filtered", "SELECT page_id, url FROM pages WHERE page_id % 3 <> 0")
def _(t: Tables):
    stored, path = t.pages.selectExpr(f"{_STORED_URL} AS url"), shared_dir(t.spark, "url-filter")
    membership.build(stored, ["url"], path)
    return membership.skip_known(t.pages.select("page_id", "url"), stored, ["url"], path)


@query("unchanged_filtered", on("pages_versions", """SELECT seq, url FROM f WHERE version = 2
    AND EXISTS (SELECT 1 FROM f g WHERE g.version = 1 AND g.url = f.url AND g.raw_content = f.raw_content)"""))
def _(t: Tables):
    again, known = fetched_again(t)
    path = shared_dir(t.spark, "content-filter")
    membership.build(known, ["url", "content_hash"], path)
    return membership.only_known(again, known, ["url", "content_hash"], path).select("seq", "url")


@query("skip_known_urls", "SELECT page_id, url FROM pages WHERE page_id % 3 <> 0")
def _(t: Tables):
    return D.skip_known(t.pages.select("page_id", "url"), t.pages.selectExpr(f"{_STORED_URL} AS url")).select("page_id", "url")


_SQL_FOLD = """SELECT source_url, arg_max(state, seq) AS state, count(*) AS attempt_count, CASE arg_max(seq, seq) % 8 WHEN 5 THEN 'timeout' WHEN 6 THEN 'HTTP 404' END AS last_error,
    max(seq) AS updated_seq FROM f GROUP BY source_url"""


@query("checkpoint_fold", on("state_events", _SQL_FOLD))
def _(t: Tables):
    return D.checkpoint_fold(t.frame("state_events"))


@query("completed_urls", on("state_events", f"SELECT source_url FROM ({_SQL_FOLD}) WHERE state = 'STORED'"))
def _(t: Tables):
    return D.completed_urls(D.checkpoint_fold(t.frame("state_events")))


@query("candidate_fresh", f"""SELECT page_id, {sql_fingerprint('url')} AS url_hash FROM pages WHERE page_id % 4 = 0 AND page_id % 3 <> 0""")
def _(t: Tables):
    rows = t.pages.selectExpr("page_id", "url", "CASE WHEN page_id % 4 = 0 THEN '' ELSE '2024-01-01' END AS published")
    seen = t.pages.selectExpr(f"sha2(regexp_replace(lower(trim({_STORED_URL})), '/+$', ''), 256) AS url_hash")
    return D.candidate_fresh(rows, seen).select("page_id", "url_hash")


# --- Merges ---------------------------------------------------------------------------------------


@query("upsert_merge", on("order_updates", """SELECT key, arg_max(status, seq) AS status, arg_max(total, seq) AS total,
    strftime(arg_min(first_date, seq), '%Y-%m-%d') AS first_date, arg_min(priority, seq) AS priority FROM f GROUP BY key"""))
def _(t: Tables):
    merged = U.merge_by_key(t.frame("order_updates"), "key", "seq", ["status", "total"])
    return merged.select("key", "status", "total", F.date_format("first_date", "yyyy-MM-dd").alias("first_date"), "priority")


def job_table(t: Tables) -> DataFrame:
    return t.frame("job_rows").select(
        "source_url", "seq", F.lit("1.0").alias("schema_version"), "source_name", "company", "published_date",
        "is_remote", F.col("job_title").alias("role_family"), F.lit("{}").alias("data_json"), F.lit("t0").alias("collected_at"),
    )


def job_arrivals(t: Tables) -> DataFrame:
    """The job rows again, changed, a third of them under new URLs."""
    return job_table(t).withColumns({
        "source_url": F.when(F.col("seq") % 3 == 0, F.concat("source_url", F.lit("#new"))).otherwise(F.col("source_url")),
        "source_name": F.lit("again"), "company": F.concat("company", F.lit(" v2")), "is_remote": ~F.col("is_remote"),
        "role_family": F.lit("Other"), "collected_at": F.lit("t1"),
    })


_SQL_UPSERTED = on("job_rows", """
    , both_sides AS (SELECT source_url, seq AS ord, source_name, company, is_remote, job_title AS role_family, 't0' AS collected_at, 0 AS late FROM f
      UNION ALL SELECT CASE WHEN seq % 3 = 0 THEN source_url || '#new' ELSE source_url END, seq, 'again', company || ' v2', NOT is_remote, 'Other', 't1', 1 FROM f)
    SELECT source_url, arg_max(company, late * 1000000000000 + ord) AS company, arg_min(source_name, late * 1000000000000 + ord) AS source_name,
      arg_min(is_remote, late * 1000000000000 + ord) AS is_remote, arg_min(role_family, late * 1000000000000 + ord) AS role_family,
      arg_max(collected_at, late * 1000000000000 + ord) AS collected_at FROM both_sides GROUP BY source_url""")


@query("upsert_records", _SQL_UPSERTED)
def _(t: Tables):
    stored = U.merge_by_key(job_table(t), "source_url", "seq", UPSERT_UPDATED["jobs"])
    merged = U.upsert_records("jobs", stored, job_arrivals(t))
    return merged.select("source_url", "company", "source_name", "is_remote", "role_family", "collected_at")


@query("upsert_bucketed", _SQL_UPSERTED)
def _(t: Tables):
    table = BucketTable(t.spark, shared_dir(t.spark, "job-buckets"), "source_url", 16)
    for rows in (job_table(t), job_arrivals(t)):
        table.merge(rows, "seq", UPSERT_UPDATED["jobs"])
    return table.read().select("source_url", "company", "source_name", "is_remote", "role_family", "collected_at")


def customer_master(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("seq"), F.concat(F.lit("cent_"), key.cast("string")).alias("canonical_entity_id"),
        F.lit("STARTUP").alias("entity_type"), F.col("c_name").alias("canonical_name"),
        F.when(key % 50 == 1, F.lit("shared name")).otherwise(F.lower("c_name")).alias("normalized_name"),
        F.array("c_mktsegment").alias("aliases"), F.array("c_name").alias("domains"),
        F.create_map(F.lit("k"), key.cast("string")).alias("external_ids"), F.array("c_name").alias("source_urls"),
        F.timestamp_seconds(key).alias("created_at"), F.timestamp_seconds(key).alias("updated_at"),
    )


def master_arrivals(t: Tables) -> DataFrame:
    renamed = F.concat("canonical_name", F.lit(" Group"))
    return customer_master(t).withColumns({
        "canonical_entity_id": F.when(F.col("seq") % 2 == 1, F.concat(F.lit("new_"), F.col("seq").cast("string"))).otherwise(F.col("canonical_entity_id")),
        "canonical_name": renamed, "normalized_name": F.lower(renamed), "created_at": F.timestamp_seconds(F.lit(0)),
        "updated_at": F.timestamp_seconds(F.lit(5_000_000_000)), "entity_type": F.lit("COMPANY"), "seq": F.col("seq") + 1_000_000_000,
    })


@query("upsert_entities", """SELECT 'cent_' || CAST(c_custkey AS STRING) AS canonical_entity_id, 'STARTUP' AS entity_type, c_name || CASE WHEN c_custkey % 2 = 0 THEN ' Group' ELSE '' END AS canonical_name, c_custkey AS created FROM customer
    UNION ALL SELECT 'new_' || CAST(c_custkey AS STRING), 'COMPANY', c_name || ' Group', 0 FROM customer WHERE c_custkey % 2 = 1""")
def _(t: Tables):
    merged = U.upsert_entities(customer_master(t), master_arrivals(t))
    return merged.select("canonical_entity_id", "entity_type", "canonical_name", F.unix_seconds("created_at").alias("created"))


@query("upsert_entity", """WITH a AS (SELECT c_custkey AS k, lower(c_name) AS n, CASE c_custkey % 4 WHEN 3 THEN 'trio ' || CAST(c_custkey // 8 AS STRING) WHEN 1 THEN lower(c_name) ELSE lower(c_name) || ' group' END AS name FROM customer),
    w AS (SELECT *, min(k) OVER (PARTITION BY name) AS first FROM a WHERE k % 4 <> 1)
    SELECT 'refused' AS side, 'new_' || CAST(k AS STRING) AS canonical_entity_id, n AS normalized_name, 'cent_' || CAST(k AS STRING) AS held_by FROM a WHERE k % 4 = 1
    UNION ALL SELECT 'refused', 'new_' || CAST(k AS STRING), name, 'new_' || CAST(first AS STRING) FROM w WHERE k <> first
    UNION ALL SELECT 'master', 'new_' || CAST(k AS STRING), name, NULL FROM w WHERE k = first AND k % 4 <> 0
    UNION ALL SELECT 'master', 'cent_' || CAST(k AS STRING), CASE WHEN k % 4 = 0 THEN name ELSE n END, NULL FROM a""")
def _(t: Tables):
    # Renames, names that stored entities hold, new names, and new names that two arrivals claim.
    k = F.col("seq")
    stored = customer_master(t).withColumn("normalized_name", F.lower("canonical_name"))
    arrivals = stored.withColumns({
        "canonical_entity_id": F.when(k % 4 == 0, F.col("canonical_entity_id")).otherwise(F.concat(F.lit("new_"), k.cast("string"))),
        "normalized_name": F.when(k % 4 == 3, F.concat(F.lit("trio "), F.floor(k / 8).cast("string"))).when(
            k % 4 == 1, F.col("normalized_name")).otherwise(F.concat("normalized_name", F.lit(" group"))),
    })
    merged, refused = U.upsert_entity(stored, arrivals)
    columns = ["canonical_entity_id", "normalized_name"]
    return merged.select(F.lit("master").alias("side"), *columns, F.lit(None).cast("string").alias("held_by")).unionByName(
        refused.select(F.lit("refused").alias("side"), *columns, "held_by"))


@query("append_mappings", """SELECT 'map_' || CAST(o_custkey AS STRING) AS mapping_id, min(o_orderkey) AS seq FROM orders
    WHERE 'map_' || CAST(o_custkey AS STRING) NOT IN (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'map_' ELSE 'old_' END || CAST(c_custkey AS STRING) FROM customer) GROUP BY 1""")
def _(t: Tables):
    stored = t.customer.selectExpr("CASE WHEN c_custkey % 2 = 0 THEN 'map_' ELSE 'old_' END || CAST(c_custkey AS STRING) AS mapping_id")
    arrivals = t.orders.selectExpr("'map_' || CAST(o_custkey AS STRING) AS mapping_id", "o_orderkey AS seq")
    return U.append_new(stored, arrivals, "mapping_id")


@query("prune_to_allowlist", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 2)")
def _(t: Tables):
    accepted = t.nation.filter("n_regionkey <= 2").select(F.col("n_nationkey").alias("c_nationkey"))
    return U.prune_to_allowlist(t.customer, accepted, "c_nationkey").select("c_custkey", "c_name")


# --- Latest, samples ---------------------------------------------------------------------------------


@query("latest_per_key", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def _(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return D.pick_by(rows, ["o_custkey"], "o_orderkey", newest=True)


@query("systematic_sample", """SELECT c_mktsegment, c_custkey, pos AS position FROM (
      SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey * 7919 % 1000003 * 1000003 + c_custkey) AS pos,
        greatest(1, count(*) OVER (PARTITION BY c_mktsegment) // 50) AS step FROM customer)
    WHERE (pos - 1) % step = 0 AND (pos - 1) // step < 50""")
def _(t: Tables):
    # The order is that of a hash, so numbers are sparse. Many ranges exercise the offsets on small tables too.
    rows = t.customer.select("c_mktsegment", "c_custkey", (F.col("c_custkey") * 7919 % 1000003 * 1000003 + F.col("c_custkey")).alias("h"))
    return R.systematic_sample(rows, ["c_mktsegment"], "h", size=50, parts=16).drop("h")


@query("sample_head", "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t: Tables):
    return R.sample_head(t.orders.select("o_orderkey", "o_orderpriority"), [F.asc("o_orderkey")], 5)


# --- Comparing tables -----------------------------------------------------------------------------------

_EXPORTED = "CASE WHEN o_orderstatus = 'P' THEN -o_orderkey - 1 ELSE o_orderkey END"


@query("ids_missing_from_export", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def _(t: Tables):
    export = t.orders.selectExpr(f"{_EXPORTED} AS o_orderkey")
    return Z.ids_missing_from_export(t.orders, export, "o_orderkey")


@query("fixtures_in_export", "SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '5-LOW'")
def _(t: Tables):
    export = t.orders.selectExpr(f"{_EXPORTED} AS o_orderkey")
    return Z.fixtures_in_export(t.orders.filter("o_orderpriority = '5-LOW'"), export, "o_orderkey")


FRAMES["marked_pages"] = """
    SELECT page_id, html, CASE page_id % 9 WHEN 0 THEN '' WHEN 1 THEN url || '?test_id=5' WHEN 2 THEN url || '/TEST_RAW_' WHEN 3 THEN url || '/paper/98456' ELSE url END AS url,
      CASE WHEN page_id % 10 = 4 THEN 'sample_job_' || CAST(page_id AS STRING) ELSE 'Name' END AS name FROM pages"""


def sql_fixture(table: str, url: str, name: str | None = None) -> str:
    words = FIXTURE_KEYWORDS[table]
    target = f"lower({url})" if table == "news" else url
    hits = [f"contains({target}, '{w}')" for w in words]
    if name:
        hits += [f"contains({name}, '{w}')" for w in words]
    return f"(coalesce({url}, '') = '' OR {' OR '.join(hits)})"


@query("exclude_fixtures", on("marked_pages", f"""
    SELECT 'papers' AS rule, page_id FROM f WHERE NOT {sql_fixture('papers', 'url')} UNION ALL SELECT 'products', page_id FROM f WHERE NOT {sql_fixture('products', 'url', 'name')}
    UNION ALL SELECT 'startups', page_id FROM f WHERE NOT {sql_fixture('startups', 'url', 'name')} UNION ALL SELECT 'jobs', page_id FROM f WHERE NOT {sql_fixture('jobs', 'url', 'name')}
    UNION ALL SELECT 'news', page_id FROM f WHERE NOT {sql_fixture('news', 'url')} UNION ALL SELECT 'export', page_id FROM f WHERE NOT {sql_fixture('export', 'url')}"""))
def _(t: Tables):
    named = {"products", "startups", "jobs"}
    rules = ("papers", "products", "startups", "jobs", "news", "export")
    rows = t.frame("marked_pages")
    kept = F.array_compact(F.array(*[
        F.when(~is_fixture(r, F.col("url"), F.col("name") if r in named else None), F.lit(r)) for r in rules
    ]))
    return rows.select(F.explode(kept).alias("rule"), "page_id")


@query("reconcile_counts", on("marked_pages", f"""SELECT count(*) AS table_rows, count(*) FILTER (NOT {sql_fixture('export', 'url')}) AS production_rows,
    count(*) FILTER ({sql_fixture('export', 'url')}) AS fixture_rows, count(*) FILTER (NOT {sql_fixture('export', 'url')}) AS export_rows, true AS reconciled FROM f"""))
def _(t: Tables):
    rows = t.frame("marked_pages")
    return Z.reconcile_counts(rows, Z.without_fixtures(rows, "export", "url"), is_fixture("export", F.col("url")))


@query("forbidden_terms", on("marked_pages", "SELECT page_id, term FROM f, (VALUES " + ", ".join(f"('{x}')" for x in FORBIDDEN_EXPORT_TERMS) + ") v(term) WHERE contains(url || name || html, term)"))
def _(t: Tables):
    return Z.forbidden_terms(t.frame("marked_pages"), "page_id")
