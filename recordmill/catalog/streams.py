"""Streaming jobs run to the end of the given tables, compared with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.catalog.audits import SQL_COUNTERS
from recordmill.catalog.base import FRAMES, Tables, on, query, ref
from recordmill.catalog.records import PAYLOADS, sql_errors
from recordmill.catalog.texts import SQL_AGE, SQL_STATUS, sql_fingerprint
from recordmill.session import shared_dir
from recordmill.streaming import jobs as S


def stream_of(t: Tables, table: str, frame: str | None = None) -> DataFrame:
    """A table, one file or a folder of files, read as a stream, optionally through a derived frame over
    that table alone. A stream takes a single file only by a pattern."""
    schema = getattr(t, table).schema
    source = t.spark.readStream.schema(schema).parquet(f"{t.folder}/{table}.parque[t]")
    if frame is None:
        return source
    source.createOrReplaceTempView(f"stream_{table}")
    return t.spark.sql(FRAMES[frame].replace(f"FROM {table}", f"FROM stream_{table}"))


def _paths(t: Tables, name: str, count: int = 2) -> list[str]:
    root = shared_dir(t.spark, name)
    return [f"{root}/{part}" for part in ("checkpoint", "out", "more")[:count]]


def _read(t: Tables, path: str) -> DataFrame:
    return t.spark.read.option("basePath", path).parquet(path)


@query("stream_land", """SELECT page_id AS seq, url, sha256(html) AS content_hash, '2024-01-30' AS fetch_date, substr(sha256(html), 1, 16) || '.html' AS file_key FROM pages""")
def _(t: Tables):
    checkpoint, out = _paths(t, "land")
    rows = stream_of(t, "pages").select(
        F.col("page_id").alias("seq"), "url", F.lit("pages").alias("source_name"), F.col("html").alias("raw_content"),
        F.lit("text/html").alias("content_type"), F.lit(200).alias("http_status"), F.lit("2024-01-30T12:00:00Z").cast("timestamp").alias("fetched_at"),
    )
    S.stream_land(rows, out, checkpoint).awaitTermination()
    return t.spark.read.parquet(out).select("seq", "url", "content_hash", F.col("fetch_date").cast("string").alias("fetch_date"), "file_key")


# Every page is claimed again an hour later, within the time to live, and 30 hours later, beyond it.
FRAMES["claims"] = """
    SELECT page_id * 3 AS seq, url, page_id AS hour FROM pages
    UNION ALL SELECT page_id * 3 + 1, upper(url) || '/', page_id + 1 FROM pages
    UNION ALL SELECT page_id * 3 + 2, url, page_id + 30 FROM pages"""


@query("stream_dedup_ttl", f"SELECT {sql_fingerprint('url')} AS url_hash, page_id * 3 + k AS seq FROM pages, (VALUES (0), (2)) v(k)")
def _(t: Tables):
    checkpoint, out = _paths(t, "dedup")
    hours = F.timestamp_seconds(F.lit(1704067200) + F.col("hour") * 3600)
    rows = stream_of(t, "pages", "claims").withColumn("ts", hours)
    S.stream_dedup_ttl(rows, out, checkpoint).awaitTermination()
    return _read(t, out).select("url_hash", "seq")


@query("stream_fresh_gate", f"""SELECT event_id, {SQL_STATUS} AS status, age AS age_hours FROM (SELECT event_id, CAST({SQL_AGE} AS DOUBLE) AS age FROM (SELECT event_id, date_trunc('second', ts) AS p FROM events))""")
def _(t: Tables):
    checkpoint, out = _paths(t, "gate")
    rows = stream_of(t, "events").withColumn("published", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    S.stream_fresh_gate(rows, out, checkpoint, lambda batch_id: ref()).awaitTermination()
    return _read(t, out).select("event_id", "gate.status", "gate.age_hours")


@query("stream_checkpoint_state", on("state_events", """SELECT source_url, arg_max(state, seq) AS state, count(*) AS attempt_count,
    CASE max(seq) % 8 WHEN 5 THEN 'timeout' WHEN 6 THEN 'HTTP 404' END AS last_error, max(seq) AS updated_seq FROM f GROUP BY source_url"""))
def _(t: Tables):
    checkpoint, out = _paths(t, "states")
    S.stream_checkpoint_state(stream_of(t, "events", "state_events"), out, checkpoint).awaitTermination()
    return S.checkpoint_states(t.spark, out)


@query("stream_upsert", on("order_updates", """SELECT key, arg_max(status, seq) AS status, arg_max(total, seq) AS total, arg_min(priority, seq) AS priority FROM f GROUP BY key"""))
def _(t: Tables):
    checkpoint, out = _paths(t, "upsert")
    S.stream_upsert(stream_of(t, "orders", "order_updates"), out, checkpoint, "key", "seq", ["status", "total"]).awaitTermination()
    return S.upserted(t.spark, out, "key", "seq", ["status", "total"]).select("key", "status", "total", "priority")


@query("stream_dlq_split", f"""SELECT seq, CASE WHEN errors = '' THEN 'record' ELSE 'dead' END AS side, nullif(errors, '') AS message
    FROM (SELECT seq, {sql_errors('JOB')} AS errors FROM ({PAYLOADS['JOB']}))""")
def _(t: Tables):
    checkpoint, good, bad = _paths(t, "split", 3)
    rows = stream_of(t, "events", "payload_job").select(
        "seq", "payload", F.lit("JOB").alias("record_type"), F.concat(F.lit("https://j.example.org/"), F.col("seq").cast("string")).alias("url"),
        F.col("payload").alias("raw_content"),
    )
    S.stream_dlq_split(rows, good, bad, checkpoint).awaitTermination()
    kept = _read(t, good).select("seq", F.lit("record").alias("side"), F.lit(None).cast("string").alias("message"))
    return kept.unionByName(_read(t, bad).select("seq", F.lit("dead").alias("side"), F.col("error_message").alias("message")))


@query("stream_source_metrics", on("crawl_log", f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS window_start, lower(source_name) AS source_name, {SQL_COUNTERS} FROM f GROUP BY 1, 2"""))
def _(t: Tables):
    checkpoint, out = _paths(t, "metrics")
    rows = stream_of(t, "events", "crawl_log").withColumn("ts", F.col("ts").cast("timestamp"))
    S.stream_source_metrics(rows, out, checkpoint).awaitTermination()
    rows = S.latest_updates(t.spark, out, ["window_start", "source_name"])
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
