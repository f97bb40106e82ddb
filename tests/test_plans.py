"""The whole batch run, and streaming jobs under replay."""

import json
import os

from pyspark.sql import functions as F

from recordmill.operators.dedup import checkpoint_fold
from recordmill.streaming.levels import Log
from recordmill.operators.resolve import seed_master
from recordmill.plans.batch import run_batch
from recordmill.schemas import RAW_PAYLOAD
from recordmill.session import intermediates, shared_dir
from recordmill.sources.registry import default_registry
from recordmill.streaming import jobs as S


def test_run_batch(spark):
    job = {"position": "ML Engineer", "company": "OpenAI Inc.", "date": "2024-01-30T12:00:00Z", "description": "d"}
    rows = [
        (1, "https://jobs.org/1", "RemoteOKAI", json.dumps(job), "application/json", 200),
        (2, "HTTPS://jobs.org/1/", "RemoteOKAI", json.dumps(job), "application/json", 200),
        (3, "https://jobs.org/3", "remoteokai", json.dumps({**job, "date": "2024-01-01"}), "application/json", 200),
        (4, "https://jobs.org/4", "RemoteOKAI", "Just a moment...", "text/html", 403),
        (5, "https://github.com/acme", "GitHub Organizations", json.dumps({"name": "Acme Inc.", "blog": "acme.io"}), "application/json", 200),
        (6, "https://nowhere.org/6", "Unregistered", "x", "text/html", 200),
        (7, "https://arxiv.org/abs/2401.00001", "ArXiv", "<html><body>no date</body></html>", "text/html", 200),
        (8, "https://jobs.org/seen", "RemoteOKAI", json.dumps(job), "application/json", 200),
    ]
    stamp = "2024-01-31T00:00:00Z"
    payloads = spark.createDataFrame([(*r, None) for r in rows], RAW_PAYLOAD)
    store = spark.range(1).select(F.sha2(F.lit("https://jobs.org/seen"), 256).alias("url_hash"))
    ref = F.lit(stamp).cast("timestamp")
    result = run_batch(payloads, default_registry(), seed_master(spark), store, ref, F.lit(stamp))
    statuses = {r["seq"]: r["status"] for r in result.statuses.collect()}
    assert statuses == {
        1: "NEW_RECORD_STORED", 2: "DUPLICATE_ALREADY_PROCESSED", 3: "FRESHNESS_REJECTED", 4: "FETCH_FAILED",
        5: "NEW_RECORD_STORED", 6: "EXTRACTION_FAILED", 7: "VALIDATION_FAILED", 8: "DUPLICATE_ALREADY_PROCESSED",
    }
    names = {r["seq"]: r["entity_name"] for r in result.records.collect()}
    assert names == {1: "OpenAI", 5: "Acme"}
    assert {r["source_url"] for r in result.dead.collect()} == {
        "https://jobs.org/4", "https://nowhere.org/6", "https://arxiv.org/abs/2401.00001",
    }
    assert result.mappings.count() == 2


def test_claims_only_after_passing(spark):
    """A failed, a stale and an unproved payload leave their URL to a later good one."""
    job = {"position": "ML Engineer", "company": "OpenAI", "date": "2024-01-30T12:00:00Z", "description": "d"}
    org = {"name": "Acme", "blog": "", "description": "", "company": ""}
    rows = [
        (1, "https://jobs.org/1", "RemoteOKAI", "denied", 403), (2, "https://jobs.org/1", "RemoteOKAI", json.dumps(job), 200),
        (3, "https://jobs.org/1/", "aijobsnet", json.dumps(job), 200),
        (4, "https://jobs.org/4", "Jobicy", json.dumps({"jobTitle": "x"}), 200),
        (5, "https://jobs.org/4", "Jobicy", json.dumps({"jobTitle": "x", "companyName": "C", "pubDate": "2024-01-30"}), 200),
        (6, "https://github.com/acme", "githuborgs", json.dumps(org), 200),
        (7, "https://github.com/acme", "githuborgs", json.dumps({**org, "name": "Acme Inc."}), 200),
        (8, "https://arxiv.org/abs/2401.00001", "paperswithcode", '<meta name="citation_title" content="T"><meta name="citation_date" '
            'content="2024/01/02"><a href="https://github.com/a/b">x</a>', 200),
    ]
    payloads = spark.createDataFrame([(a, b, c, d, "x", e, None) for a, b, c, d, e in rows], RAW_PAYLOAD)
    snapshot = spark.createDataFrame([(1, "https://github.com/a/b", 200, 42)], "seq bigint, github_url string, http_status int, stars bigint")
    stamp = "2024-01-31T00:00:00Z"

    def run(stored=None):
        return run_batch(payloads, default_registry(), seed_master(spark), None, F.lit(stamp).cast("timestamp"), F.lit(stamp), snapshot, stored)

    folder = shared_dir(spark, "probe").rpartition("/")[0]
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with intermediates(spark):
        result = run()
        assert {r["seq"]: r["status"] for r in result.statuses.collect()} == {
            1: "FETCH_FAILED", 2: "NEW_RECORD_STORED", 3: "DUPLICATE_ALREADY_PROCESSED", 4: "FRESHNESS_REJECTED", 5: "NEW_RECORD_STORED",
            6: "EVIDENCE_REJECTED", 7: "NEW_RECORD_STORED", 8: "NEW_RECORD_STORED"}
        tables = {name: df.collect() for name, df in result.tables.items()}
        assert {name: [r["seq"] for r in sorted(found)] for name, found in tables.items()} == {
            "startups": [7], "products": [], "research_papers": [8], "jobs": [2, 5], "news": []}
        paper = tables["research_papers"][0]
        assert (paper["arxiv_id"], paper["github_stars"], paper["enrichment_status"]) == ("2401.00001", 42, "COMPLETED")
        again = run({"jobs": spark.createDataFrame(tables["jobs"], result.tables["jobs"].schema)})
        assert sorted(r["source_url"] for r in again.tables["jobs"].collect()) == ["https://jobs.org/1", "https://jobs.org/4"]
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_upsert_stream_survives_replay(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    rows = [(f"k{i % 5}", i, f"v{i}", f"w{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "key string, seq bigint, a string, b string")
    df.filter("seq < 20").coalesce(1).write.parquet(source)

    def run(cp):
        stream = spark.readStream.schema(df.schema).parquet(source)
        S.stream_upsert(stream, out, cp, "key", "seq", ["a"]).awaitTermination()

    run(checkpoint)
    df.filter("seq >= 20").coalesce(1).write.mode("append").parquet(source)
    run(checkpoint)
    first = S.upserted(spark, out, "key", "seq", ["a"]).orderBy("key").collect()
    assert [(r["key"], r["seq"], r["a"], r["b"]) for r in first] == [(f"k{i}", 35 + i, f"v{35 + i}", f"w{i}") for i in range(5)]
    # All input arrives again as one batch under an id already committed: nothing changes.
    run(str(tmp_path / "cp2"))
    assert S.upserted(spark, out, "key", "seq", ["a"]).orderBy("key").collect() == first


def test_levels_keep_files_per_key_bounded(spark, tmp_path):
    path = str(tmp_path / "log")
    log = Log(spark, path, lambda d: d.groupBy("k").agg(F.sum("n").alias("n")), fanout=3)
    kind = "k int, n long"
    for batch in range(40):
        log.append(spark.createDataFrame([(1, 1), (batch % 4, 10)], kind).coalesce(1), batch)
        if batch % 7 == 3:  # a replayed batch changes nothing, whatever it brings
            log.append(spark.createDataFrame([(1, 1000)], kind), batch)
    runs = log.manifest()["runs"]
    assert len(runs) <= 2 * 4 and sum(r["last"] - r["first"] + 1 for r in runs) == 40
    assert dict(map(tuple, log.read().collect())) == {0: 100, 1: 140, 2: 100, 3: 100}
    assert len(os.listdir(f"{path}/runs")) <= 2 * 4 + 3 * 4 and len(log._manifests()) == 2
    # An attempt that died before its commit leaves a run that the next one replaces.
    spark.createDataFrame([(1, 5)], kind).write.parquet(f"{path}/runs/level-0-40-40")
    before = dict(map(tuple, log.read().collect()))
    log.append(spark.createDataFrame([(1, 7)], kind), 40)
    assert dict(map(tuple, log.read().collect())) == before | {1: 147}


def test_checkpoint_stream_over_batches(spark, tmp_path):
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    events = [(f"u{i % 3}", i, "STORED" if i % 4 else "FAILED", None if i % 4 else f"e{i}") for i in range(30)]
    df = spark.createDataFrame(events, "source_url string, seq bigint, state string, error string")
    for part in (df.filter("seq < 17"), df.filter("seq >= 17")):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        S.stream_checkpoint_state(stream, out, cp).awaitTermination()
    got = sorted(map(tuple, S.checkpoint_states(spark, out).collect()))
    assert got == sorted(map(tuple, checkpoint_fold(df).collect()))


def test_ttl_expires(spark, tmp_path):
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = "seq bigint, url string, ts timestamp"
    hour = lambda h: F.timestamp_seconds(F.lit(1_700_000_000 + h * 3600))
    arrivals = [(0, "https://a.org"), (5, "https://A.org/"), (100, "https://b.org"), (101, "https://a.org"), (102, "https://a.org")]
    for n, (h, url) in enumerate(arrivals):
        spark.range(1).select(F.lit(n).cast("bigint").alias("seq"), F.lit(url).alias("url"), hour(h).alias("ts")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        S.stream_dedup_ttl(stream, out, cp).awaitTermination()
    got = spark.read.option("basePath", out).parquet(out)
    assert sorted(r["seq"] for r in got.collect()) == [0, 2, 3]


def test_lowest_place_wins_inside_a_batch(spark, tmp_path):
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    rows = spark.range(9).select((8 - F.col("id")).alias("seq"), F.lit("https://a.org").alias("url"), F.timestamp_seconds(1_700_000_000 + (8 - F.col("id")) * 36000).alias("ts"))
    rows.repartition(3).write.parquet(source)
    S.stream_dedup_ttl(spark.readStream.schema(rows.schema).parquet(source), out, cp).awaitTermination()
    got = spark.read.option("basePath", out).parquet(out)
    assert sorted(r["seq"] for r in got.collect()) == [0, 3, 6]


def test_ttl_in_a_session_with_another_state_store(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        test_lowest_place_wins_inside_a_batch(spark, tmp_path)
        assert "HDFSBacked" in spark.conf.get(name)
    finally:
        spark.conf.set(name, before)


def test_tables_of_several_files_as_streams(spark, tmp_path):
    from recordmill.catalog import QUERIES

    pages = spark.range(12).selectExpr("id AS page_id", "'https://h.org/' || id AS url", "'<p>' || id AS html")
    pages.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["stream_land"](spark, str(tmp_path)).count() == 12
    assert QUERIES["stream_dedup_ttl"](spark, str(tmp_path)).count() == 24
