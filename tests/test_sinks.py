"""Writes and reads of landing area, feeds, exports and appended rows."""

import pytest
from pyspark.sql import functions as F

from recordmill.functions.times import freshness
from recordmill.operators import sinks as K
from recordmill.operators.upsert import append_new
from recordmill.operators.validate import dead_letters
from recordmill.schemas import RAW_PAYLOAD
from recordmill.sources.tables import raw_scan, read_feed_items, table_read


def payloads(spark):
    rows = [(1, "https://a.org", "A", "<html>é</html>", "text/html", 200), (2, "https://b.org", "B", "<feed/>", "application/atom+XML", 200)]
    stamp = F.lit("2026-09-12T23:30:00Z").cast("timestamp")
    return spark.createDataFrame([(*r, None) for r in rows], RAW_PAYLOAD).withColumn("fetched_at", stamp)


def test_land_and_scan(spark, tmp_path):
    path = str(tmp_path / "landing")
    K.land_raw(payloads(spark), path)
    K.land_raw(payloads(spark), path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 4 and {str(r["fetch_date"]) for r in rows} == {"2026-09-12"}
    assert {r["file_key"][16:] for r in rows} == {".html", ".xml"}
    assert {r["content_length"] for r in rows if r["seq"] == 1} == {15}
    assert raw_scan(spark, path).select("seq", "url").distinct().count() == 2


def test_scan_of_text_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>one\ntwo</p>")
    row = raw_scan(spark, str(tmp_path), "text").first()
    assert row["raw_content"] == "<p>one\ntwo</p>" and row["url"].endswith("a.html")


def test_feed_files(spark, tmp_path):
    (tmp_path / "f.xml").write_text(
        '<rss xmlns:dc="x"><channel><item><title>A &amp; B</title><link>u</link><dc:date>d</dc:date></item><item><title>C</title></item></channel></rss>'
    )
    got = {r["title"]: (r["link"], r["dc:date"]) for r in read_feed_items(spark, str(tmp_path / "f.xml")).collect()}
    assert got == {"A & B": ("u", "d"), "C": (None, None)}


def test_unknown_table(spark):
    with pytest.raises(ValueError, match="no readable table"):
        table_read(spark, "/nowhere", "sqlite_master")


def test_export_keeps_fresh_rows_only(spark, tmp_path):
    ref = F.lit("2026-09-12T12:00:00Z").cast("timestamp")
    rows = [
        (1, "https://j.org/1", "2026-09-12T11:00:00Z"), (2, "https://j.org/2", "2026-09-01T00:00:00Z"),
        (3, "https://j.org/test-job-3", "2026-09-12T11:00:00Z"), (4, "https://j.org/4", ""),
    ]
    jobs = spark.createDataFrame(rows, "id bigint, source_url string, published_date string").select(
        "*", F.lit("1.0").alias("schema_version"), F.lit("S").alias("source_name"), F.lit('Acme, "Inc"\nX').alias("company"),
        F.lit(True).alias("is_remote"), F.lit("Design").alias("role_family"), F.lit("t").alias("collected_at"),
        freshness(F.col("published_date"), ref).alias("gate"),
    )
    K.export_csv({"jobs": jobs}, str(tmp_path))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "jobs"))
    assert back.columns == ["ID", "SchemaVersion", "SourceName", "SourceURL", "Company", "PublishedDate", "IsRemote", "RoleFamily", "CollectedAt"]
    assert [(r["ID"], r["Company"]) for r in back.collect()] == [("1", 'Acme, "Inc"\nX')]


def test_appends_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "dlq")
    rejected = payloads(spark).withColumn("why", F.lit("broken"))
    dead = dead_letters(rejected, F.lit("FETCH_FAILED"), F.lit("AsyncCrawlerLayer"), F.col("why"))
    K.append_rows(dead, path)
    stored = spark.read.parquet(path)
    assert append_new(stored, dead, "dlq_id").count() == 0
    assert {r["preview"] for r in stored.collect()} == {"<html>é</html>", "<feed/>"}


def test_versions_are_not_overwritten(spark, tmp_path):
    path = str(tmp_path / "v1")
    K.write_version(payloads(spark), path)
    with pytest.raises(Exception, match="(?i)exists"):
        K.write_version(payloads(spark), path)


def test_report_file(spark, tmp_path):
    report = spark.createDataFrame([(1, 2)], "a int, b int")
    K.write_report(K.report_document(report, {"x": ["a"], "y": ["b"]}, F.lit("t")), str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).first()[0] == '{"timestamp":"t","x":{"a":1},"y":{"b":2}}'
