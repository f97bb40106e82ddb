"""Pages made of short rows are dealt to many tasks, however few blocks the rows lie in."""

from recordmill.catalog.base import Tables
from recordmill.catalog.pages import paper_page_payloads


def test_short_rows_are_dealt_out(spark, tmp_path):
    rows = spark.range(50).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    made = paper_page_payloads(Tables(spark, str(tmp_path)))
    assert made.count() == 50 and made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
