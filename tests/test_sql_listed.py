"""Pages that share an address: the last feed item of the address counts for all of them."""

import duckdb
import pytest

from recordmill.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["metadata_attach", "rss_news", "news_sources_all"])
def test_pages_of_one_address(spark, tmp_path, name):
    body = "<html><head><title>T</title></head><body><article><p>Something happened</p></article></body></html>"
    rows = [(i, f"https://h.org/{i // 4}", body) for i in range(24)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(want, key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)
