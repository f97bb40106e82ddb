"""The checking SQL reads character references as the standard decoder does, which the queries use."""

import html

import duckdb

from recordmill.catalog import ORACLES, QUERIES
from recordmill.catalog.texts import sql_decode


def test_sql_decodes_as_html():
    texts = ["cut&&amp", "&amp;lt;", "&ampx;", "&notit; &notin; &notx", "&#x27;&#39 &#0;&#128;&#xD800;&#x110000;&#1;", "&copy2024 &#; &;", "none"]
    con = duckdb.connect()
    for t in texts:
        assert con.execute(f"SELECT {sql_decode('t')} FROM (SELECT $1 AS t)", [t]).fetchone()[0] == html.unescape(t)


def test_cut_references_in_pages(spark, tmp_path):
    body = "<html><head><title>Cut&amp</title></head><body><article><p>Something is cut&amp</p></article></body></html>"
    spark.createDataFrame([(4, "https://h.org/", body)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("clean_html_text", "prepare_payload", "html_page_extract"):
        df = QUERIES[name](spark, str(tmp_path))
        assert con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall() == [tuple(r) for r in df.collect()]
