"""The checking SQL takes title, text, description and dates from odd pages as the queries do."""

import duckdb
import pytest

from recordmill.catalog import ORACLES, QUERIES

LD = '<script type="application/ld+json">{}</script>'
BODIES = [
    "<html><head><title>Short</title></head><body><article><h1>Two.</h1><p>Few.</p></article><p>Outside of it all</p></body></html>",
    "<html><body><h1>Headed</h1><p>No article, but a paragraph</p></body></html>",
    "<main><p>In the main part of it</p></main><p>This is outside of it</p>",
    "<article><article>Inner</article><p>After the nested one</p></article><p>This is outside</p>",
    "<article><p>The first of the articles</p></article><article><p>The second of the articles</p></article>",
    "<article><p>Never closed at all<div>more of it",
    "<div class='post'><div>Alpha in a division</div><p>Beta is a block</p></div><p>This is outside</p>",
    '<p title="a > b">Quoted sign in a tag</p><p title="unclosed>Loose <b>tags</b> from here</p><p>1 < 2 and <3 hearts <<b>x</b></p>',
    "<pre>No block here</pre>\n\nLines of <br>text &amp; &copy;2024 &ampx;<!-- gone <p>gone paragraph</p> -->",
    "<ARTICLE><P>Upper case tags here<LI>An item of the list<SECTION>A part of the section</SECTION></ARTICLE>",
    "<script>'<!--'</script><p>Between the two scripts</p><script>'-->'</script><p>After the two scripts</p>",
    "<p <div>A broken opening tag</p><div <p>Another broken opening tag</div>",
    "<paragraph>No block of that name</paragraph><pé>Nor of that one at all</pé>",
    '<head><meta property="og:title" content=" Shared &lt;T&gt; "><meta name="description" content=" About it ">'
    '<link rel="canonical" href="https://canon.example.org/x"><title>Own</title></head><p>Text of ten and more</p>',
    "<head><meta property='og:description' content='Shared it'><meta name=pubdate content=\"no date\"><link href='/y' rel=canonical></head>",
    "<head>" + LD.format('[{"dateCreated":"no date","dateModified":5},7,{"a":1}]') + LD.format("{broken") + LD.format('{"datePosted":"none"}') + "</head><title></title><h1> </h1>",
    "", "   ", "plain text without a tag", None,
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    rows = [(i, f"https://h.org/{i // 2}" if i % 7 == 0 else f"https://h.org/p{i}", BODIES[i % len(BODIES)]) for i in range(len(BODIES) * 30)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{path}/pages.parquet")
    return path


@pytest.mark.parametrize("name", ["html_page_extract", "rss_news", "news_sources_all"])
def test_odd_pages(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    df = QUERIES[name](spark, folder)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(want, key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)
