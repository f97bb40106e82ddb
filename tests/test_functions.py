"""Text, date and name expressions on written examples."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from recordmill.functions import html as H
from recordmill.functions import names as N
from recordmill.functions import text as X
from recordmill.functions import times as T

REF = datetime(2026, 9, 12, 12, 0, tzinfo=timezone.utc)


def one(spark, expression, *values, schema=None):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], schema or ", ".join(f"{n} string" for n in names))
    return df.select(expression(*[F.col(n) for n in df.columns]).alias("x")).first()[0]


def at(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize("value, expected", [
    ("  Hello   World \n\t ", "Hello World"), (None, ""), ("a b", "a b"), ("x\u0085y", "x y"),
])
def test_whitespace(spark, value, expected):
    assert one(spark, X.normalize_whitespace, value) == expected


def test_title(spark):
    assert one(spark, X.normalize_title, "  Attention Is   All You Need. ") == "attention is all you need"


@pytest.mark.parametrize("value, expected", [
    ("https://arxiv.org/abs/2301.12345v2", "2301.12345"), ("cs/0112017", "cs/0112017"),
    ("invalid-string", None), (None, None),
])
def test_arxiv_id(spark, value, expected):
    assert one(spark, X.arxiv_id, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("https://github.com/google-research/bert.git/", "https://github.com/google-research/bert"),
    ("https://github.com/sponsors/user", None), ("https://github.com/a/digit", "https://github.com/a/digit"),
    ("see http://github.com/o/r for code", "https://github.com/o/r"), (None, None),
])
def test_github_url(spark, value, expected):
    assert one(spark, X.github_url, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("2026-09-10T12:00:00+00:00", "2026-09-10T12:00:00Z"), ("2026-09-10T12:00:00+05:00", "2026-09-10T12:00:00Z"),
    ("soon", "soon"), ("", None),
])
def test_iso_date(spark, value, expected):
    assert one(spark, T.iso_date, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("OpenAI, Inc.", "openai"), ("Hugging Face Co.", "hugging face"), ("AT&T", "atandt"),
    ("A & B", "a b"), ("Ｏｐｅｎ Ａｉ", "open ai"), ("Économie SA", "économie sa"), ("Incubator Inc", "incubator"),
])
def test_entity_name(spark, value, expected):
    assert one(spark, N.normalize_entity, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("https://www.openai.com/about?src=1", "openai.com"), ("OpenAI.com:8080", "openai.com"), ("", ""),
])
def test_domain(spark, value, expected):
    assert one(spark, N.normalize_domain, value) == expected


@pytest.mark.parametrize("a, b, expected", [
    ("martha", "marhta", 0.9611), ("dixon", "dicksonx", 0.8133), ("openai", "openaii", 0.9714),
    ("", "x", 0.0), ("same", "same", 1.0), ("abc", "xyz", 0.0), ("dwayne", "duane", 0.84),
])
def test_jaro_winkler(spark, a, b, expected):
    assert one(spark, N.jaro_winkler, a, b) == pytest.approx(expected, abs=1e-4)


def iso(moment):
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.mark.parametrize("value, status, age", [
    (iso(REF - timedelta(hours=1)), "FRESH", 1.0),
    (iso(REF - timedelta(hours=23, minutes=59)), "FRESH", 23.98),
    (iso(REF - timedelta(hours=24)), "FRESH", 24.0),
    (iso(REF - timedelta(hours=24, seconds=14)), "FRESH", 24.0),
    (iso(REF - timedelta(hours=24, minutes=6)), "STALE", 24.1),
    (None, "UNKNOWN", None), ("", "UNKNOWN", None), ("invalid-date-string-xyz", "UNKNOWN", None),
    ("2 hours ago", "FRESH", 2.0), ("yesterday", "FRESH", 24.0), ("3 days ago", "STALE", 72.0),
    ("2026-09-12T07:00:00-05:00", "FRESH", 0.0),
    (iso(REF + timedelta(minutes=30)), "FRESH", -0.5), (iso(REF + timedelta(hours=5)), "UNKNOWN", -5.0),
    ("99999999999999999999 days ago", "UNKNOWN", None), ("12:30", "UNKNOWN", None), ("2026", "UNKNOWN", None),
])
def test_freshness(spark, value, status, age):
    gate = one(spark, lambda c: T.freshness(c, at(iso(REF))), value)
    assert (gate["status"], gate["age_hours"]) == (status, age)


@pytest.mark.parametrize("value, status, age", [
    ("Thu, 10 Sep 2026 00:00:37 +0000", "FRESH", 12.49), ("Wed, 09 Sep 2026 03:10:08 +0000", "STALE", 33.33),
])
def test_freshness_of_feed_dates(spark, value, status, age):
    gate = one(spark, lambda c: T.freshness(c, at("2026-09-10T12:30:00Z")), value)
    assert (gate["status"], gate["age_hours"]) == (status, age)


def test_freshness_reason(spark):
    gate = one(spark, lambda c: T.freshness(c, at(iso(REF))), "2 hours ago")
    assert gate["reason"] == "RELATIVE_DATE"
    assert one(spark, lambda c: T.freshness(c, at(iso(REF))), iso(REF))["reason"] == "METADATA"


def test_rounding_is_exact(spark):
    numbers = [random.Random(1).randrange(-10**6, 10**6) * 18 / 3600 for _ in range(500)] + [0.125, 2.675, 135.355]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = df.select("x", T.round_half_even(F.col("x")).alias("r")).collect()
    assert all(r["r"] == round(r["x"], 2) for r in got)


def test_paper_hash_pairs(spark):
    rows = [
        ("Attention Is All You Need.", ["A. One", "B. Two"], "Text", "2017-06-12T00:00:00Z", "https://arxiv.org/abs/1706.03762v1", "cs.CL"),
        (" Attention  is all you need", ["B. Two", "A. One"], " Text ", "2017-06-12T00:00:00Z", "https://arxiv.org/abs/1706.03762v5", "CS.CL"),
        ("Attention Is All You Need.", ["A. One", "B. Two"], "Other", "2017-06-12T00:00:00Z", "https://arxiv.org/abs/1706.03762v1", "cs.CL"),
    ]
    df = spark.createDataFrame(rows, "t string, a array<string>, s string, d string, u string, c string")
    a, b, c = [r[0] for r in df.select(X.paper_hash(*[F.col(x) for x in "tasduc"])).collect()]
    assert a == b != c


PAGE = """<html><head><title> A &lt;b&gt; Title </title><meta content='2026-09-10T01:00:00Z' name="pubdate">
<script type="application/ld+json">{"datePublished": "2026-09-09"}</script></head><body><nav><p>Navigation text here</p></nav>
<article><h1>Heading of the article</h1><p>First paragraph &eacute;t&eacute; &amp;lt; text<p>Second paragraph, unclosed
<!-- <p>hidden in a comment</p> --></article><footer><p>Footer text is noise</p></footer></body></html>"""


def test_page(spark):
    from recordmill.sources.pages import html_page_extract

    row = html_page_extract(spark.createDataFrame([(PAGE, "u")], "raw_content string, url string")).first()
    assert row["title"] == "A <b> Title"
    assert row["meta_dates"] == ["2026-09-10T01:00:00Z"] and row["json_ld_dates"] == ["2026-09-09"]
    assert row["main_text"] == "Heading of the article\n\nFirst paragraph été &lt; text\n\nSecond paragraph, unclosed"


def test_clean_text(spark):
    df = spark.createDataFrame([("<body><script>x</script>A<b> b </b>\n\n<p>C &nbsp;</p></body>",)], "h string")
    assert H.with_clean_text(df, "h", "t").first()["t"].split("\n")[:2] == ["A", "b"]


def test_truncate(spark):
    text = " ".join(str(i) for i in range(500))
    cut = one(spark, lambda c: X.truncate_middle(c, 100), text)
    head, tail = cut.split(X.TRUNCATION_MARK)
    assert head.split() == [str(i) for i in range(80)] and tail.split() == [str(i) for i in range(480, 500)]
    assert one(spark, lambda c: X.truncate_middle(c, 500), text) == text


@pytest.mark.parametrize("value, expected", [
    ("HTTP://WWW.Example.com/jobs/ai-eng/?utm_source=twitter&id=42", "https://example.com/jobs/ai-eng?id=42"),
    ("https://a.org/x/index.html?b=2&a=1&s=3#top", "https://a.org/x?a=1&b=2"), ("https://a.org/", "https://a.org"),
])
def test_canonical_url(spark, value, expected):
    assert one(spark, X.canonicalize_url, value) == expected


def test_role_keeps_substring_rule(spark):
    assert one(spark, lambda t: X.role_family(t, F.lit("")), "Director of Sales") == "Management"


WRITTEN = {
    "2024-01-30T08:00Z": "2024-01-30T08:00:00Z", "2024-01-30 08:00 UTC": "2024-01-30T08:00:00Z",
    "Tue Jan 30 08:00:00 2024": "2024-01-30T08:00:00Z", "Tue Jan 30 08:00:00 UTC 2024": "2024-01-30T08:00:00Z",
    "01/30/2024": "2024-01-30T00:00:00Z", "30/01/2024": "2024-01-30T00:00:00Z", "30-Jan-2024": "2024-01-30T00:00:00Z",
    "2024.01.30": "2024-01-30T00:00:00Z", "30 Jan 2024 8am": "2024-01-30T08:00:00Z", "30 Jan 2024 12:05 am": "2024-01-30T00:05:00Z",
    "30th of January 2024": "2024-01-30T00:00:00Z", "2024 Jan 30": "2024-01-30T00:00:00Z", "30 Jan 24": "2024-01-30T00:00:00Z",
    "Jan 30, 2024 at 8:05 PM EST": "2024-01-31T01:05:00Z", "30 January 2024 08:00 +0530": "2024-01-30T02:30:00Z",
    "2024-01-30T08:00:00.5-05:00": "2024-01-30T13:00:00Z", "30 Jan 2024 08:00:00 -5": "2024-01-30T13:00:00Z",
    "20240130T080506Z": "2024-01-30T08:05:06Z", "2024-01-30 08:00:00 HKT": "2024-01-30T08:00:00Z",
    # No date, half a date, or a date that is not in the calendar.
    "Jan 2024": None, "30 Jan": None, "12:30": None, "31/02/2024": None, "30 Jan 2024 13:00 PM": None, "30 Jan 2024 25:00": None,
    "version 2 of 2024-01-30": None, "1.2.3.4": None, "": None, "30 Jan Feb 2024": None, "99999999999": None, "8:00:00:00 1 Jan 2024": None,
}


def test_written_dates(spark):
    df = spark.createDataFrame([(x,) for x in [*WRITTEN, None, "1 " * 60_000]], "d string")
    got = {r[0]: r[1] for r in df.select("d", T.iso8601(T.parse_timestamp(F.col("d"), at(iso(REF))))).collect()}
    assert {d: got[d] for d in WRITTEN} == WRITTEN and got[None] is None


TAGGED = {
    "a <b>bold</b> c": "a |bold| c", "1 < 2 and 3 > 2": "1 < 2 and 3 > 2", "<a title=\"x > y\">z": "|z", "<a title='<b>'>z": "|z",
    "x <a title=\"open>y</a> z": "x |y| z", "it's <b>so</b>": "it's |so|", "<a 'x>y<b \"q>\">": "|y|\">", "tail <x": "tail <x",
    "<!doctype html><?p?></p>": "|||", "": "", "<x <y <z>": "|", "<": "<",
}


def test_tags_end_as_written(spark):
    df = spark.createDataFrame([(x,) for x in [*TAGGED, None]], "h string")
    got = {r[0]: r[1] for r in df.select("h", H.without_tags(F.col("h"), "|")).collect()}
    assert got == {**TAGGED, None: None}


@pytest.mark.parametrize("page", ["<x " * 350_000, "<a \"> \" " * 120_000 + "'", "<p>word</p> " * 90_000, "<p " * 350_000, "<x '" * 250_000 + ">"])
def test_a_page_of_a_megabyte_is_read_in_linear_time(spark, page):
    df = spark.createDataFrame([(page,)], "h string")
    H.with_clean_text(df.limit(1), "h", "t").select(F.length("t")).collect()
    started = time.time()
    H.with_clean_text(df, "h", "t").select(F.length("t")).collect()
    H.with_main_text(df, "h", "t").select(F.length("t")).collect()
    assert time.time() - started < 20
