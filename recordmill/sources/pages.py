"""Facts taken from HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions import html as H
from recordmill.functions.text import github_url, strip
from recordmill.functions.times import iso8601, parse_timestamp
from recordmill.sources.envelope import envelope, first_given


def html_page_extract(df: DataFrame, html: str = "raw_content", url: str = "url") -> DataFrame:
    """Adds ``title, canonical_url, meta_description, meta_dates, json_ld_dates, main_text``."""
    page = F.col(html)
    facts = (
        df.withColumn("_tags", H.meta_tags(page))
        .withColumn("title", H.page_title(page, F.col("_tags")))
        .withColumn("canonical_url", H.canonical_link(page, F.col(url)))
        .withColumn("meta_description", H.meta_description(F.col("_tags")))
        .withColumn("meta_dates", H.meta_dates(F.col("_tags")))
        .withColumn("json_ld_dates", H.json_ld_dates(H.json_ld_objects(page)))
        .drop("_tags")
    )
    return H.with_main_text(H.decode_columns(facts, "title", "meta_description"), html, "main_text")


def published_at(pages: DataFrame, feed_date: Column, ref: Column) -> Column:
    """ISO date: the source's own metadata, else the first meta date, else the first JSON-LD date.
    A source date that cannot be read gives way to the page's."""
    page_date = F.coalesce(F.get("meta_dates", 0), F.get("json_ld_dates", 0))
    return iso8601(F.coalesce(parse_timestamp(feed_date, ref), parse_timestamp(page_date, ref)))


def paper_page_extract(df: DataFrame, ref: Column, collected_at: Column) -> DataFrame:
    """Paper pages: ``citation_*`` meta tags first, page elements otherwise. A date that is not
    there stays null."""
    page = F.col("raw_content")
    tags = F.col("_tags")

    def cite(name: str) -> Column:
        return F.get(H.meta_contents(tags, "name", f"citation_{name}"), 0)

    def element(tag: str, css: str) -> Column:
        opening = rf"<{tag}\b[^>]*class\s*=\s*[\"'][^\"'>]*{css}[^>]*>"
        return H.element_text(F.col("_bare"), opening, tag)

    author_box = F.get(
        F.regexp_extract_all(
            page, F.lit(r"(?is)<div\b[^>]*class\s*=\s*[\"'][^\"'>]*\bauthors\b[^>]*>(.*?)</div\s*>"), F.lit(1)
        ), 0,
    )
    links = F.regexp_extract_all(author_box, F.lit(r"(?is)<a\b[^>]*>(.*?)</a\s*>"), F.lit(1))
    linked = F.transform(links, lambda a: strip(F.regexp_replace(a, "<[^>]+>", "")))
    cited = F.transform(
        F.filter(H.meta_contents(tags, "name", "citation_author"), lambda a: a.isNotNull()), strip
    )
    authors = F.when(F.size(cited) > 0, cited).otherwise(linked)
    authors = F.when(F.size(authors) > 0, authors).otherwise(F.array(F.lit("Unknown Author")))
    dated = F.coalesce(parse_timestamp(F.col("_cited"), ref), parse_timestamp(F.col("_dateline"), ref))
    content = F.struct(
        F.col("_title").alias("title"),
        authors.alias("authors"),
        F.col("url").alias("paper_url"),
        github_url(F.get(F.regexp_extract_all(page, F.lit(r"https?://github\.com/[a-zA-Z0-9_\-.]+/[a-zA-Z0-9_\-.]+"), F.lit(0)), 0)).alias("github_url"),
        F.lit(None).cast("bigint").alias("github_stars"),
        iso8601(dated).alias("published_date"),
        F.col("_abstract").alias("abstract"),
        F.lit("cs.AI").alias("primaryCategory"),
    )
    # Texts are columns before they are decoded: a Python function takes no nested lambdas as arguments. So are
    # those that are looked at several times, as each look would take them from the page anew.
    bare = F.regexp_replace(page, r"(?is)<span\b[^>]*descriptor[^>]*>.*?</span\s*>", "")
    tagged = H.decode_columns(df.withColumns({"_tags": H.meta_tags(page), "_bare": bare}).withColumns({
        "_cited": cite("date"), "_dateline": strip(element("div", "dateline")),
        "_title": F.coalesce(
            first_given(strip(cite("title")), strip(element("h1", "title"))), F.lit("Untitled arXiv Paper")),
        "_abstract": first_given(strip(cite("abstract")), strip(element("blockquote", "abstract"))),
    }), "_title", "_abstract")
    return envelope(tagged, "RESEARCH_PAPER", F.lit("ArXiv"), F.col("url"), content, collected_at)
