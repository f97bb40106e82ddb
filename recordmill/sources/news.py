"""News records from pages and the metadata of the feed that listed them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.fixed_values import NEWS_FEEDS, STORY_TITLE
from recordmill.functions.text import blank_to_null, entities_mentioned
from recordmill.operators.lookups import metadata_attach
from recordmill.sources.envelope import envelope, first_given
from recordmill.sources.pages import html_page_extract, published_at


def rss_news(
    pages: DataFrame, metadata: DataFrame, source: str, ref: Column, collected_at: Column
) -> DataFrame:
    """NEWS envelopes. Title: feed, page, default. Summary: feed description, page description,
    first 300 characters, default. The page itself is only the full text."""
    default_title, default_summary = NEWS_FEEDS[source]
    return _news(pages, metadata, source, default_title, F.lit(default_summary), ref, collected_at)


def story_news(
    pages: DataFrame, stories: DataFrame, ref: Column, collected_at: Column
) -> DataFrame:
    """NEWS envelopes of listed stories (:func:`recordmill.sources.feeds.story_json`). The listing has
    no descriptions; a page without text is summarised by its title."""
    plain = stories.select("url", "seq", "title", "pub_date", F.lit(None).cast("string").alias("description"))
    return _news(pages, plain, "HackerNewsAI", STORY_TITLE, F.col("_title"), ref, collected_at)


def _news(
    pages: DataFrame, metadata: DataFrame, source: str, default_title: str, default_summary: Column,
    ref: Column, collected_at: Column,
) -> DataFrame:
    joined = html_page_extract(metadata_attach(pages, metadata))
    text = F.col("main_text")
    titled = joined.withColumn(
        "_title", F.coalesce(first_given(F.col("feed.title"), F.col("title")), F.lit(default_title))
    )
    known = titled.withColumns({
        "_summary": F.coalesce(
            first_given(
                F.col("feed.description"), F.col("meta_description"), F.substring(text, 1, 300)
            ),
            default_summary,
        ),
        "_date": F.coalesce(published_at(joined, F.col("feed.pub_date"), ref), F.lit("")),
    }).withColumn("_text", F.coalesce(blank_to_null(text), F.col("_summary")))
    content = F.struct(
        F.col("_title").alias("title"),
        F.col("_summary").alias("summary"),
        F.col("_text").alias("full_text"),
        F.col("_date").alias("published_date"),
        entities_mentioned(F.concat_ws(" ", "_title", "_summary", "_text")).alias("entities_mentioned"),
    )
    return envelope(known, "NEWS", F.lit(source), F.col("url"), content, collected_at)
