"""RSS items and JSON listings: rows of metadata, keyed by URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import blank_to_null, is_ai_title, strip
from recordmill.functions.times import iso8601, parse_timestamp
from recordmill.schemas import DAILY_PAPER, RSS_ITEM, STORY
from recordmill.sources.envelope import first_given


def unreadable(df: DataFrame, kind: str) -> DataFrame:
    """Landed listings of ``kind`` ('rss', 'papers' or 'story') that cannot be read, whole rows with
    a ``reason``, for the dead letters. A readable listing without items is not one of them."""
    if kind == "rss":
        item = f"array<struct<{RSS_ITEM}>>"
        feed = F.from_xml("raw_content", f"channel struct<item:{item}>, item {item}")
        root = F.col("raw_content").rlike(r"(?i)<(channel|rdf:rdf|rss)\b")
        readable = F.coalesce(feed["channel"]["item"], feed["item"]).isNotNull() | (
            root & F.col("raw_content").rlike(r"(?i)</(channel|rdf:rdf|rss)\s*>"))
    elif kind == "papers":
        readable = F.startswith(F.schema_of_variant(F.try_parse_json("raw_content")), F.lit("ARRAY"))
    else:
        readable = F.startswith(F.schema_of_variant(F.try_parse_json("raw_content")), F.lit("OBJECT"))
    reason = F.lit(f"unreadable {kind} listing")
    return df.filter(~F.coalesce(readable, F.lit(False))).withColumn("reason", reason)


def rss_items(df: DataFrame) -> DataFrame:
    """One row per feed item that has a link. ``pubDate`` goes before ``dc:date``."""
    item = f"array<struct<{RSS_ITEM}>>"
    parsed = F.from_xml("raw_content", f"channel struct<item:{item}>, item {item}")
    items = df.select("seq", parsed.alias("feed")).select(
        "seq", F.posexplode(F.coalesce("feed.channel.item", "feed.item")).alias("pos", "i")
    )

    def text(c: Column) -> Column:
        return blank_to_null(strip(c))

    return items.select(
        "seq", "pos",
        text(F.col("i.link")).alias("url"),
        text(F.col("i.title")).alias("title"),
        F.coalesce(text(F.col("i.pubDate")), text(F.col("i.`dc:date`"))).alias("pub_date"),
        text(F.col("i.description")).alias("description"),
    ).filter(F.col("url").isNotNull())


def daily_papers_json(df: DataFrame, ref: Column) -> DataFrame:
    """One row per paper of a JSON listing."""
    listing = F.from_json("raw_content", f"array<struct<{DAILY_PAPER}>>")
    items = df.select("seq", F.posexplode(listing).alias("pos", "i"))
    date = first_given(
        F.col("i.paper.submittedOnDailyAt"), F.col("i.paper.publishedAt"), F.col("i.publishedAt")
    )
    return items.filter(F.coalesce(F.col("i.paper.id"), F.lit("")) != "").select(
        "seq", "pos",
        F.concat(F.lit("https://huggingface.co/papers/"), F.col("i.paper.id")).alias("url"),
        first_given(F.col("i.paper.title"), F.col("i.title")).alias("title"),
        iso8601(parse_timestamp(date, ref)).alias("pub_date"),
        first_given(F.col("i.paper.summary"), F.col("i.summary")).alias("description"),
    )


def story_json(df: DataFrame) -> DataFrame:
    """AI stories of a JSON listing; a story without address gets its discussion page."""
    story = df.select("seq", F.from_json("raw_content", STORY).alias("s"))
    fallback = F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("s.id").cast("string"))
    seconds = F.when(F.col("s.time") != 0, F.col("s.time"))
    return story.filter(is_ai_title(F.col("s.title"))).select(
        "seq",
        first_given(F.col("s.url"), fallback).alias("url"),
        F.col("s.title").alias("title"),
        iso8601(F.timestamp_seconds(seconds)).alias("pub_date"),
    )
