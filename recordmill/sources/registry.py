"""Sources by name. A source is a record type and a function from payload rows to envelopes; adding
one needs no change anywhere else."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.fixed_values import JOB_BOARDS, NEWS_FEEDS, SOURCE_ALIASES
from recordmill.operators.audits import union_all
from recordmill.operators.lookups import metadata_attach
from recordmill.session import cut_lineage
from recordmill.sources.envelope import as_payload
from recordmill.sources.jobs import jobs_colon_titles, jobs_json_flat, jobs_pipe_posts
from recordmill.sources.news import rss_news, story_news
from recordmill.sources.papers import paper_payloads
from recordmill.sources.products import model_id_products, repo_json_products
from recordmill.sources.startups import org_json_startups


@dataclass(frozen=True)
class Source:
    name: str
    record_type: str
    parse: Callable[[DataFrame, Column, Column], DataFrame]


class Registry:
    """Names are looked up without regard to case. A source may have further names."""

    def __init__(self) -> None:
        self._sources: dict[str, Source] = {}
        self._names: dict[str, str] = {}

    def register(self, source: Source, *aliases: str) -> None:
        key = source.name.lower()
        self._sources[key] = source
        self._names |= {name.lower(): key for name in (source.name, *aliases)}

    def get(self, name: str) -> Source | None:
        return self._sources.get(self._names.get(name.lower(), ""))

    def names(self) -> list[str]:
        return list(self._names)

    def key_of(self, name: Column) -> Column:
        """The key of the source that a name stands for; null where there is none."""
        known = F.create_map(*[F.lit(x) for pair in self._names.items() for x in pair])
        return known[F.lower(name)]

    def union(self, payloads: DataFrame, ref: Column, collected_at: Column) -> DataFrame:
        """All payloads, each parsed by its own source, in one shape. The payloads are read once and
        written to a folder per source, so that every source reads its own rows only. Rows that no
        source knows are left behind."""
        tagged = payloads.withColumn("_source", self.key_of(F.col("source_name")))
        by_source = cut_lineage(tagged.filter(F.col("_source").isNotNull()), "by-source", "_source")
        return union_all([
            as_payload(s.parse(
                by_source.filter(F.col("_source") == key).drop("_source").withColumn("source_name", F.lit(s.name)),
                ref, collected_at,
            ))
            for key, s in self._sources.items()
        ])


def no_metadata(pages: DataFrame) -> DataFrame:
    """Metadata of the right shape for pages that no feed has listed."""
    empty = F.lit(None).cast("string")
    return pages.filter(F.lit(False)).select(
        "url", "seq", empty.alias("title"), empty.alias("pub_date"), empty.alias("description")
    )


def default_registry(metadata: DataFrame | None = None) -> Registry:
    """Built-in sources. ``metadata`` is the table of feed items for the news sources."""
    registry = Registry()
    listed = metadata

    def add(name: str, record_type: str, parse: Callable[[DataFrame, Column, Column], DataFrame]) -> None:
        registry.register(Source(name, record_type, parse), *SOURCE_ALIASES.get(name, ()))

    def known(pages: DataFrame) -> DataFrame:
        return no_metadata(pages) if listed is None else listed

    add("ArXiv", "RESEARCH_PAPER", paper_payloads)
    add("GitHub Organizations", "STARTUP", lambda df, ref, at: org_json_startups(df, at))
    add("GitHub Repositories", "PRODUCT", lambda df, ref, at: repo_json_products(df, at))
    add("Hugging Face Models", "PRODUCT", lambda df, ref, at: model_id_products(df, at))
    for board in JOB_BOARDS:
        add(board, "JOB", lambda df, ref, at, b=board: jobs_json_flat(df, b, ref, at))
    add("HNWhoIsHiring", "JOB", jobs_pipe_posts)
    add("WeWorkRemotelyAI", "JOB", lambda df, ref, at: jobs_colon_titles(
        with_metadata(df, known(df)), ref, at))
    for feed in NEWS_FEEDS:
        add(feed, "NEWS", lambda df, ref, at, f=feed: rss_news(df, known(df), f, ref, at))
    add("HackerNewsAI", "NEWS", lambda df, ref, at: story_news(df, known(df), ref, at))
    return registry


def with_metadata(pages: DataFrame, metadata: DataFrame) -> DataFrame:
    """Payload rows with the title, date and description under which their feed lists them."""
    joined = metadata_attach(pages, metadata)
    return joined.select(
        "seq", "url", *[F.col(f"feed.{c}").alias(c) for c in ("title", "pub_date", "description")]
    )
