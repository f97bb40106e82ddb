"""Research papers from Atom payloads or pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import github_url, strip
from recordmill.functions.times import iso8601, parse_timestamp
from recordmill.schemas import ATOM_ENTRY, ATOM_FEED
from recordmill.sources.envelope import envelope, first_given
from recordmill.sources.pages import paper_page_extract


def payload_kind(c: Column) -> Column:
    """``atom`` or ``html``."""
    head = F.contains(F.substring(c, 1, 200), F.lit("<feed"))
    return F.when(F.startswith(strip(c), F.lit("<?xml")) | head, F.lit("atom")).otherwise(
        F.lit("html")
    )


def _one_line(c: Column) -> Column:
    return F.replace(strip(c), F.lit("\n"), F.lit(" "))


def atom_papers(
    df: DataFrame, ref: Column, collected_at: Column, category: str = "cs.AI"
) -> DataFrame:
    """First entry of each Atom payload; a payload without entries is read as an entry itself."""
    schema = ATOM_FEED.replace(f"entry {ATOM_ENTRY}", f"entry array<{ATOM_ENTRY}>")
    parsed = df.withColumn("_feed", F.from_xml("raw_content", schema, {"ignoreNamespace": "true"}))
    entry = F.coalesce(
        F.get("_feed.entry", 0).dropFields("id"),
        F.struct(*[F.col(f"_feed.{c}").alias(c) for c in ("title", "summary", "published", "author")]),
    )
    parsed = parsed.withColumn("_entry", entry)
    names = F.transform(F.coalesce("_entry.author", F.array()), lambda a: strip(a["name"]))
    names = F.filter(names, lambda n: F.coalesce(n, F.lit("")) != "")
    abstract = F.coalesce(_one_line(F.col("_entry.summary")), F.lit(""))
    content = F.struct(
        F.coalesce(
            first_given(_one_line(F.col("_entry.title"))), F.lit("Untitled arXiv Paper")
        ).alias("title"),
        F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("Unknown Author"))).alias("authors"),
        F.col("url").alias("paper_url"),
        github_url(F.get(F.regexp_extract_all(abstract, F.lit(r"https?://github\.com/[a-zA-Z0-9_\-.]+/[a-zA-Z0-9_\-.]+"), F.lit(0)), 0)).alias("github_url"),
        F.lit(None).cast("bigint").alias("github_stars"),
        iso8601(parse_timestamp(F.col("_entry.published"), ref)).alias("published_date"),
        abstract.alias("abstract"),
        F.lit(category).alias("primaryCategory"),
    )
    return envelope(parsed, "RESEARCH_PAPER", F.lit("ArXiv"), F.col("url"), content, collected_at)


def paper_payloads(df: DataFrame, ref: Column, collected_at: Column) -> DataFrame:
    """Both kinds of paper payload, each through its own parser."""
    kind = payload_kind(F.col("raw_content"))
    atom = atom_papers(df.filter(kind == "atom"), ref, collected_at)
    page = paper_page_extract(df.filter(kind == "html"), ref, collected_at)
    return atom.unionByName(page)
