"""Writing: landing area, record tables, audit rows, exports. All writes are done by the executors;
the driver never holds rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.fixed_values import EXPORT_TABS
from recordmill.functions.classify import is_fixture
from recordmill.functions.text import content_bytes, content_hash


def landed(df: DataFrame) -> DataFrame:
    """Payloads with their landing columns: hash, size, day, file key."""
    digest = content_hash(F.col("raw_content"))
    suffix = F.when(F.contains(F.lower("content_type"), F.lit("xml")), F.lit(".xml")).otherwise(
        F.lit(".html")
    )
    return df.select(
        "*",
        digest.alias("content_hash"),
        content_bytes(F.col("raw_content")).alias("content_length"),
        F.date_format("fetched_at", "yyyy-MM-dd").alias("fetch_date"),
        F.concat(F.substring(digest, 1, 16), suffix).alias("file_key"),
    )


def land_raw(df: DataFrame, path: str) -> None:
    """Appends to the landing area, one folder per source and day, so that a reader of one source
    opens its own folders only. Rows of a day may be many: they are not
    gathered in one task, each task writes its own files."""
    landed(df).write.mode("append").partitionBy("source_name", "fetch_date").parquet(path)


def write_version(df: DataFrame, path: str) -> None:
    """A new version of a table in its own folder; readers switch once it is complete."""
    df.write.mode("errorifexists").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def paper_projection(df: DataFrame) -> DataFrame:
    """Paper rows in export form: authors joined, blanks for nulls, one line per abstract."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    def filled(c: str, default: str) -> Column:
        return F.when(text(c) == "", F.lit(default)).otherwise(F.col(c))

    return df.withColumns({
        "authors": F.coalesce(F.array_join("authors", "; "), F.lit("")),
        "arxiv_id": text("arxiv_id"),
        "normalized_title": text("normalized_title"),
        "github_url": text("github_url"),
        "github_stars": F.coalesce(F.col("github_stars").cast("string"), F.lit("")),
        "primary_category": filled("primary_category", "cs.AI"),
        "abstract": F.replace(text("abstract"), F.lit("\n"), F.lit(" ")),
        "content_hash": text("content_hash"),
        "enrichment_status": filled("enrichment_status", "PENDING"),
    })


def export_tab(df: DataFrame, tab: str) -> DataFrame:
    """A table under its export header. Papers lose their fixtures; jobs and news must carry the
    gate struct ``gate``, and only fresh rows without fixtures remain."""
    rows = df
    if tab == "research_papers":
        rows = paper_projection(df.filter(~is_fixture("export", F.col("source_url"))))
    if tab in ("jobs", "news"):
        rows = df.filter(
            (F.col("gate.status") == "FRESH") & ~is_fixture("export", F.col("source_url"))
        )
    return rows.select(*[F.col(source).alias(header) for header, source in EXPORT_TABS[tab]])


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per tab; pass startups alone for the startups-only export."""
    for tab, df in tables.items():
        export_tab(df, tab).write.mode("overwrite").option("header", True).option(
            "escape", '"'
        ).csv(f"{folder}/{tab}")


PAPER_JSON_FIELDS = [
    "id", "arxiv_id", "source_name", "source_url", "title", "normalized_title", "authors",
    "paper_url", "github_url", "github_stars", "primary_category", "abstract", "content_hash",
    "enrichment_status", "published_date", "collected_at",
]


def paper_json(df: DataFrame) -> DataFrame:
    return df.filter(~is_fixture("export", F.col("source_url"))).select(*PAPER_JSON_FIELDS)


def export_metadata(records: DataFrame, generated_at: Column) -> DataFrame:
    return records.agg(F.count(F.lit(1)).alias("record_count")).select(
        generated_at.alias("generated_at"), "record_count", F.lit("1.0").alias("schema_version"),
        F.array(F.lit("arXiv")).alias("source_coverage"),
    )


def export_papers_json(df: DataFrame, generated_at: Column, folder: str) -> None:
    """JSON lines plus the metadata document. Both are counted and written where the data lies."""
    records = paper_json(df)
    options = {"ignoreNullFields": "false"}
    records.write.mode("overwrite").options(**options).json(f"{folder}/research_papers.jsonl")
    export_metadata(records, generated_at).write.mode("overwrite").json(f"{folder}/metadata.json")


def report_document(report: DataFrame, groups: dict[str, list[str]], at: Column) -> DataFrame:
    """A one-row report nested into named groups and serialised."""
    nested = [F.struct(*columns).alias(name) for name, columns in groups.items()]
    return report.select(F.to_json(F.struct(at.alias("timestamp"), *nested)).alias("document"))


def write_report(document: DataFrame, path: str) -> None:
    document.write.mode("overwrite").text(path)
