"""One batch run over landed payloads: from raw rows to the next version of every table.

Steps: crawl outcome, parsing by source, freshness gate, startup evidence, validation, claims of URLs,
resolution, enrichment, merge. A URL is claimed by the first payload of it that passes all checks;
a failed, stale or broken payload claims nothing, and only arrivals after the claim are duplicates.
The parsed and validated rows are written once to the shared folder, because records, tables, mappings,
dead letters and statuses all come from them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.classify import fetch_class, startup_evidence
from recordmill.functions.jsonvalues import json_text
from recordmill.functions.text import url_fingerprint
from recordmill.functions.times import freshness
from recordmill.operators.lookups import enrich_repo_stats
from recordmill.operators.resolve import mapping_log, resolve_all, write_back
from recordmill.operators.tables import RECORD_TABLES, table_rows
from recordmill.operators.upsert import upsert_records
from recordmill.operators.validate import (
    dead_letters,
    pipeline_status,
    present_types,
    validate_by_type,
)
from recordmill.schemas import ORG
from recordmill.session import cut_lineage, join_side, shuffled
from recordmill.sources.registry import Registry

GATED_TYPES = ["NEWS", "JOB"]
EVIDENCE_SOURCES = ["GitHub Organizations"]
STORED = "NEW_RECORD_STORED"
NAME_PATHS = {
    "STARTUP": "$.content.entityName", "PRODUCT": "$.content.startupName",
    "JOB": "$.content.company", "RESEARCH_PAPER": "$.content.title",
    "NEWS": "$.content.publisher",
}


@dataclass(frozen=True)
class BatchResult:
    """Lazy outputs of a run. ``records`` are the stored envelopes with their entities; ``rows`` holds
    them as rows of the five record tables, and ``tables`` the next version of each table."""

    records: DataFrame
    mappings: DataFrame
    dead: DataFrame
    statuses: DataFrame
    rows: dict[str, DataFrame]
    tables: dict[str, DataFrame]


def _name(payload: Column, record_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, path in NAME_PATHS.items():
        out = F.when(record_type == kind, json_text(payload, path)).otherwise(out)
    return out


def _published(payload: Column, record_type: Column) -> Column:
    return F.when(record_type == "JOB", json_text(payload, "$.content.date")).otherwise(
        json_text(payload, "$.content.published_date")
    )


def _evidence(payloads: DataFrame, registry: Registry) -> Column:
    """Whether an organisation's payload shows it to be a company; true for every other source."""
    org = F.when(
        registry.key_of(F.col("source_name")).isin([s.lower() for s in EVIDENCE_SOURCES]),
        F.from_json("raw_content", ORG),
    )
    names = ("name", "login", "blog", "description", "company", "is_verified")
    verdict = startup_evidence(F.col("url"), *[org[n] for n in names])
    return F.when(org.isNotNull(), verdict["accepted"]).otherwise(F.lit(True))


def run_batch(
    payloads: DataFrame, registry: Registry, master: DataFrame, store: DataFrame | None,
    ref: Column, collected_at: Column, snapshot: DataFrame | None = None,
    stored: dict[str, DataFrame] | None = None,
) -> BatchResult:
    """``payloads`` are landed rows with unique ``seq``; ``store`` holds the fingerprints
    (``url_hash``) of URLs stored by earlier runs; ``snapshot`` the newest repository answers
    (``github_url, http_status, stars, seq``); ``stored`` the present record tables by name."""
    crawl = fetch_class(F.col("http_status"), F.col("raw_content"))
    # Bodies stay behind: what the joins below shuffle is a few short columns per payload.
    narrow = payloads.select(
        "seq", "url", "source_name", crawl["outcome"].alias("crawl_outcome"),
        F.substring("raw_content", 1, 200).alias("preview"),
        _evidence(payloads, registry).alias("evident"),
        url_fingerprint(F.col("url")).alias("url_hash"),
    ).withColumn("known", F.lit(False))
    if store is not None:
        seen = store.select("url_hash").distinct().withColumn("_seen", F.lit(True))
        narrow = narrow.join(seen, "url_hash", "left").withColumn(
            "known", F.coalesce("_seen", F.lit(False))
        ).drop("_seen")
    outcome = cut_lineage(narrow.withColumn("fetched", F.col("crawl_outcome") == "ok"), "outcomes")
    known = join_side(outcome.filter("known").select("seq"), "known")
    work = payloads.filter(crawl["outcome"] == "ok").join(known, "seq", "left_anti")
    parsed = cut_lineage(registry.union(work, ref, collected_at), "parsed", "record_type")
    # Only dated types are judged by their date. The date is a column of its own, so that the record is read once for it.
    dated = F.col("record_type").isin(GATED_TYPES)
    gated = parsed.withColumn("_published", F.when(dated, _published(F.col("payload"), F.col("record_type")))).withColumn(
        "gate_status", F.when(dated, freshness(F.col("_published"), ref)["status"])).drop("_published")
    checked = cut_lineage(validate_by_type(gated, types=present_types(parsed)), "checked", "record_type")
    by_seq = checked.select("seq", "record_type", "gate_status", "valid", "errors")
    # One row per payload: as files such columns shrink to almost nothing, and Spark would have the driver gather them.
    joined = outcome.join(shuffled(by_seq), "seq", "left")
    needs_gate = F.coalesce(F.col("record_type").isin(GATED_TYPES), F.lit(False))
    status = pipeline_status(
        F.col("known"), F.col("fetched"), needs_gate, F.coalesce("gate_status", F.lit("UNKNOWN")),
        F.col("record_type").isNotNull(), F.coalesce("valid", F.lit(False)),
    )
    own = F.when((status == STORED) & ~F.col("evident"), F.lit("EVIDENCE_REJECTED")).otherwise(status)
    judged = cut_lineage(joined.withColumn("own_status", own), "judged")
    claims = judged.filter(F.col("own_status") == STORED).groupBy("url_hash").agg(F.min("seq").alias("claimed_by"))
    late = F.coalesce(F.col("seq") > F.col("claimed_by"), F.lit(False))
    statuses = judged.join(shuffled(claims), "url_hash", "left").withColumn(
        "status", F.when(late, F.lit("DUPLICATE_ALREADY_PROCESSED")).otherwise(F.col("own_status"))
    )
    chosen = statuses.filter(F.col("status") == STORED).select("seq")
    good = cut_lineage(checked.join(shuffled(chosen), "seq", "left_semi"), "good", "record_type")
    named = good.select(
        "seq", "url", "record_type", "payload",
        _name(F.col("payload"), F.col("record_type")).alias("raw_name"),
        F.col("record_type").alias("entity_type"), F.col("url").alias("domain"),
        F.lit(None).cast("map<string,string>").alias("external_ids"),
    )
    resolved = resolve_all(named, master)
    given = F.coalesce(F.col("raw_name"), F.lit("")) != ""
    records = resolved.select(
        "seq", "url", "record_type", "payload", url_fingerprint(F.col("url")).alias("url_hash"),
        F.when(given, F.col("canonical_entity_id")).alias("canonical_entity_id"),
        F.when(given, write_back(F.col("record_type"), F.col("raw_name"), F.col("canonical_value"))).alias("entity_name"),
    )
    mappings = mapping_log(resolved.filter(given), F.col("url"), collected_at)
    rows, tables = {}, {}
    for table, kind in RECORD_TABLES.items():
        rows[table] = table_rows(good.filter(F.col("record_type") == kind), table)
        if table == "research_papers" and snapshot is not None:
            columns = rows[table].columns
            rows[table] = enrich_repo_stats(rows[table], snapshot).select(*columns, "enrichment_status")
        before = (stored or {}).get(table)
        tables[table] = upsert_records(table, before, rows[table]) if before is not None else rows[table]
    failed = statuses.filter(F.col("status").isin("FETCH_FAILED", "EXTRACTION_FAILED", "VALIDATION_FAILED"))
    bodies = checked.filter("NOT valid").select("seq", "payload")
    fetch = F.col("status") == "FETCH_FAILED"
    dead = dead_letters(
        failed.withColumn("raw_content", F.col("preview")).join(shuffled(bodies), "seq", "left"),
        F.when(fetch, F.lit("FETCH_FAILED")).otherwise(F.lit("EXTRACTION_OR_VALIDATION_FAILED")),
        F.when(fetch, F.lit("AsyncCrawlerLayer")).otherwise(F.lit("ExtractionLayer")),
        F.when(fetch, F.col("crawl_outcome")).otherwise(
            F.coalesce(F.array_join("errors", "; "), F.lit("no source for this payload"))
        ),
        enqueued_at=collected_at,
    )
    return BatchResult(
        records, mappings, dead,
        statuses.select("seq", "url", "source_name", "record_type", "status"), rows, tables,
    )
