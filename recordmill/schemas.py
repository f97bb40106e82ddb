"""Declared schemas: tables, payload parts, and the record rules that the validator checks."""

from __future__ import annotations

from dataclasses import dataclass, field

ENVELOPE_SOURCE = "struct<name:string,url:string>"
RAW_PAYLOAD = (
    "seq bigint, url string, source_name string, raw_content string, content_type string, "
    "http_status int, fetched_at timestamp"
)
ENTITY_MASTER = (
    "seq bigint, canonical_entity_id string, entity_type string, canonical_name string, "
    "normalized_name string, aliases array<string>, domains array<string>, "
    "external_ids map<string,string>, source_urls array<string>, created_at timestamp, "
    "updated_at timestamp"
)
ATOM_ENTRY = (
    "struct<id:string,title:string,summary:string,published:string,"
    "author:array<struct<name:string>>>"
)
ATOM_FEED = (
    f"entry {ATOM_ENTRY}, title string, summary string, published string, "
    "author array<struct<name:string>>"
)
RSS_ITEM = (
    "title string, link string, description string, pubDate string, `dc:date` string"
)
ORG = (
    "name string, login string, blog string, description string, created_at string, "
    "location string, html_url string, company string, is_verified boolean"
)
REPO = (
    "name string, owner struct<login:string>, description string, created_at string, "
    "html_url string"
)
STORY = "id bigint, url string, title string, time bigint"
DAILY_PAPER = (
    "paper struct<id:string,title:string,summary:string,submittedOnDailyAt:string,"
    "publishedAt:string>, title string, summary string, publishedAt string"
)
FORUM_POST = "objectID string, comment_text string, created_at string"


@dataclass(frozen=True)
class Rule:
    """Rules for one value. ``types`` are JSON Schema type names."""

    types: tuple[str, ...]
    required: tuple[str, ...] = ()
    fields: dict[str, "Rule"] = field(default_factory=dict)
    items: str | None = None
    min_length: int | None = None
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple[str, ...] | None = None


TEXT = Rule(("string",))
NAMED = Rule(("string",), min_length=1)
TEXT_OR_NULL = Rule(("string", "null"))
TEXTS = Rule(("array",), items="string")
COUNT_OR_NULL = Rule(("integer", "null"), minimum=0)


def _record(kind: str, content: Rule) -> Rule:
    top = ("schemaVersion", "recordType", "source", "content", "collectedAt")
    source = Rule(("object",), ("name", "url"), {"name": NAMED, "url": TEXT})
    return Rule(
        ("object",), top,
        {
            "schemaVersion": Rule(("string",), allowed=("1.0",)),
            "recordType": Rule(("string",), allowed=(kind,)),
            "source": source,
            "content": content,
            "collectedAt": TEXT,
        },
    )


RECORD_RULES = {
    "STARTUP": _record("STARTUP", Rule(
        ("object",), ("entityName", "data"),
        {
            "entityName": NAMED,
            "description": TEXT_OR_NULL,
            "website": TEXT_OR_NULL,
            "foundingYear": Rule(("integer", "null"), minimum=1900, maximum=2100),
            "hqLocation": TEXT_OR_NULL,
            "data": Rule(
                ("object",), ("employeeCount",),
                {
                    "employeeCount": COUNT_OR_NULL,
                    "fundingTotalUsd": Rule(("number", "null"), minimum=0),
                    "lastFundingStage": TEXT_OR_NULL,
                    "industries": TEXTS,
                },
            ),
        },
    )),
    "PRODUCT": _record("PRODUCT", Rule(
        ("object",), ("productName", "startupName", "pricingModel"),
        {
            "productName": NAMED,
            "startupName": NAMED,
            "pricingModel": Rule(
                ("string",), allowed=("FREE", "FREEMIUM", "PAID", "ENTERPRISE", "UNKNOWN")
            ),
            "description": TEXT_OR_NULL,
            "category": TEXT_OR_NULL,
            "launchDate": TEXT_OR_NULL,
        },
    )),
    "RESEARCH_PAPER": _record("RESEARCH_PAPER", Rule(
        ("object",),
        ("title", "authors", "paper_url", "github_url", "github_stars", "published_date"),
        {
            "title": NAMED,
            "authors": TEXTS,
            "paper_url": TEXT,
            "github_url": TEXT_OR_NULL,
            "github_stars": COUNT_OR_NULL,
            "published_date": TEXT,
            "abstract": TEXT_OR_NULL,
            "primaryCategory": TEXT_OR_NULL,
        },
    )),
    "JOB": _record("JOB", Rule(
        ("object",), ("company", "date", "is_remote", "role_family"),
        {
            "jobTitle": TEXT_OR_NULL,
            "company": NAMED,
            "date": TEXT,
            "is_remote": Rule(("boolean",)),
            "role_family": NAMED,
            "location": TEXT_OR_NULL,
            "descriptionSnippet": TEXT_OR_NULL,
        },
    )),
    "NEWS": _record("NEWS", Rule(
        ("object",),
        ("title", "summary", "full_text", "published_date", "entities_mentioned"),
        {
            "title": NAMED,
            "summary": TEXT,
            "full_text": NAMED,
            "published_date": TEXT,
            "authors": TEXTS,
            "entities_mentioned": TEXTS,
            "topics": TEXTS,
        },
    )),
    "ENTITY_MAPPING": Rule(
        ("object",),
        ("schemaVersion", "recordType", "mappingId", "entityType", "rawValue", "normalizedValue",
         "canonicalValue", "decision", "matchMethod", "confidence", "timestamp", "sourceUrl",
         "resolverVersion"),
        {
            "schemaVersion": Rule(("string",), allowed=("1.0",)),
            "recordType": Rule(("string",), allowed=("ENTITY_MAPPING",)),
            "mappingId": TEXT,
            "sourceRecordId": TEXT_OR_NULL,
            "entityType": TEXT,
            "rawValue": TEXT,
            "normalizedValue": TEXT,
            "canonicalValue": TEXT,
            "resolvedCanonicalEntityId": TEXT_OR_NULL,
            "decision": TEXT,
            "matchMethod": TEXT,
            "confidence": Rule(("number",), minimum=0, maximum=1),
            "evidence": Rule(("object", "null")),
            "timestamp": TEXT,
            "sourceUrl": TEXT,
            "resolverVersion": TEXT,
        },
    ),
}
