"""Rule-based labels: evidence, semantic class, crawl outcome, text quality, defects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.fixed_values import (
    ANTI_BOT_MARKERS,
    COMMERCIAL_TERMS,
    FIXTURE_KEYWORDS,
    LEGAL_ENTITY_TERMS,
    NON_STARTUP_TERMS,
    PRODUCT_WORDS,
    SKIPPED_WEBSITES,
    STARTUP_WORDS,
    TRANSIENT_STATUSES,
    WEBSITE_ENDINGS,
)
from recordmill.functions.text import blank_to_null, contains_any, strip


def _bounded(terms: str) -> str:
    return rf"(?i)\b({terms})\b"


def startup_evidence(
    url: Column, name: Column, login: Column, blog: Column, description: Column,
    company: Column, is_verified: Column,
) -> Column:
    """``struct<accepted, reason>``; the first rule that applies decides."""
    clean = [strip(F.coalesce(x, F.lit(""))) for x in (name, blog, description, company)]
    name, blog, description, company = clean
    tail = F.element_at(F.split(F.regexp_replace(url, "^/+|/+$", ""), "/"), -1)
    login = strip(F.coalesce(blank_to_null(login), tail, F.lit("")))
    everything = F.concat_ws(" ", name, login, description, company, blog)
    in_name = F.regexp_extract(name, _bounded(LEGAL_ENTITY_TERMS), 0)
    in_company = F.regexp_extract(company, _bounded(LEGAL_ENTITY_TERMS), 0)
    legal = F.coalesce(blank_to_null(in_name), blank_to_null(in_company))
    site = F.lower(blog)
    usable = (
        (blog != "") & ~contains_any(site, SKIPPED_WEBSITES) & contains_any(site, WEBSITE_ENDINGS)
    )
    commercial = description.rlike(_bounded(COMMERCIAL_TERMS)) | company.rlike(
        _bounded(COMMERCIAL_TERMS)
    )
    reason = (
        F.when(F.contains(url, F.lit("ycombinator.com")), F.lit("YC_DIRECTORY_RECORD"))
        .when(everything.rlike(_bounded(NON_STARTUP_TERMS)), F.lit("ACADEMIC_OR_NON_PROFIT"))
        .when(F.coalesce(is_verified, F.lit(False)), F.lit("VERIFIED_COMPANY_DOMAIN"))
        .when(
            legal.isNotNull(), F.concat(F.lit("EXPLICIT_LEGAL_ENTITY("), legal, F.lit(")"))
        )
        .when(usable & commercial, F.lit("COMMERCIAL_WEBSITE_AND_PROFILE"))
        .otherwise(F.lit("INSUFFICIENT_COMPANY_EVIDENCE"))
    )
    rejected = reason.isin("ACADEMIC_OR_NON_PROFIT", "INSUFFICIENT_COMPANY_EVIDENCE")
    return F.struct((~rejected).alias("accepted"), reason.alias("reason"))


def evidence_strength(reason: Column) -> Column:
    return (
        F.when(reason == "COMMERCIAL_WEBSITE_AND_PROFILE", F.lit("MODERATE"))
        .when(
            reason.isin("ACADEMIC_OR_NON_PROFIT", "INSUFFICIENT_COMPANY_EVIDENCE"),
            F.lit("REJECTED"),
        )
        .otherwise(F.lit("STRONG"))
    )


def startup_class(url: Column, name: Column, description: Column, website: Column) -> Column:
    """Null for sites that the rule does not know."""
    text = F.lower(F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(description, F.lit(""))))
    plausible = (F.coalesce(website, F.lit("")) != "") | contains_any(text, STARTUP_WORDS)
    return (
        F.when(F.contains(url, F.lit("ycombinator.com")), F.lit("CLEARLY"))
        .when(F.contains(url, F.lit("github.com")) & plausible, F.lit("PLAUSIBLY"))
        .when(F.contains(url, F.lit("github.com")), F.lit("NOT_DEMONSTRABLY"))
    )


def product_class(url: Column, name: Column, description: Column) -> Column:
    text = F.lower(F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(description, F.lit(""))))
    return (
        F.when(F.contains(url, F.lit("producthunt.com")), F.lit("CLEARLY"))
        .when(
            F.contains(url, F.lit("github.com")) & contains_any(text, PRODUCT_WORDS),
            F.lit("PLAUSIBLY"),
        )
        .when(F.contains(url, F.lit("github.com")), F.lit("NOT_DEMONSTRABLY"))
    )


def fetch_class(status: Column, body: Column) -> Column:
    """``struct<outcome, retryable>`` of one request."""
    marked = contains_any(F.lower(F.coalesce(body, F.lit(""))), ANTI_BOT_MARKERS)
    outcome = (
        F.when((status == 403) & marked, F.lit("anti_bot"))
        .when(status == 403, F.lit("blocked"))
        .when(status == 429, F.lit("rate_limited"))
        .when(status.isin(TRANSIENT_STATUSES), F.lit("transient"))
        .when(status >= 400, F.lit("permanent"))
        .otherwise(F.lit("ok"))
    )
    return F.struct(
        outcome.alias("outcome"), outcome.isin("rate_limited", "transient").alias("retryable")
    )


def text_quality(c: Column) -> Column:
    size = F.length(F.coalesce(c, F.lit("")))
    return (
        F.when(size >= 500, F.lit("FULL_TEXT"))
        .when(size >= 100, F.lit("PARTIAL_TEXT"))
        .when(size > 0, F.lit("FEED_ONLY"))
        .otherwise(F.lit("FETCH_FAILURE"))
    )


def content_defects(c: Column) -> Column:
    """``struct<length_class, tag_leakage, encoding_problem>``."""
    missing = F.coalesce(c, F.lit("")) == ""
    text = strip(c)
    size = F.length(text)
    length_class = (
        F.when(missing, F.lit("missing"))
        .when(size == 0, F.lit("empty"))
        .when(size < 50, F.lit("short"))
        .when(size > 10000, F.lit("long"))
        .otherwise(F.lit("ok"))
    )
    leaked = ~missing & text.rlike(r"<[a-zA-Z/][^>]*>")
    broken = ~missing & contains_any(text, ["�", "&amp;", "&lt;"])
    return F.struct(
        length_class.alias("length_class"),
        F.coalesce(leaked, F.lit(False)).alias("tag_leakage"),
        F.coalesce(broken, F.lit(False)).alias("encoding_problem"),
    )


def date_defect(c: Column, last_year: int = 2027) -> Column:
    iso = F.when(
        c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), c
    ).try_cast("timestamp")
    return (
        F.when(F.coalesce(c, F.lit("")) == "", F.lit("missing"))
        .when(iso.isNull(), F.lit("invalid"))
        .when(F.substring(c, 1, 4).try_cast("int") > last_year, F.lit("future"))
        .otherwise(F.lit("ok"))
    )


def is_fixture(table: str, url: Column, name: Column | None = None) -> Column:
    """True for test rows: no URL, or a marker in the URL (or, where given, in the name)."""
    words = FIXTURE_KEYWORDS[table]
    address = F.coalesce(url, F.lit(""))
    if table == "news":
        address = F.lower(address)
    hit = (address == "") | contains_any(address, words)
    if name is not None:
        hit = hit | contains_any(F.coalesce(name, F.lit("")), words)
    return hit


def enrichment_status(github_url: Column, stars: Column) -> Column:
    """State of a paper that has not gone through enrichment in this run."""
    return (
        F.when(stars.isNotNull(), F.lit("COMPLETED"))
        .when(F.trim(F.coalesce(github_url, F.lit(""))) != "", F.lit("PENDING"))
        .otherwise(F.lit("NO_DATA"))
    )
