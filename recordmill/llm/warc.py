"""Resolution of not-modified revisits in web archives.

A revisit record says that a page had not changed. It is joined as of its time to the latest earlier
full response of the same canonical URL. The validators of both must agree; then the stored response
stands, with the headers that a not-modified answer may update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Headers that a not-modified answer may replace.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Seconds of one bucket. The rows of one URL are ordered inside buckets, and buckets among each other.
BUCKET_SECONDS = 3600

HEADER = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, ``www`` prefix and default port; no fragment; at least
    the path ``/``. Null for null and for anything without a scheme and host."""
    url = F.trim(url)
    front = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(front), r"^[a-z][a-z0-9+.-]*://(www[0-9]*\.)?", ""), r":(80|443)$", "")
    rest = F.regexp_replace(F.substr(url, F.length(front) + 1), r"#[\s\S]*$", "")
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(front != "", F.concat(host, path))


def header_list(block: Column) -> Column:
    """Headers of a block in order; names in lower case, values trimmed. Lines without a colon fall away."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n", -1), lambda x: F.instr(x, ":") > 1)
    return F.transform(lines, lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
        F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("value")))


def header_value(headers: Column, name: str) -> Column:
    """The first value of a header, or null."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def header_block(headers: Column) -> Column:
    return F.array_join(F.transform(headers, lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")


def merged_headers(stored: Column, update: Column, permitted=PERMITTED) -> Column:
    """The stored headers, those named in a permitted header of ``update`` replaced by it; by name."""
    allowed = F.filter(update, lambda h: h["name"].isin(*permitted))
    names = F.transform(allowed, lambda h: h["name"])
    kept = F.filter(stored, lambda h: ~F.array_contains(names, h["name"]))
    return F.array_sort(F.concat(kept, allowed))


def _tag(value: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(value, "^W/", "")


def latest_before(events: DataFrame, key: str, order: list[str], is_full: str, value: str, out: str,
                  bucket: Column) -> DataFrame:
    """``events`` with ``out``: ``value`` of the last row before each one, by ``order``, with ``is_full``
    and the same ``key``. Buckets (which must follow the order) are summarised first, so a key with
    very many rows is ordered in parts and only its summaries meet."""
    events = events.withColumn("__bucket", bucket)
    full = F.when(F.col(is_full), F.struct(*order, F.col(value).alias("__v")))
    ends = events.where(is_full).groupBy(key, "__bucket").agg(F.max(F.struct(*order, F.col(value).alias("__v"))).alias("__end"))
    all_buckets = events.select(key, "__bucket").distinct().join(ends, [key, "__bucket"], "left")
    earlier = W.partitionBy(key).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = all_buckets.select(key, "__bucket", F.last("__end", ignorenulls=True).over(earlier).alias("__carried"))
    inside = W.partitionBy(key, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    seen = events.withColumn("__seen", F.last(full, ignorenulls=True).over(inside))
    joined = seen.join(carried, [key, "__bucket"])
    return joined.withColumn(out, F.coalesce("__seen", "__carried")["__v"]).drop("__bucket", "__seen", "__carried")


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS, permitted=PERMITTED) -> DataFrame:
    """One row per revisit: record_id, canonical, ts, response_id, status, headers (array of name,
    value).

    ``records`` has record_id (long), record_type ('response', 'revisit', others are ignored),
    target_uri, ts (long, seconds) and http_headers (a header block). Status: ``resolved``;
    ``no_url`` (no canonical URL or no time); ``no_response`` (nothing earlier; rows of the same ts
    count by record_id); ``no_validator`` (the two share neither ETag nor Last-Modified);
    ``mismatch``. ETags are compared weakly and go before dates. Headers are merged for resolved rows,
    else they are the revisit's own, by name. A response without ts or URL answers nothing; repeated
    rows stay repeated; extra columns are ignored; an empty table gives an empty result."""
    slim = records.where(F.col("record_type").isin("response", "revisit")).select(
        F.col("record_id").cast("long").alias("record_id"), "record_type", F.col("ts").cast("long").alias("ts"),
        canonical_url(F.col("target_uri")).alias("canonical"), header_list(F.col("http_headers")).alias("own"))
    usable = F.col("canonical").isNotNull() & F.col("ts").isNotNull()
    lost = slim.where(~usable & (F.col("record_type") == "revisit")).select(
        "record_id", "canonical", "ts", F.lit(None).cast("long").alias("response_id"),
        F.lit("no_url").alias("status"), F.array_sort("own").alias("headers"))

    events = slim.where(usable).select(
        "record_id", "ts", "canonical", "own", (F.col("record_type") == "response").alias("full"))
    events = events.withColumn("found", F.struct(F.col("record_id").alias("id"), F.col("own").alias("headers")))
    asof = latest_before(events, "canonical", ["ts", "record_id"], "full", "found", "before",
                         F.floor(F.col("ts") / bucket_seconds)).where(~F.col("full"))
    stored = F.col("before")["headers"]
    tags = _tag(header_value(F.col("own"), "etag")), _tag(header_value(stored, "etag"))
    dates = header_value(F.col("own"), "last-modified"), header_value(stored, "last-modified")
    status = (
        F.when(F.col("before").isNull(), "no_response")
        .when(tags[0].isNotNull() & tags[1].isNotNull(), F.when(tags[0] == tags[1], "resolved").otherwise("mismatch"))
        .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("mismatch"))
        .otherwise("no_validator")
    )
    done = asof.select(
        "record_id", "canonical", "ts", F.col("before")["id"].alias("response_id"), status.alias("status"),
        F.when(status == "resolved", merged_headers(stored, F.col("own"), permitted)).otherwise(F.array_sort("own")).alias("headers"))
    return done.unionByName(lost)
