"""Positions, samples and top rows without single-task windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.session import cut_lineage

from recordmill.operators.dedup import pick_by


def positions(df: DataFrame, strata: list[str], seq: str, parts: int | None = None) -> DataFrame:
    """Adds ``position`` (1-based, by ``seq``, which is unique) and ``stratum_rows``.

    Rows are dealt into ranges of (stratum, seq) of about equal size, by a sample of the data, and
    written once, so that ranges stay as they are. They are ranked inside ranges only; counts per
    range and stratum, a small table, give the offsets. A stratum with a third of all rows fills many
    ranges, and sparse or hashed numbers are as good as dense ones."""
    by = [*strata, seq]
    dealt = df.repartitionByRange(*by) if parts is None else df.repartitionByRange(parts, *by)
    ranged = cut_lineage(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(*strata, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*strata).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*strata)
    offsets = counts.select(
        *strata, "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("stratum_rows"),
    )
    inside = Window.partitionBy(*strata, "_range").orderBy(seq)
    ranked = ranged.withColumn("_rank", F.row_number().over(inside))
    return (
        ranked.join(offsets, [*strata, "_range"])
        .withColumn("position", F.col("_before") + F.col("_rank"))
        .drop("_range", "_rank", "_before")
    )


def systematic_sample(
    df: DataFrame, strata: list[str], seq: str, size: int = 50, parts: int | None = None
) -> DataFrame:
    """Evenly spaced rows of each stratum: every ``rows div size``-th, the first ``size`` of them."""
    placed = positions(df, strata, seq, parts)
    whole = F.col("stratum_rows") - F.pmod(F.col("stratum_rows"), F.lit(size))
    step = F.greatest(F.lit(1), (whole / size).cast("bigint"))
    zero = F.col("position") - 1
    return placed.filter((zero % step == 0) & (zero < step * size)).drop("stratum_rows")


def discover_slice(df: DataFrame, order: list[Column], rows: int, offset: int = 0) -> DataFrame:
    """A page of an ordered listing; only ``offset + rows`` rows leave each partition."""
    return df.orderBy(*order).offset(offset).limit(rows)


def first_per_url(df: DataFrame, url: str, order: list[str]) -> DataFrame:
    """Each URL once, at its first place in the order."""
    return df.groupBy(url).agg(F.min(F.struct(*order)).alias("place")).select(url, "place.*")


def multi_facet_discovery(listings: DataFrame, rows: int) -> DataFrame:
    """Listings of several facets read one after the other, repeats dropped, stopped at ``rows``."""
    return first_per_url(listings, "url", ["facet", "pos"]).orderBy("facet", "pos").limit(rows)


def first_source_wins(listings: DataFrame) -> DataFrame:
    """A URL belongs to the source with the lowest priority number that lists it."""
    return pick_by(listings.select("url", "source_name", "priority"), ["url"], "priority", newest=False).drop("priority")


def sample_head(df: DataFrame, order: list[Column], rows: int) -> DataFrame:
    """The first rows in an order; each partition sends on only its own first ones."""
    return df.orderBy(*order).limit(rows)
