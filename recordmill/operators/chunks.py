"""Long texts cut into chunks, and partial results of chunks merged back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import chunk_starts, cut_chunks, paragraphs_of, word_count


def chunk_rows(
    df: DataFrame, key: str, text: str, max_words: int = 1500, separator: str = "\n\n"
) -> DataFrame:
    """``(key, pos, chunk)``, one row per chunk: whole paragraphs, packed greedily. A text that fits
    is one chunk."""
    parted = df.select(key, paragraphs_of(F.coalesce(text, F.lit("")), separator).alias("paragraphs"))
    placed = parted.withColumn(
        "starts",
        chunk_starts(F.transform("paragraphs", lambda p: word_count(p).cast("int")), max_words),
    )
    chunks = cut_chunks(F.col("paragraphs"), F.col("starts"), separator)
    return placed.select(key, F.posexplode(chunks).alias("pos", "chunk"))


def merge_partials(
    df: DataFrame, key: str, pos: str, texts: list[str], lists: list[str], others: list[str]
) -> DataFrame:
    """One record per key from the partial results of its chunks, in chunk order.

    Texts: the longest, the earliest of equals. Other values: the first that is not null. Both are
    plain aggregates. Lists: the first non-empty one as it is, then whatever later lists add. List
    items are reduced to their first place per key before they are gathered, so an array only ever
    receives what is part of the result."""
    place = F.col(pos)
    scalars = df.groupBy(key).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(F.length(c), -place))).alias(c)
            for c in texts
        ],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in others],
    )
    for c in lists:
        base = df.groupBy(key).agg(F.min(F.when(F.size(c) > 0, place)).alias("_base"))
        items = df.select(key, place.alias("_pos"), F.posexplode(c).alias("_at", "item"))
        first = items.groupBy(key, "item").agg(F.min(F.struct("_pos", "_at")).alias("at"))
        repeats = (
            items.join(base, key)
            .filter(F.col("_pos") == F.col("_base"))
            .select(key, "item", F.struct("_pos", "_at").alias("at"))
        )
        placed = first.unionByName(repeats).distinct()
        merged = placed.groupBy(key).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias(c)
        )
        empty = F.array().cast(df.schema[c].dataType)
        scalars = scalars.join(merged, key, "left").withColumn(c, F.coalesce(c, empty))
    return scalars.select(key, *texts, *lists, *others)
