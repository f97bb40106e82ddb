"""Benchmark decontamination: containment of short test items in long documents.

Similarity of whole documents to an item of forty shingles is near zero, so the search is one-sided.
Items are partitioned by size; an item's sketch holds its smallest shingle hashes, as many as a text
must share at least one of if it holds the required share of the item: ``floor((1 - t) · u) + 1`` for
the upper size ``u`` of the partition. All shingle hashes of a document are looked up in the sketches,
so no item is missed. Candidates are verified by exact containment of their shingles as strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import let, words
from recordmill.session import join_side

SHINGLE = 5
CONTAINMENT = 0.8
#: Upper sizes of the partitions of items, in shingles; each is twice the one before.
SIZES = tuple(1 << k for k in range(31))


def shingles(w: Column, size: int) -> Column:
    """Distinct shingles of a word array, as strings; fewer words: the whole sequence; none: none."""
    return let(w, lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0))),
        lambda i: F.array_join(F.slice(w, i + 1, size), " ")))))


def shingle_hashes(w: Column, size: int) -> Column:
    """Hashes of the shingles, with repeats. The hash of a shorter sequence also takes its length."""
    return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(
        F.size(w) < size, F.array(F.xxhash64(F.array_join(w, " "), F.size(w)))).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(w) - size),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size)))))


def _normal(text: Column) -> Column:
    return words(F.lower(F.coalesce(text, F.lit(""))))


def item_sketches(items: DataFrame, item_id: str, text: str, size: int, containment: float) -> DataFrame:
    """item, h: the sketch of every item with a word."""
    hashed = items.select(F.col(item_id).alias("item"), F.array_sort(F.array_distinct(let(
        _normal(F.col(text)), lambda w: shingle_hashes(w, size)))).alias("hs"))
    upper = F.lit(SIZES[-1])
    for s in reversed(SIZES[:-1]):
        upper = F.when(F.size("hs") <= s, F.lit(s)).otherwise(upper)
    keep = F.floor(upper * F.lit(round(1 - containment, 9)) + 1e-6).cast("int") + 1
    return hashed.select("item", F.explode(F.slice("hs", F.lit(1), keep)).alias("h"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", size: int = SHINGLE,
                    containment: float = CONTAINMENT) -> DataFrame:
    """One row per document id and item of which the document holds at least ``containment`` of the
    distinct shingles: id, item_id, n_item, n_shared, containment. Words are compared in
    lower case. Texts with fewer than ``size`` words are one shingle, found only in equal texts.
    Null and empty texts and items match nothing; a repeated row gives its matches once; other
    columns are ignored; an empty table gives an empty result."""
    sketches = join_side(item_sketches(items, item_id, item_text, size, containment), "sketches")
    hashed = docs.select(F.col(id_col).alias("doc"), F.explode(let(_normal(F.col(text)), lambda w: shingle_hashes(w, size))).alias("h"))
    candidates = join_side(hashed.join(sketches, "h").select("doc", "item").distinct(), "candidates")

    wanted = join_side(items.select(
        F.col(item_id).alias("item"), shingles(_normal(F.col(item_text)), size).alias("want")), "items")
    held = (
        docs.select(F.col(id_col).alias("doc"), F.col(text).alias("t")).join(candidates, "doc").join(wanted, "item")
        .select("doc", "item", F.size("want").alias("n_item"),
                F.size(F.array_intersect("want", shingles(_normal(F.col("t")), size))).alias("n_shared"))
    )
    share = F.col("n_shared") / F.col("n_item")
    return held.where(F.col("n_shared") >= F.col("n_item") * F.lit(containment) - 1e-9).select(
        F.col("doc").alias(id_col), F.col("item").alias(item_id), F.col("n_item").cast("long"),
        F.col("n_shared").cast("long"), F.round(share, 9).alias("containment")).distinct()


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", size: int = SHINGLE,
                      containment: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their own columns only."""
    bad = contained_items(docs, items, id_col, text, item_id, item_text, size, containment).select(id_col).distinct()
    return docs.join(join_side(bad, "contaminated"), id_col, "left_anti")
