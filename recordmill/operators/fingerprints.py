"""SimHash fingerprints and near-duplicate search.

A fingerprint is made inside its row: the hashes of the words are added up bit by bit in vertical
counters.

Near-duplicates are searched among *distinct* fingerprints: exact copies, however many, weigh as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.fixed_values import WORD
from recordmill.functions.text import hamming64
from recordmill.operators.components import components, spanning_links
from recordmill.session import cut_lineage, shuffled

#: Words whose hashes a worker process remembers before it starts anew.
MEMO_WORDS = 500_000


def _word_hash(word: str) -> int:
    """The low 64 bits of the MD5 of a word."""
    return int.from_bytes(hashlib.md5(word.encode(), usedforsecurity=False).digest()[8:], "big")


def bit_votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits. Counters stand vertically, one word per binary
    digit for all 64 bits: carry-save adders take three words of a digit to one and a carry of the next,
    until two at most are left of each."""
    votes, weight = np.zeros(64, np.int64), 1
    while len(hashes):
        carries = []
        while len(hashes) > 2:
            third = len(hashes) // 3
            a, b, c, rest = hashes[:third], hashes[third:2 * third], hashes[2 * third:3 * third], hashes[3 * third:]
            carries.append(a & b | c & (a ^ b))
            hashes = np.concatenate([a ^ b ^ c, rest])
        bits = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little")
        votes += weight * bits.sum(axis=0, dtype=np.int64)
        hashes, weight = np.concatenate([np.zeros(0, np.uint64), *carries]), 2 * weight
    return votes


def simhash64(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, simhash)``; a bit is set when at least half of the words have it, 0 for no words.

    Words are cut and lowered in the JVM; their hashes are added up inside the row, so nothing is
    exploded or shuffled, and a text of any length takes one number per word."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"{WORD}+"), F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for batch in batches:
            prints = []
            for words in (t.split(" ") if t else [] for t in batch.column(1).to_pylist()):
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                memo.update((w, _word_hash(w)) for w in set(words).difference(memo))
                hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
                bits = 2 * bit_votes(hashes) >= len(words) if words else np.zeros(64, bool)
                prints.append(np.packbits(bits, bitorder="little").view(np.int64)[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], [key, "simhash"])

    kind = dict(df.dtypes)[key]
    return df.select(key, F.array_join(tokens, " ").alias("_words")).mapInArrow(run, f"`{key}` {kind}, simhash bigint")


def _block_masks(distance: int, extra: int) -> list[int]:
    """Bit masks such that two fingerprints within ``distance`` agree under at least one.

    The 64 bits are cut into ``distance + extra`` blocks. Differences touch at most ``distance``
    blocks, so some choice of ``extra`` blocks is equal in both. More blocks mean more masks, but
    far fewer chance meetings: with ``extra=3`` a mask fixes about 32 bits."""
    count = distance + extra
    edges = [round(i * 64 / count) for i in range(count + 1)]
    masks = []
    for chosen in combinations(range(count), extra):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return masks


def _masked(c: Column, mask: int) -> Column:
    return c.bitwiseAND(F.lit(mask).cast("bigint"))


def near_fingerprints(
    prints: DataFrame, distance: int = 3, extra: int = 3, crowd: int = 2000,
    place: str | None = None, width: int = 0,
) -> DataFrame:
    """Unordered pairs of distinct fingerprints at most ``distance`` bits apart. With ``place``, a
    number, only pairs are looked for that occur at the same place or ``width`` apart.

    Keys held by a single fingerprint, nearly all of them, are dropped before the join. A key shared
    by more than ``crowd`` fingerprints is spread over as many tasks as it fills, each taking its
    part of one side against the whole other side, so no task gets a crowded key alone.

    The distance test is part of the join condition: candidates that fail it are never materialised.
    A pair is reported only under the first key the two share, so without places nothing has to be
    made distinct afterwards. A fingerprint has at most 43,744 others within 3 bits, which bounds the
    result."""
    columns = ["simhash", *([place] if place else [])]
    distinct = cut_lineage(prints.select(*columns).distinct(), "fingerprints")
    masks = _block_masks(distance, extra)
    keys = F.array(*[_masked(F.col("simhash"), m) for m in masks])
    keyed = distinct.select(*columns, F.posexplode(keys).alias("choice", "bits"))
    home = F.col(place) if place else F.lit(0)
    spots = F.array(home, home + F.lit(width)) if place else F.array(home)
    met = keyed.withColumn("meets", F.explode(spots)).withColumn("home", home == F.col("meets"))
    key = ["choice", "bits", "meets"]
    shared_keys = met.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    live = cut_lineage(
        met.join(shuffled(shared_keys), key).withColumn("tasks", F.ceil(F.col("n") / crowd).cast("int")),
        "fingerprint-keys",
    )
    left = live.filter("home").select(
        F.col("simhash").alias("a"), *key,
        F.pmod(F.xxhash64("simhash"), F.col("tasks")).cast("int").alias("salt"),
    )
    right = live.select(
        F.col("simhash").alias("b"), *key,
        F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"),
    )
    differing = left.a.bitwiseXOR(right.b)
    first = F.coalesce(*[
        F.when(_masked(differing, m) == 0, F.lit(n)) for n, m in enumerate(masks)
    ])
    pairs = left.join(
        shuffled(right),
        (left.choice == right.choice)
        & (left.bits == right.bits)
        & (left.meets == right.meets)
        & (left.salt == right.salt)
        & ((left.a != right.b) if place else (left.a < right.b))
        & (F.bit_count(differing) <= distance)
        & (left.choice == first),
    )
    if place:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.select("a", "b", hamming64(F.col("a"), F.col("b")).alias("distance"))


#: Fingerprints of one key that are compared in one task.
TILE = 512


def _close(rows: pd.DataFrame, distance: int) -> np.ndarray:
    prints = rows["id"].to_numpy().view(np.uint64)  # the bits of a negative number are those of its absolute value
    return np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance


def near_links(prints: DataFrame, distance: int = 3, blocks: int = 6, tile: int = TILE) -> DataFrame:
    """Links (a, b) between fingerprints (column simhash) that join all that chains of fingerprints at most
    ``distance`` bits apart join. Fingerprints meet under keys of ``blocks - distance`` whole blocks of
    bits; close ones share a key. Where a key is crowded and its members are not all alike, the bits that
    the key leaves open are cut finer: of ``2 * distance`` pieces at least ``distance`` agree."""
    masks = _block_masks(distance, blocks - distance)
    distinct = cut_lineage(prints.select("simhash").filter("simhash IS NOT NULL").distinct(), "fingerprints")
    simhash = F.col("simhash")
    keyed = distinct.select(simhash.alias("id"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), _masked(simhash, m).alias("bits")) for i, m in enumerate(masks)])).alias("k"))
    keyed = keyed.select(F.xxhash64("k.mask", "k.bits").alias("key"), "id", "k.mask")
    finer = F.lit(None).cast("array<bigint>")
    for i, m in enumerate(masks):
        subs = [F.xxhash64(F.lit(j), _masked(F.col("id"), sub)) for j, sub in enumerate(_finer_masks(m, distance))]
        finer = F.when(F.col("mask") == i, F.array(*subs)).otherwise(finer)
    return spanning_links(keyed, lambda rows: _close(rows, distance), tile, refine=lambda rows: rows.withColumn("finer", finer))


def _finer_masks(mask: int, distance: int) -> list[int]:
    """Choices of half of ``2 * distance`` pieces of the bits outside ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    count = 2 * distance
    pieces = [sum(1 << b for b in free[i * len(free) // count:(i + 1) * len(free) // count]) for i in range(count)]
    chosen = [sum(c) for c in combinations(pieces, distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def near_duplicates(prints: DataFrame, distance: int = 3, tile: int = TILE) -> DataFrame:
    """``(fingerprint, cluster, docs)``: every distinct fingerprint with the smallest fingerprint that
    chains of close ones reach, and the number of documents behind it. Copies are counted, never paired,
    and a cluster is given by membership, so the result has one row per distinct fingerprint."""
    groups = cut_lineage(prints.groupBy("simhash").agg(F.count(F.lit(1)).alias("docs")), "fingerprint-docs")
    found = components(near_links(groups, distance, tile=tile))
    return groups.join(shuffled(found), F.col("simhash") == F.col("id"), "left").select(
        F.col("simhash").alias("fingerprint"), F.coalesce("component", "simhash").alias("cluster"), "docs")


def near_dup_window(
    prints: DataFrame, key: str, ts: str, days: int = 7, distance: int = 3
) -> DataFrame:
    """Each row flagged when an earlier row (by time, then key) at most ``days`` older has a
    fingerprint within ``distance``.

    Time is cut into buckets as long as the window. An earlier row in the same bucket is always
    close enough; otherwise only the latest row of the bucket before matters. So per fingerprint
    and bucket the first and the last moment are all that is kept, and rows never meet pairwise."""
    width = days * 86_400_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = prints.select(
        key, "simhash", micros.alias("t"), (micros - F.pmod(micros, F.lit(width))).alias("bucket")
    )
    spans = rows.groupBy("simhash", "bucket").agg(
        F.min(F.struct("t", key)).alias("first"), F.max("t").alias("last")
    )
    close = near_fingerprints(rows, distance, place="bucket", width=width)
    reach = (
        close.select("a", "b")
        .unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .unionByName(spans.select(F.col("simhash").alias("a"), F.col("simhash").alias("b")).distinct())
    )
    around = (
        reach.join(shuffled(spans.withColumnRenamed("simhash", "b")), "b")
        .groupBy(F.col("a").alias("simhash"), "bucket")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    here = around.select("simhash", "bucket", "first")
    before = around.select("simhash", (F.col("bucket") + width).alias("bucket"), "last")
    flagged = rows.join(shuffled(here), ["simhash", "bucket"], "left").join(
        shuffled(before), ["simhash", "bucket"], "left"
    )
    earlier_here = F.col("first") < F.struct("t", key)
    earlier_before = F.col("last") >= F.col("t") - width
    return flagged.select(
        key, "simhash",
        (F.coalesce(earlier_here, F.lit(False)) | F.coalesce(earlier_before, F.lit(False))).alias(
            "is_duplicate"
        ),
    )
