"""Best-fit packing of tokenized documents into sequences of bounded length.

Lengths are between 1 and ``capacity``, so a plan needs only the number of pieces of each length: at
most ``capacity`` counts, whatever the size of the corpus. The plan is a list of patterns (lengths in
one sequence) with multiplicities. Pieces of one length are interchangeable: they are numbered, and a
piece's number decides, by ranges, which sequence of which pattern it joins.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from tokenizers import Tokenizer

from recordmill.session import cut_lineage

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
#: Words remembered by one worker process before the memo starts anew.
MEMO_WORDS = 600_000
#: Pieces that are numbered together, at most about.
NUMBERED_TOGETHER = 20_000
_CODERS: dict[str, Coder] = {}


class Coder:
    """Token ids of whole texts as bytes (little-endian unsigned 32-bit). The vocabulary's
    normalizer and its splitting never join across ASCII white space, so ids of a text are those of
    its words in turn, and each distinct word is encoded once while the memo lasts."""

    #: Letters of the Latin blocks, then ASCII marks: one split each, no contraction rule, and no
    #: composition that reaches the neighbour.
    SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?&*#%$|]*)")

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.memo_words = memo_words
        self.memo: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, at in vocabulary.items():
            self.ends[at] = token.endswith("</w>")

    def _learn(self, words: list[bytes]) -> None:
        memo, plain, others = self.memo, [], []
        for w in words:
            m = self.SIMPLE.fullmatch(w.decode())
            if m:
                plain.append((w, m[1].lower().encode(), m[2].encode()))
            else:
                others.append(w)
        marks = {mark for _, _, mark in plain if mark}
        others += [mark for mark in marks if mark not in memo and mark not in others]
        # Plain stems are encoded in one call; each of them ends in the only token with an end mark.
        stems = list({stem for _, stem, _ in plain if stem not in memo})
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(stems).decode()], add_special_tokens=False)[0].ids, "<u4")
        closed = (np.flatnonzero(self.ends[ids]) + 1).tolist() if len(ids) else []
        if len(closed) == len(stems):
            raw, at = ids.tobytes(), 0
            for stem, end in zip(stems, closed, strict=True):
                memo[stem] = raw[4 * at:4 * end]
                at = end
        else:
            others += stems
        if others:
            for w, e in zip(others, self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False), strict=True):
                memo[w] = np.array(e.ids, "<u4").tobytes()
        memo[b""] = b""
        for w, stem, mark in plain:
            memo[w] = memo[stem] + memo[mark]

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        memo = self.memo
        if len(memo) > self.memo_words:
            memo.clear()
        split = [t.split() for t in texts]
        found = [list(map(memo.get, words)) for words in split]
        new = {w for words, known in zip(split, found, strict=True) if None in known
               for w, k in zip(words, known, strict=True) if k is None}
        if new:
            self._learn(list(new))
        for words, known in zip(split, found, strict=True):
            yield b"".join([memo[w] if k is None else k for w, k in zip(words, known, strict=True)] if None in known else known)


def _coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def token_pieces(docs: DataFrame, id_col: str, text: str, capacity: int, vocabulary: str | None, end_id: int) -> DataFrame:
    """id, piece, start, length, ids_crc32: the ids of a text and ``end_id``, cut at ``capacity``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary or public_tokenizers.path(VOCABULARY))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts, rows, crcs, at = batch.column(1).cast(pa.binary()).to_pylist(), [], [], 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and size < 2_000_000:
                    size += len(texts[stop])
                    stop += 1
                for k, ids in enumerate(coder.ids(texts[at:stop]), at):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start:start + 4 * capacity]
                        rows.append((k, piece, start // 4, len(part) // 4))
                        crcs.append(zlib.crc32(part))
                at = stop
            made = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(made[:, 0])), pa.array(made[:, 1].astype(np.int32)), pa.array(made[:, 2]),
                 pa.array(made[:, 3]), pa.array(crcs, pa.int64())], [id_col, "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used. Lengths come in falling order. The gap that a length
    leaves is filled exactly by one, two or three lengths if sums of available ones match it; what
    is left goes best-fit: into the open sequences with the smallest gap that holds it. Uses of a
    pattern are taken together, so the work depends on the number of distinct lengths only."""
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left)
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...]) -> None:
        need = {n: pattern.count(n) for n in pattern}
        times = min(left[n] // k for n, k in need.items())
        for n, k in need.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
                order.pop(bisect_left(order, n))
        plan.append((pattern, times))

    def free(n: int, *used: int) -> bool:
        return left.get(n, 0) > used.count(n)

    def pair(first: int, gap: int, *used: int) -> tuple[int, int] | None:
        """Two available lengths that sum to ``gap``, the larger one as large as can be."""
        at = bisect_left(order, min(gap, first + 1))
        for i in range(at - 1, -1, -1):
            a = order[i]
            if 2 * a < gap:
                return None
            if free(a, *used) and free(gap - a, *used, a):
                return a, gap - a
        return None

    def exact(n: int) -> tuple[int, ...] | None:
        gap = capacity - n
        if gap == 0:
            return (n,)
        if gap in left and free(gap, n):
            return n, gap
        if found := pair(n, gap, n):
            return n, *found
        for i in range(bisect_left(order, min(gap, n + 1)) - 1, -1, -1):
            a = order[i]
            if 3 * a < gap:
                return None
            if free(a, n) and (found := pair(a, gap - a, n, a)):
                return n, a, *found
        return None

    rest: list[tuple[int, int]] = []
    while order:
        n = order[-1]
        if found := exact(n):
            take(found)
        else:
            rest.append((n, left.pop(n)))
            order.pop()
    open_gaps: list[int] = []
    open_at: dict[int, list[list]] = {}

    def leave(pattern: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(pattern)
        if gap not in open_at:
            open_at[gap] = []
            insort(open_gaps, gap)
        open_at[gap].append([pattern, times])

    for n, times in rest:
        while times:
            i = bisect_left(open_gaps, n)
            if i == len(open_gaps):
                several = min(capacity // n, times)
                leave((n,) * several, times // several)
                times %= several
                continue
            gap = open_gaps[i]
            pattern, have = open_at[gap][-1]
            several = min(gap // n, times)
            used = min(have, times // several)
            open_at[gap][-1][1] -= used
            if open_at[gap][-1][1] == 0:
                open_at[gap].pop()
                if not open_at[gap]:
                    del open_at[gap]
                    open_gaps.pop(i)
            leave(pattern + (n,) * several, used)
            times -= used * several
    plan += [(p, t) for group in open_at.values() for p, t in group]
    return plan


def slot_ranges(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, end number, first sequence, offset): the piece of that length with
    number r in the range lies in sequence first + r - first number, at that offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for n in pattern:
            r = used.get(n, 0)
            rows.append((n, r, r + times, sequence, offset))
            used[n] = r + times
            offset += n
        sequence += times
    return rows


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty
    text is its end id alone; repeated rows are packed each; an empty table gives an empty result;
    other columns are ignored.

    Pieces are written once. They are numbered inside (length, hash bucket) groups, which stay small
    however common a length is; counts per group give the offsets. The driver sees the counts per
    length and the plan."""
    spark = docs.sparkSession
    pieces = cut_lineage(token_pieces(docs, id_col, text, capacity, vocabulary, end_id)
                         .withColumn("__row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges = slot_ranges(plan_patterns(counts, capacity))
    buckets = 1 + sum(counts.values()) // NUMBERED_TOGETHER
    kind = "length long, lo long, hi long, sequence long, offset long"
    slots = spark.createDataFrame(ranges, kind)
    pieces = pieces.withColumn("__bucket", F.pmod(F.xxhash64("__row"), F.lit(buckets)))
    groups = pieces.groupBy("length", "__bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    groups = groups.select("length", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    # A number lies in one range of its length; ranges are keyed by length and the blocks they touch.
    numbered = (
        pieces.withColumn("__rank", F.row_number().over(W.partitionBy("length", "__bucket").orderBy("__row")) - 1)
        .join(groups, ["length", "__bucket"])
        .withColumn("__number", F.col("__rank") + F.col("__first"))
    )
    of_length = slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "sequence", "offset"))).alias("__slots"))
    slot = F.get(F.filter("__slots", lambda s: (s["lo"] <= F.col("__number")) & (F.col("__number") < s["hi"])), F.lit(0))
    placed = numbered.join(F.broadcast(of_length), "length").withColumn("__slot", slot)
    return placed.select(
        id_col, "piece", "start", "length", "ids_crc32",
        (F.col("__slot.sequence") + F.col("__number") - F.col("__slot.lo")).alias("sequence_id"),
        F.col("__slot.offset").alias("offset"))
