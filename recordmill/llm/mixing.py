"""Scores of texts by online logistic context mixing.

A text is read byte by byte. A byte is replaced by its rank among the bytes that follow the two before
it in the training corpus, and a rank is the path to its leaf in a code tree, so every step is one
binary decision and most bytes take few. Several predictors look the decision up under hashed contexts of the bytes before it;
their log-odds come from counts over the whole training corpus. A mixer adds them up with weights chosen
by a gate, squashes the sum to a probability, and moves the weights along the coding error; a last stage
refines the probability adaptively by how such probabilities came true in this text. Weights and
refinement start alike for every text and move once per block of decisions, so texts are independent of
each other and many are scored side by side in numpy.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.session import cut_lineage

#: Bytes of context per predictor, and the bits of each table of hashed (context, symbol) slots.
ORDERS = (2, 3, 5)
SLOT_BITS = 24
#: Decisions per block, texts scored side by side and their bytes, and bytes looked up at a time.
BLOCK = 256
LANES = 128
SCORED_BYTES = 6 << 20
RECORD_BYTES = 1 << 16
#: Bytes of text whose slots are counted at a time, which with the counts of all slots bounds memory.
COUNTED_BYTES = 3 << 20
#: Most frequent tokens whose counts are broadcast; all others meet their counts in a join.
FREQUENT = 1 << 16
GATES, BUCKETS, RATE, REFINE = 4, 24, 0.002, 0.02
END = 0
#: Log-odds are kept in one byte, in steps of 1/16.
STEP = 16.0
_END_HASH = xxhash.xxh64_intdigest(b"\n", 42)
_LOADED: dict[int, tuple] = {}


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def contexts(stream: np.ndarray, orders=ORDERS, bits: int = SLOT_BITS) -> Iterator[np.ndarray]:
    """For each order, rising and one at a time, the slot of symbol 0 under the context of every byte; the symbol or
    node is added to it. ``stream`` has zeros before each text, as many as the longest order. The hash
    of a longer context goes on from that of a shorter one."""
    pad = max(orders)
    s = stream.astype(np.uint32)
    s += np.uint32(1)
    h = np.zeros(len(s) - pad, np.uint32)
    keep = np.uint32((1 << (bits - 8)) - 1)
    for k in range(1, pad + 1):
        h += s[pad - k:len(s) - k]
        h *= np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if k in orders:
            slots = h & keep
            slots <<= np.uint32(8)
            yield slots
            del slots


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with an end byte each, zeros between them, and where their bytes are."""
    pad = max(ORDERS)
    data = np.frombuffer(bytes(pad) + bytes(pad).join(t + bytes([END]) for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    first = np.cumsum(np.append(0, lengths[:-1] + pad))
    own = np.ones(len(data) - pad, bool)
    for f, n in zip(first[:-1], lengths[:-1], strict=True):
        own[f + n:f + n + pad] = False
    return data, own


def _rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
        ["kind", "key", "n"])


def _counted(kind: int, slots: np.ndarray) -> pa.RecordBatch:
    counts = np.bincount(slots, minlength=1)
    seen = np.flatnonzero(counts)
    return _rows(kind, seen, counts[seen])


def _parts(texts: list[bytes], size: int) -> Iterator[list[bytes]]:
    """Texts in groups of about ``size`` bytes."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and held < size:
            held += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def _followers(stream: np.ndarray) -> np.ndarray:
    """For every byte, the two bytes before it and itself as one number."""
    s, pad = stream.astype(np.uint32), max(ORDERS)
    return s[pad - 2:-2] << np.uint32(16) | s[pad - 1:-1] << np.uint32(8) | s[pad:]


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of tokens (kind 0, by the token's hash) and of bytes after two bytes (kind 1)."""
    for batch in batches:
        texts = [t.lower() for t in batch.column(0).cast(pa.binary()).to_pylist()]
        seen: Counter[bytes] = Counter()
        for t in texts:
            seen.update(t.split())
        hashes = np.array([signed(xxhash.xxh64_intdigest(w, 42)) for w in seen] + [signed(_END_HASH)], np.int64)
        yield _rows(0, hashes, np.array([*seen.values(), len(texts)]))
        del seen
        for part in _parts(texts, COUNTED_BYTES):
            data, own = _stream(part)
            yield _counted(1, _followers(data)[own])


def _slot_rows(batches: Iterator[pa.RecordBatch], ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of (hashed context, rank) slots, one kind per order."""
    for batch in batches:
        texts = [t.lower() for t in batch.column(0).cast(pa.binary()).to_pylist()]
        for part in _parts(texts, COUNTED_BYTES):
            data, own = _stream(part)
            rank = ranks[_followers(data)[own]]
            for i, base in enumerate(contexts(data)):
                slots = base[own]
                del base
                slots += rank
                yield _counted(i, slots)


class Tree:
    """A prefix code of the 256 ranks, from their counts."""

    def __init__(self, counts: np.ndarray) -> None:
        heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        parent, turn, made = {}, {}, 256
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for side, x in enumerate((a, b)):
                parent[x[2]], turn[x[2]] = made, side
            heapq.heappush(heap, (a[0] + b[0], made, made))
            made += 1
        paths = []
        for symbol in range(256):
            path, x = [], symbol
            while x in parent:
                path.append((parent[x] - 256, turn[x]))
                x = parent[x]
            paths.append(path[::-1])
        self.lengths = np.array([len(p) for p in paths])
        self.starts = np.append(0, np.cumsum(self.lengths[:-1]))
        flat = [step for p in paths for step in p]
        self.nodes = np.array([n for n, _ in flat], np.int64)
        self.turns = np.array([t for _, t in flat], np.uint8)
        #: (symbols, nodes): whether a symbol passes a node, and whether it turns right there.
        self.passes, self.rights = np.zeros((256, 256), np.float32), np.zeros((256, 256), np.float32)
        for symbol, path in enumerate(paths):
            for node, side in path:
                self.passes[symbol, node] = 1
                self.rights[symbol, node] = side


def odds(counts: np.ndarray, tree: Tree) -> np.ndarray:
    """Counts of (contexts, symbols) to log-odds of (contexts, nodes) in steps of 1/STEP; zero where
    a context was never seen."""
    out = np.zeros(counts.shape, np.int8)
    seen, used = np.flatnonzero(counts.any(axis=1)), np.flatnonzero(counts.any(axis=0))
    dense = counts[np.ix_(seen, used)].astype(np.float32)
    n, right = dense @ tree.passes[used], dense @ tree.rights[used]
    p = (right + np.float32(0.4)) / (n + np.float32(0.8))
    out[seen] = np.where(n > 0, np.clip(np.rint(np.log(p / (1 - p)) * STEP), -127, 127), 0)
    return out


def _by_block(counts: DataFrame, kinds, build) -> Iterator:
    """``build`` over the counts of each block of 256 contexts: (kind, block, packed bytes, sums). What
    reaches the driver is bounded by SLOT_BITS, whatever the corpus."""
    per_block = 1 << 16

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros(per_block, np.float32)
        dense[frame["key"].to_numpy() % per_block] = frame["n"].to_numpy()
        packed, sums = build(dense.reshape(-1, 256))
        return pd.DataFrame({"kind": [frame["kind"].iloc[0]], "block": [frame["block"].iloc[0]],
                             "packed": [zlib.compress(packed.tobytes(), 1)], "sums": [sums]})

    return counts.where(kinds).withColumn("block", F.shiftright("key", 16)).groupBy("kind", "block").applyInPandas(
        run, "kind int, block long, packed binary, sums array<double>").toLocalIterator()


def _ranked(counts: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Rank of every byte in its context (most frequent first, then by value), and counts of ranks."""
    order = np.argsort(-counts, axis=1, kind="stable")
    ranks = np.empty(order.shape, np.uint8)
    np.put_along_axis(ranks, order, np.arange(256, dtype=np.uint8)[None, :], axis=1)
    return ranks, np.take_along_axis(counts, order, axis=1).sum(axis=0, dtype=np.float64).tolist()


def unpacked_ranks(blocks: dict[int, bytes]) -> np.ndarray:
    table = np.tile(np.arange(256, dtype=np.uint8), 1 << 16)
    for block, data in blocks.items():
        table[block << 16:(block + 1) << 16] = np.frombuffer(zlib.decompress(data), np.uint8)
    return table


def unpacked(packed: dict[int, dict[int, bytes]]) -> list[np.ndarray]:
    out = []
    for i in range(len(ORDERS)):
        table = np.zeros(1 << SLOT_BITS, np.int8)
        for block, data in packed.get(i, {}).items():
            table[block << 16:(block + 1) << 16] = np.frombuffer(zlib.decompress(data), np.int8)
        out.append(table)
    return out


class Lanes:
    """State of the mixer and the refinement of several texts."""

    def __init__(self, n: int) -> None:
        first = np.append(np.linspace(0.2, 0.5, len(ORDERS)), 0) / STEP
        self.weights = np.tile(first.astype(np.float32), (n, GATES, 1))
        middle = (np.arange(BUCKETS + 1, dtype=np.float32) + 0.5) / BUCKETS * 16 - 8
        self.refined = np.tile(1 / (1 + np.exp(-middle)), (n, 1)).astype(np.float32)
        self.gate = np.zeros(n, np.int64)
        self.bits = np.zeros(n)


_IN_BLOCK = np.arange(BLOCK)
_SCALE, _RATE = np.float32(BUCKETS / 16), np.float32(RATE / STEP / STEP)


def _mix(lanes: Lanes, records: np.ndarray, at: np.ndarray, left: np.ndarray) -> None:
    """Codes the block of decisions that begins at ``at`` in the records of lanes 0 … n-1, of which
    ``left`` are left, and adapts. A record holds the log-odds of every order and the turn taken."""
    n = len(at)
    rows = np.arange(n)
    where = at[:, None] + _IN_BLOCK
    ragged = left[-1] < BLOCK  # lanes come longest first
    if ragged:
        ok = _IN_BLOCK < left[:, None]
        where = np.where(ok, where, len(records) - 1)
    x = records[where].view(np.int8).reshape(n, BLOCK, len(ORDERS) + 1).astype(np.float32)
    gate = lanes.gate[:n]
    dot = np.matmul(x, lanes.weights[rows, gate][:, :, None])[..., 0]
    np.clip(dot, -7.99, 7.99, out=dot)
    bucket = ((dot + np.float32(8)) * _SCALE).astype(np.int64)
    if ragged:
        bucket[~ok] = BUCKETS
    np.negative(dot, out=dot)
    np.exp(dot, out=dot)
    dot += 1
    np.reciprocal(dot, out=dot)
    y = x[..., -1]
    bucket += rows[:, None] * (BUCKETS + 1)
    table = lanes.refined[:n]
    p = table.ravel()[bucket]
    p += dot
    p *= np.float32(0.5)
    # The probability of the turn that was taken: p if it is 1, else 1 - p.
    np.subtract(1 - y, p, out=p)
    np.abs(p, out=p)
    np.log2(p, out=p)
    cost = -(p * ok if ragged else p).sum(axis=1, dtype=np.float64)
    lanes.bits[:n] += cost
    error = y - dot
    step = np.matmul(error[:, None, :], x)[:, 0]
    step[:, -1] = 0
    lanes.weights[rows, gate] += _RATE * step
    bucket *= 2
    bucket += y.astype(np.int64)
    hits = np.bincount(bucket.ravel(), minlength=2 * n * (BUCKETS + 1)).reshape(n, BUCKETS + 1, 2)
    total = hits.sum(axis=2)
    pull = (1 - np.power(1 - REFINE, total)) / np.maximum(total, 1)
    table += (pull * (hits[..., 1] - total * table)).astype(np.float32)
    np.clip(table, 0.001, 0.999, out=table)
    rate = cost / np.minimum(left, BLOCK)
    lanes.gate[:n] = np.minimum((rate * GATES).astype(np.int64), GATES - 1)


def _records(texts: list[bytes], before: bytes, ranks: np.ndarray, tree: Tree, table: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The decisions of all texts, one after the other, as log-odds of every order and the turn; and
    how many each text has. ``before`` goes before the first text."""
    pad = max(ORDERS)
    gap = bytes(pad)
    data = np.frombuffer((gap + before)[-pad:] + gap.join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1]) + np.repeat(np.arange(len(texts)) * pad, lengths)
    symbols = ranks[_followers(data)[at].astype(np.int64)]
    steps = tree.lengths[symbols]
    stop = np.cumsum(steps)
    rep = np.repeat(np.arange(len(symbols)), steps)
    code = np.arange(stop[-1]) + (tree.starts[symbols] - (stop - steps))[rep]
    node = tree.nodes[code]
    records = np.empty((len(code), len(ORDERS) + 1), np.int8)
    records[:, -1] = tree.turns[code]
    for i, base in enumerate(contexts(data)):
        records[:, i] = table[i][base[at].astype(np.int64)[rep] + node]
    last = stop[ends - 1]
    return records, np.diff(last, prepend=0)


def _run(lanes: Lanes, texts: list[bytes], before: bytes, ranks: np.ndarray, tree: Tree, table: list[np.ndarray]) -> None:
    """Codes texts (whole, or the next part of a single long one after ``before``), one per lane."""
    made, sizes = [], []
    for part in _parts(texts, RECORD_BYTES):
        records, size = _records(part, before, ranks, tree, table)
        made.append(records)
        sizes.append(size)
    made.append(np.zeros((1, len(ORDERS) + 1), np.int8))
    records, size = np.concatenate(made), np.concatenate(sizes)
    del made
    packed = records.view(np.uint32 if records.shape[1] == 4 else f"V{records.shape[1]}").ravel()
    first = np.cumsum(size) - size
    by_size = np.argsort(-size, kind="stable")
    first, size = first[by_size], size[by_size]
    for k in range(0, int(size[0]), BLOCK):
        n = int(np.searchsorted(-size, -k, "left"))
        _mix(lanes, packed, first[:n] + k, size[:n] - k)
    lanes.bits = lanes.bits[np.argsort(by_size)]


def bits_of(texts: list[bytes], ranks: np.ndarray, tree: Tree, table: list[np.ndarray]) -> np.ndarray:
    """Total bits of each text with its end."""
    texts = [t + bytes([END]) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    out = np.zeros(len(texts))
    at = 0
    while at < len(order):
        if len(texts[order[at]]) > SCORED_BYTES:
            lanes, t = Lanes(1), texts[order[at]]
            for part in range(0, len(t), SCORED_BYTES):
                _run(lanes, [t[part:part + SCORED_BYTES]], t[max(0, part - max(ORDERS)):part], ranks, tree, table)
            out[order[at]] = lanes.bits[0]
            at += 1
            continue
        end, size = at, 0
        while end < len(order) and end - at < LANES and size + len(texts[order[end]]) <= SCORED_BYTES:
            size += len(texts[order[end]])
            end += 1
        lanes = Lanes(end - at)
        _run(lanes, [texts[i] for i in order[at:end]], b"", ranks, tree, table)
        out[order[at:end]] = lanes.bits
        at = end
    return out


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score (log10
    probability of the text by the mixed model), n_bytes, bits_per_byte (the end counts as a byte).

    The model learns from the rows where ``training`` holds. Null texts count as empty: one token, the
    end. With no training rows base_score is that of the empty vocabulary and no token is known.
    Repeated rows stay repeated and are learned each time; other columns are ignored.

    Counts are combined per batch before the shuffle. The FREQUENT most common tokens, a bounded
    table, are resolved while texts are read; the others are joined to their counts, so no frequent
    token makes a crowded key."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("__text"), training.alias("__learn"))
    learned = plain.where("__learn").select("__text")
    counted = learned.mapInArrow(_token_rows, "kind int, key long, n long")
    counts = cut_lineage(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    tokens = counts.where("kind = 0").select("key", "n")
    total, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = sorted((r["key"], r["n"]) for r in tokens.orderBy(F.desc("n"), "key").limit(FREQUENT).collect())
    rank_blocks, rank_counts = {}, np.zeros(256)
    for r in _by_block(counts, F.col("kind") == 1, _ranked):
        rank_blocks[r["block"]] = bytes(r["packed"])
        rank_counts += np.array(r["sums"])
    tree = Tree(rank_counts)
    ranked = spark.sparkContext.broadcast(rank_blocks)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _slot_rows(batches, unpacked_ranks(ranked.value))

    slot_counts = learned.mapInArrow(slots, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    packed: dict[int, dict[int, bytes]] = {}
    for r in _by_block(slot_counts, F.lit(True), lambda dense: (odds(dense, tree), [])):
        packed.setdefault(r["kind"], {})[r["block"]] = bytes(r["packed"])
    scale = total + distinct + 1
    # Where nothing was learned, a key that no token has keeps the table from being empty.
    common = np.array([k for k, _ in top] or [1 << 62], np.int64)
    common_log = np.log10(np.array([n for _, n in top] or [0], np.float64) + 1) - np.log10(scale)
    shared = spark.sparkContext.broadcast((common, common_log, rank_blocks, tree, packed))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = shared.id if hasattr(shared, "id") else id(shared)
        if key not in _LOADED:
            _LOADED.clear()
            common, common_log, rank_blocks, tree, packed = shared.value
            _LOADED[key] = (common, common_log, unpacked_ranks(rank_blocks), tree, unpacked(packed), {})
        common, common_log, ranks, tree, table, hashes = _LOADED[key]
        end, last = signed(_END_HASH), len(common) - 1
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            texts = [t.lower() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            bits = bits_of(texts, ranks, tree, table)
            known, sums, n_tokens, rare_keys, rare_n = [], [], [], [], []
            if len(hashes) > 500_000:
                hashes.clear()
            for t in texts:
                seen = Counter(t.split())
                own = [end]
                for w in seen:
                    h = hashes.get(w)
                    if h is None:
                        hashes[w] = h = signed(digest(w, 42))
                    own.append(h)
                times = np.array([1, *seen.values()])
                own = np.array(own, np.int64)
                at = np.minimum(np.searchsorted(common, own), last)
                hit = common[at] == own
                n_tokens.append(int(times.sum()))
                known.append(int(times[hit].sum()))
                sums.append(float(times[hit] @ common_log[at[hit]]))
                rare_keys.append(own[~hit])
                rare_n.append(times[~hit].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(bits, pa.float64()),
                 pa.array(rare_keys, pa.list_(pa.int64())), pa.array(rare_n, pa.list_(pa.int32()))],
                [id_col, "n_tokens", "known", "sums", "n_bytes", "bits", "rare_keys", "rare_n"])

    kind = dict(docs.dtypes)[id_col]
    made = plain.select(id_col, "__text").mapInArrow(
        read, f"`{id_col}` {kind}, n_tokens long, known long, sums double, n_bytes long, bits double, rare_keys array<long>, rare_n array<int>")
    made = cut_lineage(made.withColumn("__row", F.monotonically_increasing_id()), "scored")
    rare = made.select("__row", F.explode(F.arrays_zip("rare_keys", "rare_n")).alias("r")).select(
        "__row", F.col("r.rare_keys").alias("key"), F.col("r.rare_n").alias("times"))
    c = F.coalesce("n", F.lit(0))
    rest = rare.join(tokens, "key", "left").groupBy("__row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * (F.log10(c + 1) - F.log10(F.lit(float(scale))))).alias("rare_sum"))
    bits = F.round("bits", 4)
    return made.drop("rare_keys", "rare_n").join(rest, "__row", "left").select(
        id_col, "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("sums") + F.coalesce("rare_sum", F.lit(0.0))).alias("base_score"),
        (-bits * float(np.log10(2))).alias("score"), "n_bytes", (bits / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
