"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text falls into added tokens, which are matched as they are, and stretches between them; a stretch
falls into pre-tokens by the pattern of byte-level vocabularies, and a pre-token into its UTF-8 bytes.
The leaves of a segment tree hold the merge rank of every adjacent pair together with its place, and
every node the smaller of its two children: the root is the leftmost pair of the lowest rank. A merge
changes three leaves, so each takes logarithmic time, whatever the length of the pre-token, until the
root holds no pair. Short pre-tokens are merged many at a time, their trees side by side in numpy; those that
come again are taken from a bounded memo.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
#: Pre-tokens remembered by one worker process before the memo starts anew, and their most bytes; longer
#: ones are merged alone.
MEMO_TOKENS, MEMO_BYTES = 300_000, 63
#: Characters split at a time, and ids decoded at a time.
CHUNK_CHARS, CHUNK_IDS = 1_000_000, 1_000_000
#: Slots of the table of pairs, and the multipliers of its hash.
SLOTS, FIRST, SECOND = 1 << 19, 0x9E3779B1, 0x85EBCA6B
#: A place between two pre-tokens whatever stands around it: a single space between two that are none.
BORDER = regex.compile(r"(?<=\S)(?= \S)")
_LOADED: dict[str, Vocabulary] = {}


def byte_signs() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others take the code points from 256 on, in order."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def merge(symbols: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """``symbols`` after all merges. ``ranks`` holds the rank of the pair (a, b) at ``a << 32 | b``,
    ``made`` the symbol that the merge of each rank makes."""
    n = len(symbols)
    if n < 2:
        return symbols
    rank_of = ranks.get
    leaves = 1 << (n - 2).bit_length()
    shift = n.bit_length()
    none = len(made) << shift
    tree = [none] * (2 * leaves)
    for i in range(n - 1):
        r = rank_of(symbols[i] << 32 | symbols[i + 1])
        if r is not None:
            tree[leaves + i] = r << shift | i
    for k in range(leaves - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    symbols = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    place = (1 << shift) - 1
    while (root := tree[1]) < none:
        i = root & place
        gone = after[i]
        right, left = after[gone], before[i]
        symbols[i], symbols[gone] = made[root >> shift], -1
        after[i] = right
        changed = [(gone, none)]
        value = none
        if right < n:
            before[right] = i
            r = rank_of(symbols[i] << 32 | symbols[right])
            if r is not None:
                value = r << shift | i
        changed.append((i, value))
        if left >= 0:
            r = rank_of(symbols[left] << 32 | symbols[i])
            changed.append((left, none if r is None else r << shift | left))
        for leaf, value in changed:
            k = leaves + leaf
            if k >= 2 * leaves:
                continue
            tree[k] = value
            while k > 1:
                a, b = tree[k], tree[k ^ 1]
                k >>= 1
                if b < a:
                    a = b
                if tree[k] == a:
                    break
                tree[k] = a
    return [s for s in symbols if s >= 0]


class Pairs:
    """Ranks of many pairs at once: an open-addressed table with the pairs as keys."""

    def __init__(self, ranks: dict[int, int]) -> None:
        self.none = len(ranks)
        self.keys, self.ranks = np.full(SLOTS, -1, np.int64), np.full(SLOTS, self.none, np.int32)
        keys, values = np.fromiter(ranks, np.int64), np.fromiter(ranks.values(), np.int32)
        slots = self._slot(keys >> 32, keys & 0xFFFFFFFF)
        while len(keys):
            first = np.unique(slots, return_index=True)[1]
            first = first[self.keys[slots[first]] == -1]
            self.keys[slots[first]], self.ranks[slots[first]] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) % SLOTS

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = a.astype(np.uint64) * np.uint64(FIRST) + b.astype(np.uint64) * np.uint64(SECOND)
        return ((h ^ h >> np.uint64(15)) % np.uint64(SLOTS)).astype(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b), ``none`` where there is no merge or a symbol is negative."""
        shape = a.shape
        a, b = a.ravel(), b.ravel()
        key, slot = a.astype(np.int64) << 32 | (b.astype(np.int64) & 0xFFFFFFFF), self._slot(a, b)
        held = self.keys[slot]
        out = np.where(held == key, self.ranks[slot], self.none)
        open_ = np.flatnonzero((held != key) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % SLOTS
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        out[(a < 0) | (b < 0)] = self.none
        return out.reshape(shape)


def merge_many(words: list[bytes], first: np.ndarray, pairs: Pairs, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`merge` for many pre-tokens of bounded length, one segment tree each, all moved at once: their
    symbols, one after the other, and how many each has.

    Row w of every array belongs to a pre-token. Its symbols stand at places 1 to n between two places
    that hold none, so no update needs a border case. A leaf holds rank and place of the pair that
    begins at its place."""
    n = max(map(len, words))
    leaves = 1 << max(1, (n + 1).bit_length())
    shift = leaves.bit_length() - 1
    count, width = len(words), n + 2
    symbols = np.full((count, width), -1, np.int32)
    sizes = np.fromiter(map(len, words), np.int64, count)
    data = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(count), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    symbols[row, place] = first[data]
    after = np.tile(np.arange(1, width + 1, dtype=np.int32), (count, 1))
    before = np.tile(np.arange(-1, width - 1, dtype=np.int32), (count, 1))
    none = pairs.none << shift
    tree = np.full((count, 2 * leaves), none, np.int32)
    ranks = pairs.of(symbols[:, 1:n], symbols[:, 2:n + 1]) if n > 1 else np.zeros((count, 0), np.int32)
    tree[:, leaves + 1:leaves + n] = np.where(ranks < pairs.none, ranks << shift | np.arange(1, n), none)
    for k in range(leaves - 1, 0, -1):
        np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
    flat, sym, nxt, prv = tree.ravel(), symbols.ravel(), after.ravel(), before.ravel()
    w = np.arange(count)
    while len(w := w[flat[w * (2 * leaves) + 1] < none]):
        base, tops = w * width, w * (2 * leaves)
        root = flat[tops + 1]
        i = (root & (leaves - 1)).astype(np.int64)
        gone = nxt[base + i]
        right, left = nxt[base + gone], prv[base + i]
        new = made[root >> shift]
        sym[base + i], sym[base + gone] = new, -1
        nxt[base + i], prv[base + right] = right, i
        changed = []
        for at, rank in ((i, pairs.of(new, sym[base + right])), (left.astype(np.int64), pairs.of(sym[base + left], new))):
            flat[tops + leaves + at] = np.where(rank < pairs.none, rank << shift | at, none)
            changed.append(leaves + at)
        flat[tops + leaves + gone] = none
        changed.append(leaves + gone.astype(np.int64))
        nodes = np.stack(changed)
        for _ in range(shift):
            nodes >>= 1
            for node in nodes:
                at = tops + 2 * node
                flat[tops + node] = np.minimum(flat[at], flat[at + 1])
    kept = symbols >= 0
    return symbols[kept], kept.sum(axis=1)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)]


class Vocabulary:
    """A byte-level BPE vocabulary read from its file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        ids = read["model"]["vocab"]
        signs = byte_signs()
        self.first = np.array([ids[s] for s in signs], np.int32)
        found = [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
        self.ranks = {ids[a] << 32 | ids[b]: r for r, (a, b) in enumerate(found)}
        self.made = [ids[a + b] for a, b in found]
        self.pairs, self.made_array = Pairs(self.ranks), np.array(self.made or [0], np.int32)
        added = {t["content"]: t["id"] for t in read["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in read["added_tokens"]):
            raise ValueError("added tokens that take their surroundings into account are not supported")
        self.added = added
        #: Longer strings first, so that of several that begin at a place the longest is found.
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        byte = {s: b for b, s in enumerate(signs)}
        strings = {i: self._bytes(t, byte) for t, i in {**ids, **added}.items()}
        self.known = max(strings) + 1
        texts = [strings.get(i, b"") for i in range(self.known)]
        self.byte_sizes = np.array([len(t) for t in texts], np.int64)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    @staticmethod
    def _bytes(token: str, byte: dict[str, int]) -> bytes:
        return bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def _pieces(self, text: str) -> Iterator[str]:
        """``text`` in pieces of about CHUNK_CHARS that fall into the same pre-tokens as the whole."""
        at = 0
        while len(text) - at > CHUNK_CHARS:
            border = BORDER.search(text, at + CHUNK_CHARS)
            if border is None:
                break
            yield text[at:border.start()]
            at = border.start()
        if at < len(text):
            yield text[at:]

    def _learn(self, words: list[str]) -> None:
        """Puts pre-tokens that are not in the memo into it: those of like length are merged together."""
        names = list(set(words).difference(self.memo))
        data = list(map(str.encode, names))
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        order: list[np.ndarray] = []
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        least = 0
        for most in (8, 16, 32, MEMO_BYTES):
            some = np.flatnonzero((lengths > least) & (lengths <= most))
            least = most
            if len(some):
                flat, n = merge_many([data[i] for i in some.tolist()], self.first, self.pairs, self.made_array)
                order.append(some)
                ids.append(flat.astype("<u4"))
                sizes.append(n)
        for i in np.flatnonzero(lengths > MEMO_BYTES).tolist():
            symbols = merge(self.first[np.frombuffer(data[i], np.uint8)].tolist(), self.ranks, self.made)
            order.append(np.array([i]))
            ids.append(np.array(symbols, "<u4"))
            sizes.append(np.array([len(symbols)]))
        if not names:
            return
        known, counts = len(self.memo), np.concatenate(sizes)
        self.memo.update(zip([names[i] for i in np.concatenate(order).tolist()], range(known, known + len(names)), strict=True))
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(counts) - counts)
        self.sizes = np.append(self.sizes, counts)
        self.flat = np.append(self.flat, np.concatenate(ids))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        made: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def write() -> None:
            nonlocal held
            if len(self.memo) > MEMO_TOKENS:
                self._forget()
            every = [w for _, words in waiting for w in words]
            self._learn(every)
            at = np.fromiter(map(self.memo.__getitem__, every), np.int64, len(every))
            sizes = self.sizes[at]
            data = _gathered(self.flat, self.starts[at], sizes).tobytes()
            ends = np.append(0, np.cumsum(sizes)) * 4
            stop = 0
            for text, words in waiting:
                start, stop = stop, stop + len(words)
                made[text].append(data[ends[start]:ends[stop]])
            waiting.clear()
            held = 0

        for n, text in enumerate(texts):
            for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
                if i % 2:
                    write()
                    made[n].append(int(self.added[part]).to_bytes(4, "little"))
                    continue
                for piece in self._pieces(part):
                    waiting.append((n, self.pattern.findall(piece)))
                    held += len(piece)
                    if held >= CHUNK_CHARS:
                        write()
        write()
        return [b"".join(x) for x in made]

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text``."""
        return np.frombuffer(self.encode_all([text])[0], "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        out = []
        for at in range(0, len(ids), CHUNK_IDS):
            some = ids[at:at + CHUNK_IDS].astype(np.int64)
            some = some[some < self.known]
            out.append(reader.decode(_gathered(self.bytes, self.byte_starts[some], self.byte_sizes[some]).tobytes()))
        return "".join(out) + reader.decode(b"", final=True)


def loaded(name: str) -> Vocabulary:
    if name not in _LOADED:
        _LOADED[name] = Vocabulary(public_tokenizers.path(name))
    return _LOADED[name]


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per input row: id and ids (binary, little-endian unsigned 32-bit integers, as token files
    hold them). Null and empty texts have no ids; added tokens inside a text are found as such; repeated
    rows stay repeated; ids may be null; other columns are ignored; an empty table gives an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(vocabulary)
        for batch in batches:
            made = own.encode_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], [id_col, "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, ids binary")


def decode(tokens: DataFrame, ids: str = "ids", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``tokens`` with one more column, the text of its ids (as ``encode`` gives them). Null ids give a
    null text; an added token gives its own string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(vocabulary)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            made = [None if x is None else own.decode(np.frombuffer(x, "<u4")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, text])

    kinds = ", ".join(f"`{n}` {t}" for n, t in tokens.dtypes)
    return tokens.mapInArrow(run, f"{kinds}, `{text}` string")
