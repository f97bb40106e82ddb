"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in every task and adds the counts up in one aggregation. The
log-probability matrix has ``buckets`` rows and one column per language, so its size is bounded and
it is broadcast. Scoring takes texts in blocks: their n-grams are one sparse matrix of documents by
buckets, held as a list of buckets with the place where each document begins, and one product with the
log-probability matrix (gather the rows, add up between the places) scores the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = (2, 3)
#: Characters scored at a time, which bounds memory for texts of any length.
CHUNK_CHARS = 1 << 20
#: Characters of the texts that are scored together.
BLOCK_CHARS = 1 << 18
#: Languages that the broadcast matrix may hold.
MAX_LANGUAGES = 1024
UNKNOWN = "und"


def _codes(text: str) -> np.ndarray:
    """Code points, lower-cased, with letters kept and everything else turned into one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((codes - np.uint32(97) < 26) | (codes >= 0xC0), codes, np.uint32(32))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


#: Odd multipliers, one per place in an n-gram.
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _grams(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every n-gram of a blank-padded text, all orders one after the other. ``buckets`` is
    a power of two: the top bits of a multiplicative hash."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    scaled = [codes * f for f in _FACTORS]
    out = []
    for n in ORDERS:
        m = len(codes) - n + 1
        if m > 0:
            h = scaled[0][:m] + scaled[1][1:1 + m]
            if n > 2:
                h += scaled[2][2:2 + m]
            out.append(h >> shift)
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def _pieces(text: str) -> Iterator[np.ndarray]:
    """The padded text in pieces that overlap by one n-gram less one character. Each n-gram of the
    longest order comes once; shorter ones at a border come twice, which is the same in training
    and in scoring."""
    codes = np.pad(_codes(text), 1, constant_values=32)
    step = CHUNK_CHARS
    for at in range(0, max(1, len(codes) - max(ORDERS) + 1), step):
        yield codes[at:at + step + max(ORDERS) - 1]


def gram_counts(docs: DataFrame, text: str, lang: str, buckets: int = BUCKETS) -> DataFrame:
    """lang, bucket, n over all given rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for t, label in zip(batch.column(0), batch.column(1), strict=True):
                for piece in _pieces(t.as_py()):
                    counts = np.bincount(_grams(piece, buckets), minlength=buckets)
                    if label.as_py() in sums:
                        sums[label.as_py()] += counts
                    else:
                        sums[label.as_py()] = counts
            for label, counts in sums.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "bucket", "n"])

    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    return rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order, and float32 log probabilities of shape (buckets, languages)."""

    def __init__(self, languages: list[str], logs: np.ndarray, priors: np.ndarray) -> None:
        self.languages, self.logs, self.priors = languages, logs, priors


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> Model:
    """Counts over all labelled rows, add-one smoothing. The driver gets at most ``buckets`` numbers
    per language and at most MAX_LANGUAGES languages (more raise an error)."""
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang).count().orderBy(lang).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError("too many distinct languages")
    languages = sorted(sizes)
    counts = np.ones((buckets, len(languages)))
    place = {x: i for i, x in enumerate(languages)}
    for row in gram_counts(docs, text, lang, buckets).groupBy("lang").agg(
            F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).toLocalIterator():
        counts[np.array(row["b"]), place[row["lang"]]] += np.array(row["n"])
    logs = np.log(counts / counts.sum(axis=0, keepdims=True)) if languages else counts
    total = sum(sizes.values())
    priors = np.array([np.log(sizes[x] / total) for x in languages])
    return Model(languages, logs.astype(np.float32), priors)


def block_scores(texts: list[str], logs: np.ndarray, priors: np.ndarray) -> np.ndarray:
    """Log probabilities of (texts, languages) by one sparse product."""
    grams, rows = [], []
    for i, t in enumerate(texts):
        for piece in _pieces(t):
            grams.append(_grams(piece, len(logs)))
            rows.append(i)
    sizes = np.array([len(g) for g in grams])
    starts, held = np.cumsum(sizes) - sizes, np.flatnonzero(sizes)
    out = np.tile(priors, (len(texts), 1))
    if len(held):
        sums = np.add.reduceat(logs[np.concatenate(grams)], starts[held], axis=0, dtype=np.float64)
        np.add.at(out, np.array(rows)[held], sums)
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score (posterior of the predicted language). Null texts
    and texts without a letter give ``und`` with score 0, as do all texts when nothing was learned;
    ties go to the language first in order. Ids may be null; repeated rows stay repeated; an empty table
    gives an empty one; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.logs, model.priors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, logs, priors = shared.value
        for batch in batches:
            names, scores = [UNKNOWN] * len(batch), np.zeros(len(batch))
            block: list[tuple[int, str]] = []
            held = 0

            def decide() -> None:
                if block:
                    total = block_scores([t for _, t in block], logs, priors)
                    best = total.argmax(axis=1)
                    top = total[np.arange(len(best)), best]
                    for (i, _), k, p in zip(block, best, 1.0 / np.exp(total - top[:, None]).sum(axis=1), strict=True):
                        names[i], scores[i] = languages[k], p
                    block.clear()

            for i, t in enumerate(batch.column(1).to_pylist() if languages else []):
                if t is None or not _has_letter(t):
                    continue
                block.append((i, t))
                held += len(t)
                if held >= BLOCK_CHARS:
                    decide()
                    held = 0
            decide()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def fold(id_col: Column, of: int) -> Column:
    """crc32 of the id's text, modulo ``of``; -1, which is no fold, for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % of, F.lit(-1))
