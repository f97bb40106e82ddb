"""Token counts by a piece vocabulary, with whole-token shortcuts.

The vocabulary splits text only where none of its pieces joins two characters. Two such places are
proved from the piece list when a model is read: before a run of spaces (no piece has a space after
another character) and around a line feed (no piece holds one). So a text falls into segments, each an
optional run of spaces and a run of other characters, whose counts add up. Every vocabulary string that
is such a segment is encoded once, offline, and those that come out as one token are the shortcut table.
Segments found there count 1; only the rest are merged by the library, once each while the bounded memo
lasts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
#: Segments remembered by one worker process before the memo starts anew.
MEMO_SEGMENTS = 300_000
#: Characters of text split at a time.
CHUNK_CHARS = 2_000_000
SEGMENT = re.compile(r" *[^ \n]+| +|\n")
_SPACE = "▁"
_COUNTERS: dict[str, Counter] = {}


class Counter:
    """Counts tokens of whole texts with one model."""

    def __init__(self, path: str, memo_segments: int = MEMO_SEGMENTS) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.memo_segments = memo_segments
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())
                  if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        strings = [p.replace(_SPACE, " ") for p in pieces]
        probe = " x  y ﬁ é "
        #: Whether segments are independent: no piece joins across their borders and the text is
        #: not rewritten before it is split.
        self.separable = (
            not any("\n" in s or " " in s.lstrip(" ") for s in strings)
            and self.model.normalize(probe) == _SPACE + probe.replace(" ", _SPACE)
        )
        self.newline = len(self.model.encode("\n")) - 1 if self.separable else 0
        self.single = {}
        if self.separable:
            whole = [s for s in strings if SEGMENT.fullmatch(s) and s != "\n"]
            self.single = {s: 1 for s, n in zip(whole, self._segments(whole), strict=True) if n == 1}
        self.memo: dict[str, int] = {}

    def _segments(self, segments: list[str]) -> list[int]:
        """Counts of segments by the library. A line feed in front keeps the space that the library
        puts before every text apart from the segment."""
        before = 1 + self.newline
        return [len(x) - before for x in self.model.encode(["\n" + s for s in segments], num_threads=1)]

    def counts(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts. The segments that need merging are gathered over all of them,
        as the library is several times faster on long lists."""
        if not self.separable:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        single, memo = self.single, self.memo
        if len(memo) > self.memo_segments:
            memo.clear()
        memo["\n"] = self.newline
        split = [SEGMENT.findall(" " + t.replace(_SPACE, " ")) if t else [] for t in texts]
        new = list({s for segments in split for s in segments if s not in single and s not in memo})
        memo.update(zip(new, self._segments(new), strict=True))
        return [sum([1 if s in single else memo[s] for s in segments]) for segments in split]


def _counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens. Without begin, end or added tokens,
    whole texts. Null counts as empty, which has no tokens; repeated rows stay repeated; an empty
    table gives an empty result; other columns are ignored. ``model`` is the path of the vocabulary
    on the executors; by default the one installed there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model or public_tokenizers.path(MODEL))
        for batch in batches:
            texts, sizes, at = batch.column(1).to_pylist(), [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < CHUNK_CHARS:
                    size += len(texts[end])
                    end += 1
                sizes += counter.counts(texts[at:end])
                at = end
            sizes = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), sizes], [id_col, "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("__text"),
                       F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("__bytes"))
    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
