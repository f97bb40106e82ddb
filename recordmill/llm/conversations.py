"""Repair of damaged conversations by one integer-minimum pass over a graph of edits.

Turns are read in order. A state is how much of the wanted order of roles is done: nothing, a system
turn, a user turn that waits for its answer, or whole pairs. Every turn is a layer of edges between
states: keep it, give it the role that fits, delete it, each with the insertions that must come before.
The weight of an edge is one integer: its cost in the high digits, and below them, at the position of
its letters in the audit, one fixed-width digit per letter; positions not used yet are zeros. So the
least sum is the cheapest repair and, among equally cheap ones, the least audit text, and nothing but the
minimum of integers decides. All audits of a layer hold the same number of turns and end with one, so
none begins another, and what a minimum decides cannot be undone by later letters.

Integers stay short: after BLOCK letters the digits of each state are written out, and the states' order
so far becomes one digit under the cost. A state also carries the running SHA-256 of its repaired turns,
so no text is kept and a conversation of any length streams through sorted rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import let
from recordmill.session import join_side

#: Faults, in the order in which they are looked for.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1
#: Digits of audit letters, in ASCII order; zero is the end.
LETTERS = "DIKR"
DIGIT = {letter: i for i, letter in enumerate(LETTERS, 1)}
#: Bits of a digit, and turns whose letters are held in one integer; a turn has three letters at most.
BITS, BLOCK = 3, 128
WIDTH = 3 * BLOCK + 2
LOW = BITS * WIDTH
#: Bits of the order of states between cost and letters.
RANK = 2
NOTHING, SYSTEM, USER, PAIRS = range(4)
_TRIM = " \t\n\x0b\x0c\r"
_NO_ROLE = {"u": "user", "a": "assistant"}


def _steps() -> dict[tuple[str, str], list[tuple[int, int, str, str]]]:
    """For an edit that leaves a turn of role initial ``x`` and its letter: from state, to state, roles
    inserted before, letters. Insertions that return to a state are left out, as they only cost."""
    goes = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("u", PAIRS): USER, ("a", USER): PAIRS}
    out = {}
    for x in "sua":
        for letter in "KR":
            found = []
            for state in range(4):
                if (x, state) in goes:
                    found.append((state, goes[x, state], "", letter))
                    continue
                for fill in "ua":
                    middle = goes.get((fill, state))
                    if middle is not None and (x, middle) in goes:
                        found.append((state, goes[x, middle], fill, "I" + letter))
            out[x, letter] = found
    return out


STEPS = _steps()


def _weight(cost: int, letters: str, at: int) -> int:
    w = cost << (LOW + RANK)
    for k, letter in enumerate(letters, at):
        w |= DIGIT[letter] << BITS * (WIDTH - 1 - k)
    return w


class _Path:
    """The best repair that ends in a state: weight, letters of the block, letters before, and hash."""

    __slots__ = ("weight", "used", "before", "digest", "empty")

    def __init__(self, weight: int, used: int, before, digest, empty: bool) -> None:
        self.weight, self.used, self.before, self.digest, self.empty = weight, used, before, digest, empty

    def letters(self) -> str:
        low = self.weight & ((1 << LOW) - 1)
        return "".join(LETTERS[(low >> BITS * (WIDTH - 1 - k) & 7) - 1] for k in range(self.used))

    def cost(self) -> int:
        return self.weight >> (LOW + RANK)


class Repair:
    """One conversation, fed turn by turn."""

    def __init__(self) -> None:
        self.paths: list[_Path | None] = [_Path(0, 0, None, hashlib.sha256(), True), None, None, None]
        self.counts = [0, 0, 0, 0]
        self.turns, self.least, self.most, self.last = 0, None, None, None
        self.illegal, self.initial, self.layers = 0, None, 0

    def feed(self, turn: int | None, role: str, text: str, copies: int, fault: int) -> None:
        """``copies`` equal turns next to each other; all but the first are duplicates, unless blank."""
        if copies < 1:
            return
        if turn is not None:
            if turn != self.last:
                self.turns += 1
            self.last = self.most = turn
            self.least = turn if self.least is None else self.least
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if initial * 2 not in ("su", "ua", "au"):
            self.illegal += copies - 1
        self.initial = initial
        self.counts[fault] += 1
        self.counts[BLANK if fault == BLANK else DUPLICATE] += copies - 1
        if fault in (BLANK, DUPLICATE):
            self._deleted(copies)
            return
        self._layer(initial, role, text, UNFINISHED if fault == TRUNCATED else 0)
        if copies > 1:
            self._deleted(copies - 1)

    def _deleted(self, n: int) -> None:
        """Turns that must go. The state stays, and insertions come after them, as D sorts before I."""
        if n > BLOCK - self.layers:
            self._written("D" * n)
            for p in self.paths:
                if p:
                    p.weight += n * DELETE << (LOW + RANK)
            return
        self.layers += n
        for p in self.paths:
            if p:
                p.weight += _weight(n * DELETE, "D" * n, p.used)
                p.used += n

    def _layer(self, initial: str, role: str, text: str, unfinished: int) -> None:
        if self.layers >= BLOCK:
            self._written("")
        self.layers += 1
        old, best = self.paths, [None, None, None, None]

        def offer(state: int, to: int, cost: int, letters: str, fill: str, kept: str | None) -> None:
            p = old[state]
            w = p.weight + _weight(cost, letters, p.used)
            if best[to] is None or w < best[to][0]:
                best[to] = (w, p, len(letters), fill, kept)

        for state in range(4):
            if old[state]:
                offer(state, state, DELETE, "D", "", None)
        for x, name in (("u", "user"), ("a", "assistant")):
            for state, to, fill, letters in STEPS[x, "R"]:
                if old[state]:
                    offer(state, to, REROLE + unfinished + INSERT * len(fill), letters, fill, name)
        if initial and initial in "sua":
            for state, to, fill, letters in STEPS[initial, "K"]:
                if old[state]:
                    offer(state, to, KEEP + unfinished + INSERT * len(fill), letters, fill, role)
        for state, found in enumerate(best):
            if found:
                w, p, n, fill, kept = found
                lines = [f"{_NO_ROLE[f]}:" for f in fill] + ([f"{kept}:{text}"] if kept is not None else [])
                digest, empty = _hashed(p, lines)
                best[state] = _Path(w, p.used + n, p.before, digest, empty)
        self.paths = best

    def _written(self, more: str) -> None:
        """Writes the block's letters out, and ``more`` for all; the order of states becomes a digit."""
        live = [p for p in self.paths if p]
        low = {v: i for i, v in enumerate(sorted({p.weight & ((1 << LOW + RANK) - 1) for p in live}))}
        for p in live:
            text = p.letters() + more
            p.before = (p.before, text)
            p.weight = (p.cost() << RANK | low[p.weight & ((1 << LOW + RANK) - 1)]) << LOW
            p.used = 0
        self.layers = 0

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        ends = []
        for state, fill in ((NOTHING, ""), (PAIRS, ""), (USER, "a"), (SYSTEM, "ua")):
            p = self.paths[state]
            if p:
                ends.append((p.weight + _weight(INSERT * len(fill), "I" * len(fill), p.used), fill, p))
        weight, fill, p = min(ends, key=lambda e: e[0])
        digest, _ = _hashed(p, [f"{_NO_ROLE[f]}:" for f in fill])
        parts, before = [p.letters() + "I" * len(fill)], p.before
        while before:
            before, text = before
            parts.append(text)
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal,
                weight >> (LOW + RANK), "".join(reversed(parts)), digest.hexdigest())


def _hashed(p: _Path, lines: list[str]):
    if not lines:
        return p.digest, p.empty
    digest = p.digest.copy()
    digest.update((("" if p.empty else "\n") + "\n".join(lines)).encode())
    return digest, False


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies: every row after its damage, which follows from the CRC-32 of
    ``conv:turn`` modulo 20: 0 drops the row (copies 0), 1 empties its text, 2 removes ``.!?`` from it,
    3 repeats it, 4 makes it the user's. Null role, text and key parts are one space."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
        F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space)).alias("key"))
    rows = rows.withColumn("d", F.crc32(F.col("key").cast("binary")) % 20)
    d = F.col("d")
    return rows.select(
        "conv", F.when(d != 0, F.col("turn")).alias("turn"),
        F.when(d == 0, space).when(d == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(d == 0, space).when(d == 1, "").when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(d == 0, 0).when(d == 3, 2).otherwise(1).cast("long").alias("copies"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Equal rows of ``damage`` as one, with the sum of their copies and the fault of the first.

    Equal rows are summed before any text meets another. A row is a duplicate if role and text come at
    an earlier turn of its conversation: the first turn of those that come at several turns is found by
    a hash aggregate and joined back, so one frequent text or one long conversation loads no task."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("said", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    none = F.col("turn").isNull()
    first = rows.where("copies > 0").groupBy("conv", "said").agg(
        F.max(none).alias("from_null"), F.min("turn").alias("from_turn"), F.count("*").alias("n")).where("n > 1")
    first = join_side(first.select(F.col("conv").alias("c"), F.col("said").alias("s"), "from_null", "from_turn"), "first_said")
    joined = rows.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
    later = F.col("s").isNotNull() & ~none & (F.col("from_null") | (F.col("turn") > F.col("from_turn")))
    fault: Column = let(F.rtrim(F.col("text"), F.lit(_TRIM)), lambda t: F.when(t == "", BLANK).when(later, DUPLICATE).when(
        ~F.right(t, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND))
    return joined.select("conv", "turn", "role", "text", "copies", fault.alias("fault"))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (as ``damage`` gives them; copies may be 0): conv, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are taken by turn number, null first, then by role and text, equal rows next to each other. A
    null ``conv`` is a conversation of its own. A conversation without turns has zeros, an empty audit
    and the hash of nothing; one whose turns all go likewise but for its counts and cost. Empty roles
    have no initial and fit nowhere. An empty table gives an empty one; other columns are ignored.

    The rows of a conversation stream through one task in order, as the hash of its repaired text must;
    kept are four states and the letters of their audits."""
    kind = dict(rows.dtypes)["conv"]
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, own = None, None

        def out(schema: pa.Schema) -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in done], schema.field("conv").type)]
            columns += [pa.array([r[i] for r in done], pa.int64()) for i in range(1, 7)]
            columns += [pa.array([r[i] for r in done], pa.string()) for i in (7, 8)]
            return pa.RecordBatch.from_arrays(columns, ["conv", *names, "audit", "repaired_sha256"])

        schema = None
        for batch in batches:
            schema = batch.schema
            for conv, turn, role, text, copies, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None or conv != now:
                    if own is not None:
                        done.append((now, *own.result()))
                    now, own = conv, Repair()
                own.feed(turn, role, text, copies, fault)
            if done:
                yield out(schema)
                done = []
        if own is not None:
            done = [(now, *own.result())]
            yield out(schema)

    ordered = with_faults(rows).repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(run, f"conv {kind}, " + ", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string")
