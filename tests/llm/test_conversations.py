"""Repaired conversations against an exhaustive search over edits."""

import hashlib
import heapq
import random
import re
import zlib

from recordmill.llm import conversations as cv
from recordmill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub(r"[.!?]", "", text) if d == 2 else text
        out += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def wanted(conv, rows):
    """By best-first search over (cost, audit) with whole edit sequences, nothing shared with the operator."""
    rows = damaged(rows)
    faults, seen = [], set()
    for _, role, text in rows:
        marks = WORD.findall(text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    # A node is how many rows are read and the initials so far, shortened to what decides the future.
    def short(roles):
        return roles[:1] * (roles[:1] == "s") + "ua" * (len(roles.strip("s")) > 1) + "u" * (len(roles.strip("s")) % 2)
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, roles, text = heapq.heappop(heap)
        if i == len(rows) and GOOD.fullmatch(roles):
            break
        if (i, roles, audit) in done:
            continue
        done.add((i, roles, audit))
        steps = [(2, "I", i, r, (f"{name}:",)) for r, name in (("u", "user"), ("a", "assistant"))]
        if i < len(rows):
            _, role, t = rows[i]
            steps.append((3, "D", i + 1, "", ()))
            if faults[i] not in ("blank", "duplicate"):
                more = 1 if faults[i] == "truncated" else 0
                steps.append((more, "K", i + 1, role[:1], (f"{role}:{t}",)))
                steps += [(2 + more, "R", i + 1, name[0], (f"{name}:{t}",)) for name in ("user", "assistant")]
        for c, letter, j, r, lines in steps:
            if letter == "K" and not r:
                continue
            now = roles + r
            if re.fullmatch(r"s?(ua)*u?", now):
                heapq.heappush(heap, (cost + c, audit + letter, j, short(now) if r else roles, text + lines))
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(text).encode()).hexdigest())


def grouped(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return by


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def run(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return got(cv.repair(cv.damage(frame)).withColumnRenamed("conv", "conv_id"))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_conversations"](spark, folder)) == sorted((wanted(c, r) for c, r in grouped(rows).items()), key=repr)


def test_random_conversations(spark):
    dice = random.Random(11)
    rows = []
    for conv in range(250):
        for turn in range(dice.randint(1, 7)):
            rows.append((conv, dice.choice([turn, turn, turn, dice.randint(0, 6), None]),
                         dice.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         dice.choice(["Yes.", "No!", "Why?", "cut", " \t", "", None, "Because\n", "Is it? "])))
    assert run(spark, rows) == sorted((wanted(c, r) for c, r in grouped(rows).items()), key=repr)


def test_short_blocks_give_the_same(spark, monkeypatch):
    """Digits are written out every few turns here; the audit must not notice."""
    dice = random.Random(4)
    for _ in range(60):
        rows = [(1, t, dice.choice(["user", "assistant", "system", "tool"]), dice.choice(["a.", "b", "c!", "", "a."])) for t in range(9)]
        want = wanted(1, rows)
        rows, seen = damaged(rows), set()
        with monkeypatch.context() as m:
            for name, value in (("BLOCK", 2), ("WIDTH", 8), ("LOW", 24)):
                m.setattr(cv, name, value)
            one = cv.Repair()
            for turn, role, text in rows:
                marks = WORD.findall(text)
                fault = cv.BLANK if not marks else cv.DUPLICATE if (role, text) in seen else cv.TRUNCATED if marks[-1] not in ".!?" else cv.SOUND
                seen.add((role, text))
                one.feed(turn, role, text, 1, fault)
            assert (1, *one.result()) == want


def test_hard_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (1, None, None, None), (2, 5, "user", "x."), (2, 5, "user", "x."),
            (3, 0, "user", "long. " * 50_000), (3, 1, "assistant", "ok."), (4, -3, "assistant", "a."), (4, 9, "user", "b")]
    assert run(spark, rows) == sorted((wanted(c, r) for c, r in grouped(rows).items()), key=repr)
    assert run(spark, []) == []


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert run(spark, [(7, turn, "user", "Hi.")]) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_many_copies_and_a_long_conversation(spark):
    """A row repeated 30,000 times and a conversation of 3,000 turns of which many say the same."""
    rows = [(1, 1, "user", "Again?")] * 30_000 + [(1, 2, "assistant", "Yes.")]
    rows += [(2, t, "user" if t % 2 else "assistant", f"line {t % 700}.") for t in range(3000)]
    one, two = run(spark, rows)
    copies = 2 if zlib.crc32(b"1:1") % 20 == 3 else 1
    assert one[3] == 30_000 * copies - 1 and one[7].count("D") >= 29_999
    said = [(r, t) for _, r, t in damaged([r for r in rows if r[0] == 2]) if WORD.search(t)]
    assert two[3] == len(said) - len(set(said)) and len(two[7].replace("I", "")) == len(damaged([r for r in rows if r[0] == 2]))
    small = [r for r in rows if r[0] == 2 and r[1] < 12]
    assert run(spark, small)[0] == wanted(2, small)


def test_columns_with_clashing_names(spark):
    frame = spark.createDataFrame([(1, 1, "user", "Hi.", "a", "b", "c", "d"), (1, 2, "assistant", "Ho.", "a", "b", "c", "d")],
                                  "conv_id long, turn long, role string, text string, conv string, copies string, key string, said string")
    assert got(cv.repair(cv.damage(frame)).withColumnRenamed("conv", "conv_id")) == [
        wanted(1, [(1, 1, "user", "Hi."), (1, 2, "assistant", "Ho.")])]
