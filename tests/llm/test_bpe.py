"""BPE ids and texts against the library, and the segment tree against plain merging."""

import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordmill.llm import bpe
from recordmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def own():
    return bpe.loaded(bpe.VOCABULARY)


def ids_of(own, text):
    return own.encode(text).tolist()


def plain(symbols, ranks, made):
    symbols = list(symbols)
    while True:
        found = [(ranks[k], i) for i in range(len(symbols) - 1) if (k := symbols[i] << 32 | symbols[i + 1]) in ranks]
        if not found:
            return symbols
        rank, i = min(found)
        symbols[i:i + 2] = [made[rank]]


def test_segment_tree_merges_like_repeated_search():
    dice = random.Random(5)
    for _ in range(400):
        letters = dice.randint(1, 4)
        pairs, made, known = {}, [], list(range(letters))
        for rank in range(dice.randint(0, 12)):
            a, b = dice.choice(known), dice.choice(known)
            if (a << 32 | b) not in pairs:
                pairs[a << 32 | b] = len(made)
                made.append(100 + rank)
                known.append(100 + rank)
        symbols = [dice.randrange(letters) for _ in range(dice.randint(0, 40))]
        assert bpe.merge(symbols, pairs, made) == plain(symbols, pairs, made)


def test_trees_side_by_side_merge_like_repeated_search():
    dice = random.Random(6)
    for _ in range(60):
        letters = dice.randint(1, 5)
        pairs, made, known = {}, [], list(range(letters))
        for rank in range(dice.randint(1, 14)):
            a, b = dice.choice(known), dice.choice(known)
            if (a << 32 | b) not in pairs:
                pairs[a << 32 | b] = len(made)
                made.append(100 + rank)
                known.append(100 + rank)
        words = [bytes(dice.randrange(letters) for _ in range(dice.randint(1, 33))) for _ in range(40)]
        first = bpe.np.arange(256, dtype=bpe.np.int32)
        flat, sizes = bpe.merge_many(words, first, bpe.Pairs(pairs), bpe.np.array(made))
        want = [plain(w, pairs, made) for w in words]
        assert sizes.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])


TEXTS = [
    "", " ", "a", "Hello world's  end\n\n  of   it\t\n", "<|endoftext|>", "a <|endoftext|><|endoftext|> b<|endoftext", "x" * 5000,
    "ab" * 3000, "don't we'll I'M 'tis", "Ünï cödé — ｆｕｌｌ 漢字 ▁ \U0001f600 é é", "\x00\x01\x1c\x1d\x1e\x1f\x85\xa0 ​﻿ x",
    " \x1c a", "a\x1cb", "١٢٣ ⅷ ² x2", "퟿￿\U0010ffff", " \n \n ", "end \t", "0x" + "0123456789abcdef" * 50,
]


def test_ids_and_texts_equal_the_library(library, own):
    for text in TEXTS:
        want = library.encode(text, add_special_tokens=False).ids
        got = ids_of(own, text)
        assert got == want, text[:40]
        assert own.decode(bpe.np.array(got, "<u4")) == library.decode(want, skip_special_tokens=False)


def test_every_assigned_character_between_letters(library, own):
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    wrong = []
    for at in range(0, len(chars), 4096):
        block = "".join(f"a{c}b {c}\n" for c in chars[at:at + 4096])
        if ids_of(own, block) != library.encode(block, add_special_tokens=False).ids:
            wrong.append(at)
    assert not wrong


def test_bytes_that_are_no_text(library, own):
    dice = random.Random(2)
    for _ in range(50):
        ids = [dice.randrange(50257) for _ in range(dice.randint(0, 30))]
        assert own.decode(bpe.np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)


def test_long_texts_in_pieces(library, own, monkeypatch):
    dice = random.Random(3)
    text = "".join(dice.choice(["a", "bc", " ", "  ", "\n", ".", "1", "é", " x", "'s"]) for _ in range(20_000))
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 100)
    monkeypatch.setattr(bpe, "CHUNK_IDS", 7)
    ids = ids_of(own, text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert own.decode(bpe.np.array(ids, "<u4")) == text


def test_long_run_takes_no_quadratic_time(own):
    assert len(ids_of(own, "ab" * 200_000)) > 1000


def test_memo_starts_anew(own, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_TOKENS", 2)
    fresh = bpe.Vocabulary(public_tokenizers.path(bpe.VOCABULARY))
    text = "one two three four one two " * 3
    assert ids_of(fresh, text) == ids_of(own, text)


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    import hashlib
    import struct
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op13_bpe"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_hard_rows(spark, hard, none):
    rows = bpe.decode(bpe.encode(hard)).collect()
    texts = sorted(((r["doc_id"], r["text"] or "") for r in hard.select("doc_id", "text").collect()), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=repr) == texts
    assert bpe.decode(bpe.encode(none)).collect() == []
    assert bpe.decode(spark.createDataFrame([(1, None)], "a long, ids binary")).collect()[0]["text"] is None
