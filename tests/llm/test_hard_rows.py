"""Every operator and stage on nulls, empty and long texts, repeats, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordmill.llm import decontaminate, langid, mixing, packing, pii, quality, secret_scan, simhash, tokencount

FOLDER = "/root/testdata/sf0.001"


def items(spark):
    return spark.createDataFrame(
        [(1, "one two three four five six seven"), (2, None), (3, ""), (3, "one two")], "item_id long, text string")


OPERATORS = {
    "quality": lambda s, d: quality.quality(d),
    "tokens": lambda s, d: tokencount.token_counts(d),
    "mixing": lambda s, d: mixing.score(d, F.col("doc_id") % 2 == 0),
    "secrets": lambda s, d: secret_scan.digest(secret_scan.find_secrets(d)),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "pii": lambda s, d: pii.digest(pii.find_pii(d)),
    "packing": lambda s, d: packing.pack(d),
    "languages": lambda s, d: langid.predict(d, langid.fit(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows(spark, hard, name):
    got = OPERATORS[name](spark, hard).collect()
    ids = sorted(r["doc_id"] for r in got if name != "packing" or r["piece"] == 0)
    assert ids == sorted(r["doc_id"] for r in hard.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, none, name):
    assert OPERATORS[name](spark, none).collect() == []


def test_contained_items_hard(spark, hard, none):
    got = decontaminate.contained_items(hard, items(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(4, 1), (5, 1)}
    assert len(got) == 2
    assert decontaminate.contained_items(none, items(spark)).collect() == []
    assert decontaminate.contained_items(hard, items(spark).limit(0)).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, hard, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, hard, FOLDER)
    out.collect()
    assert stage(spark, none, FOLDER).collect() == []
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == hard.columns
        assert out.dtypes == hard.dtypes


def test_null_and_empty_results(spark, hard):
    q = {r["doc_id"]: r for r in quality.quality(hard).collect()}
    assert q[1]["n_words"] == q[2]["n_words"] == q[3]["n_words"] == 0 and q[1]["base_failed"]
    t = {r["doc_id"]: r for r in tokencount.token_counts(hard).collect()}
    assert (t[1]["n_tokens"], t[2]["n_tokens"], t[1]["n_bytes"]) == (0, 0, 0)
    s = {r["doc_id"]: r for r in simhash.near_duplicates(hard).collect()}
    assert s[1]["fingerprint"] == s[3]["fingerprint"] == "0" * 16 and s[3]["component_id"] == 1
    assert s[5]["component_id"] == 4
    p = packing.pack(hard).where("doc_id = 1").collect()
    assert [(r["length"], r["start"]) for r in p] == [(1, 0)]
    names = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(hard, langid.fit(hard)).collect()}
    assert names[1] == names[2] == names[3] == names[9] == ("und", 0.0)
