"""The registered queries against their SQL, and the whole pipeline."""

import pytest

import corpus_pipeline
from check import compare, connect
from recordmill.llm.queries import ORACLES, QUERIES
from recordmill.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    state, note = compare(spark, connect(FOLDER), FOLDER, name)
    assert state == "ok", note


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_in_steps_equals_run(spark, docs):
    step = docs
    for name, stage in corpus_pipeline.STAGES:
        before = step.count()
        step = cut_lineage(stage(spark, step, FOLDER), name)
        assert name == "best_fit_packing" or 0 < step.count() <= before
    run = corpus_pipeline.run(spark, FOLDER)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, step.select(columns).collect())) == sorted(map(tuple, run.select(columns).collect()))
