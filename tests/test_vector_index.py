"""The vector index against brute force."""

import numpy as np

from recordmill.catalog import QUERIES
from recordmill.operators import vector_index as V

FOLDER = "/root/testdata/sf0.001"


def test_recall_over_all_rows(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    got = {}
    for r in QUERIES["similar_vectors_indexed"](spark, FOLDER).collect():
        got.setdefault(r["query"], {})[r["key"]] = r["similarity"]
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        scores = x @ x[list(ids).index(q)]
        scores[list(ids).index(q)] = -2
        best = ids[np.lexsort((ids, -scores))[:10]].tolist()
        hits += len(set(best) & set(found))
        assert len(found) == 10 and all(abs(scores[list(ids).index(k)] - s) < 1e-5 for k, s in found.items())
    assert hits >= 0.9 * 10 * len(got)


def test_a_common_vector_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(V, "TILE", 16)
    monkeypatch.setattr(V, "BLOCK", 4)
    dice = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.0] if i % 3 == 0 else dice.normal(size=3).tolist()) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0]), (302, [float("nan")] * 3), (303, [1.0]), (304, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    index = V.build_index(df, "id", "v", 5, cells=4, recall=1.0)
    assert index.table.count() == 301
    got = V.search(index, index.table.filter("id % 20 = 0"), 5).collect()
    assert len(got) == 5 * 15  # row 300 has no vector
    of = [r["key"] for r in sorted(got, key=lambda r: r["rank"]) if r["query"] == 0]
    assert of == [3, 6, 9, 12, 15]
    assert V.build_index(df.limit(0), "id", "v", 5) is None
