"""Bucketed tables: what a merge reads, moves and writes."""

import os
import re

from recordmill.operators import upsert
from recordmill.operators.bucketed import BucketTable

KIND = "k string, seq long, new int, old int"


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merge_touches_only_its_buckets(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", 8)
    rows = [(f"k{i}", i, i, i) for i in range(500)]
    table.merge(spark.createDataFrame(rows, KIND), "seq", ["new"])
    before = files(tmp_path)
    arrivals = spark.createDataFrame([("k7", None, 70, 70), ("k7", 9, 71, 71), ("k7", 8, 72, 72), ("fresh", 3, 1, 5), ("fresh", 4, 2, 6), (None, 1, 1, 1)], KIND)
    refused = table.merge(arrivals, "seq", ["new"]).collect()
    assert len(refused) == 1 and refused[0]["k"] is None
    got = {r["k"]: (r["seq"], r["new"], r["old"]) for r in table.read().collect()}
    assert len(got) == 501 and got["k7"] == (9, 71, 7) and got["fresh"] == (4, 2, 5) and got["k8"] == (8, 8, 8)
    after = files(tmp_path)
    assert all(after[f] == t for f, t in before.items())
    assert len({re.search(r"_slot=(\d+)-", f)[1] for f in set(after) - set(before)}) <= 2
    # Again: no value changes.
    table.merge(arrivals, "seq", ["new"])
    assert {r["k"]: (r["seq"], r["new"], r["old"]) for r in table.read().collect()} == got
    table.vacuum()
    assert len(files(tmp_path)) == len(table.manifest()["slots"])
    assert {r["k"]: (r["seq"], r["new"], r["old"]) for r in table.read().collect()} == got


def test_stored_side_is_not_shuffled(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", 8)
    table.merge(spark.createDataFrame([(f"k{i}", i, i, i) for i in range(100)], KIND), "seq", ["new"])
    arrivals = spark.createDataFrame([("k1", 1, 1, 1)], KIND)
    now = table.manifest()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = table.merged(arrivals, ["new", "seq"], sorted(now["slots"].values()), arrivals.schema)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = plan[plan.index("FullOuter"):plan.index("buckets_t")] if plan.index("buckets_t") < plan.index("Scan ExistingRDD") else plan[plan.index("Scan ExistingRDD"):]
    assert plan.count("Exchange") == 1 and "Exchange" not in stored.split("Scan ExistingRDD")[-1]
    assert "Bucketed: true" in plan


def test_a_dead_attempt_leaves_no_trace(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", 4)
    table.merge(spark.createDataFrame([("a", 1, 1, 1)], KIND), "seq", ["new"])
    slot = table.manifest()["slots"]
    bucket = next(iter(slot))
    table.spark.createDataFrame([("zombie", 1, 1, 1)], KIND).write.parquet(f"{table.path}/data/_slot={bucket}-2")
    assert [r["k"] for r in table.read().collect()] == ["a"]
    table.merge(spark.createDataFrame([("a", 2, 5, 5)], KIND), "seq", ["new"])
    assert [tuple(r) for r in table.read().collect()] == [("a", 2, 5, 1)]


def test_same_rows_as_a_merge_of_plain_tables(spark, tmp_path):
    kind = "source_url string, seq long, schema_version string, source_name string, company string, published_date string, is_remote boolean, role_family string, data_json string, collected_at string"
    def made(n, mark):
        return spark.createDataFrame([(f"u{i % 40}", i, "1", mark, f"{mark}{i}", "d", i % 2 == 0, mark, "{}", mark) for i in range(n)], kind)
    updated = upsert.UPSERT_UPDATED["jobs"]
    stored = upsert.merge_by_key(made(60, "a"), "source_url", "seq", updated)
    table = BucketTable(spark, str(tmp_path / "jobs"), "source_url", 4)
    table.merge(made(60, "a"), "seq", updated)
    table.merge(made(90, "b"), "seq", updated)
    want = upsert.upsert_records("jobs", stored, made(90, "b"))
    assert sorted(map(tuple, table.read().select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
