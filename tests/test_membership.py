"""The membership filter never calls a stored key new, and keeps most others from the store."""

from pyspark.sql import functions as F

from recordmill.operators import membership as M


def keys(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("https://x.org/"), F.col("id").cast("string")).alias("url"), F.col("id"))


def test_no_false_skip_and_few_hits(spark, tmp_path):
    path, stored = str(tmp_path / "f"), keys(spark, 0, 20_000)
    M.build(stored.select("url"), ["url"], path)
    asked = keys(spark, 10_000, 30_000)
    met = M.maybe_known(asked, ["url"], path)
    assert met.filter("id < 20000 AND NOT maybe").count() == 0
    assert met.filter("id >= 20000 AND maybe").count() < 10_000 / 8
    assert sorted(r["id"] for r in M.skip_known(asked, stored, ["url"], path).collect()) == list(range(20_000, 30_000))
    assert M.only_known(asked, stored, ["url"], path).count() == 10_000


def test_extended_filters_know_the_new_keys(spark, tmp_path):
    path = str(tmp_path / "f")
    M.build(keys(spark, 0, 100), ["url"], path, bits=20)
    for _ in range(2):  # again after a lost run
        M.extend(spark, keys(spark, 100, 200), ["url"], path)
    met = M.maybe_known(keys(spark, 0, 2000), ["url"], path)
    assert met.filter("id < 200 AND NOT maybe").count() == 0 and met.filter("maybe").count() < 260


def test_null_keys_empty_stores_and_two_columns(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 1), ("b", 2)], "k string, v long")
    M.build(rows.filter("k = 'a'"), ["k", "v"], str(tmp_path / "two"))
    left = M.skip_known(rows, rows.filter("k = 'a'"), ["k", "v"], str(tmp_path / "two")).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([("a", None), (None, 1), ("b", 2)], key=repr)
    M.build(rows.limit(0), ["k"], str(tmp_path / "none"))
    assert M.skip_known(rows, rows.limit(0), ["k"], str(tmp_path / "none")).count() == 4


def test_store_is_not_shuffled(spark, tmp_path):
    path, stored = str(tmp_path / "f"), keys(spark, 0, 1000)
    stored.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    M.build(stored, ["url"], path)
    plan = M._known(keys(spark, 500, 700), stored, ["url"])._jdf.queryExecution().executedPlan().toString()
    semi = plan[plan.index("LeftSemi"):]
    assert "Broadcast" in semi and "hashpartitioning" not in semi
