"""One key, source or group of copies holding a third of all rows: results stay whole and right."""

import random

from pyspark.sql import functions as F

from recordmill.operators import dedup, fingerprints, lookups, ranking, upsert
from recordmill.operators.components import components
from recordmill.operators.resolve import resolve_all, seed_master

N = 6000


def hot(column="id"):
    """A third of the rows share the value 0."""
    return F.when(F.col(column) % 3 == 0, F.lit(0)).otherwise(F.col(column))


def rows(spark):
    return spark.range(N).select(F.col("id").alias("seq"), hot().alias("k"))


def test_first_claims(spark):
    urls = rows(spark).select("seq", F.concat(F.lit("https://h.org/"), F.col("k").cast("string")).alias("url"))
    assert dedup.dedup_by_url(urls).count() == N - N // 3 + 1
    report = dedup.dedup_report(urls)
    assert report.count() == N and report.filter("is_duplicate").count() == N // 3 - 1


def test_copies(spark):
    prints = rows(spark).select("seq", F.xxhash64("k").alias("simhash"))
    found = fingerprints.near_duplicates(prints).collect()
    assert [r["docs"] for r in found if r["docs"] > 1] == [N // 3] and len(found) == N - N // 3 + 1
    timed = prints.withColumn("ts", F.timestamp_seconds(F.col("seq") * 60))
    flagged = fingerprints.near_dup_window(timed, "seq", "ts")
    assert flagged.count() == N and flagged.filter("is_duplicate").count() >= N // 3 - 1


def test_stratum(spark):
    strata = rows(spark).select("seq", (F.col("k") > 0).alias("s"))
    placed = ranking.positions(strata, ["s"], "seq", parts=16)
    top = placed.groupBy("s").agg(F.max("position").alias("p"), F.count_distinct("position").alias("n")).collect()
    assert {(r["s"], r["p"], r["n"]) for r in top} == {(False, N // 3, N // 3), (True, N - N // 3, N - N // 3)}


def test_merge(spark):
    arrivals = rows(spark).select("k", "seq", (F.col("seq") * 2).alias("new"), F.col("seq").alias("old"))
    merged = {r["k"]: r for r in upsert.merge_by_key(arrivals, "k", "seq", ["new"]).collect()}
    last = max(i for i in range(N) if i % 3 == 0)
    assert len(merged) == N - N // 3 + 1 and (merged[0]["new"], merged[0]["old"]) == (2 * last, 0)


def test_lookup_without_key(spark):
    papers = rows(spark).select("seq", F.when(F.col("k") > 0, F.concat(F.lit("https://github.com/o/r"), (F.col("k") % 10).cast("string"))).alias("github_url"))
    snapshot = spark.range(10).select(
        F.col("id").alias("seq"), F.concat(F.lit("https://github.com/o/r"), F.col("id").cast("string")).alias("github_url"),
        F.lit(200).alias("http_status"), F.col("id").alias("stars"),
    )
    out = lookups.enrich_repo_stats(papers, snapshot).groupBy("enrichment_status").count().collect()
    assert {r[0]: r[1] for r in out} == {"NO_DATA": N // 3, "COMPLETED": N - N // 3}


def test_resolution_of_one_common_name(spark):
    named = rows(spark).select(
        "seq", F.when(F.col("k") == 0, F.lit("Open AI")).otherwise(F.concat(F.lit("Firm "), F.col("k").cast("string"))).alias("raw_name"),
        F.lit("STARTUP").alias("entity_type"), F.lit("").alias("domain"), F.lit(None).cast("map<string,string>").alias("external_ids"),
    )
    out = resolve_all(named, seed_master(spark)).groupBy("decision").count().collect()
    assert {r[0]: r[1] for r in out} == {"ALIAS_MATCH": N // 3, "CREATE_NEW_CANONICAL": N - N // 3}


def ball(spark, n, spread):
    """Fingerprints that differ from one another only in the lowest ``spread`` bits, so that they meet under
    the same keys; ``n`` of them, dealt by a hash."""
    return spark.range(n).select(F.xxhash64("id").bitwiseAND(F.lit((1 << spread) - 1)).alias("simhash")).distinct()


def test_links_of_a_crowded_key_grow_with_its_members(spark):
    for n in (2000, 4000, 8000):
        prints = ball(spark, n, 14)
        members = prints.count()
        links = fingerprints.near_links(prints, tile=64)
        assert members <= links.count() + 1 <= 6 * members
        assert components(links).groupBy("component").count().count() == 1


def test_crowded_key_of_many_parts(spark):
    """Words of a code with distance 4 are never linked; a few neighbours of them are."""
    rng = random.Random(9)
    code = []
    while len(code) < 700:
        w = rng.getrandbits(22)
        if all(bin(w ^ c).count("1") > 3 for c in code):
            code.append(w)
    values = code + [c ^ 7 for c in code[:40]] + [c ^ (1 << 40) for c in code[40:60]] + [c - (1 << 63) for c in code[60:80]]
    got = {r["fingerprint"]: r["cluster"] for r in fingerprints.near_duplicates(
        spark.createDataFrame([(v,) for v in values], "simhash long"), tile=32).collect()}
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for i, a in enumerate(values):
        for b in values[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {v: find(v) for v in set(values)}


def test_window_gathers_nothing_in_the_driver(spark):
    """Spark's own broadcasts are up to 10 MB compressed, which is many times that in the driver."""
    timed = rows(spark).select("seq", F.xxhash64("k").alias("simhash"), F.timestamp_seconds(F.col("seq") * 60).alias("ts"))
    flagged = fingerprints.near_dup_window(timed, "seq", "ts")
    flagged.collect()
    assert "Broadcast" not in flagged._jdf.queryExecution().executedPlan().toString()


def test_labels_beyond_the_limit_are_shuffled(spark, monkeypatch):
    from recordmill.operators import components as C

    monkeypatch.setattr(C, "LABEL_BYTES", 0)
    found = C.components(spark.range(300).selectExpr("id AS a", "id + 1 AS b"))
    assert found.groupBy("component").count().collect()[0]["count"] == 301
