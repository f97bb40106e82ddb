"""Table jobs on small fixtures: examples, brute-force comparisons and invariants."""

import hashlib
import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from recordmill.functions.names import _jaro_winkler
from recordmill.operators import chunks, dedup, fingerprints, lookups, ranking, resolve, upsert, validate
from recordmill.functions.classify import startup_evidence


def simhash(text):
    votes = [0] * 64
    for word in re.findall(r"\w+", text.lower()):
        h = int(hashlib.md5(word.encode()).hexdigest(), 16)
        for i in range(64):
            votes[i] += 1 if h >> i & 1 else -1
    value = sum(1 << i for i in range(64) if votes[i] >= 0) if re.findall(r"\w+", text) else 0
    return value - (1 << 64) if value >= 1 << 63 else value


def test_simhash(spark):
    texts = ["", "one", "to be or not to be", "Été à la plage, été", "x " * 5000, "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = dict(fingerprints.simhash64(df, "id", "t").collect())
    assert got == {i: simhash(t) for i, t in enumerate(texts)}


def test_simhash_is_made_inside_the_row(spark):
    df = spark.createDataFrame([(1, "a b c")], "id int, t string").repartition(2)
    plan = fingerprints.simhash64(df, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the one of the test itself


def near(values, distance=3):
    return {
        (a, b) for a, b in itertools.combinations(sorted(set(values)), 2)
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance
    }


@pytest.mark.parametrize("crowd", [2000, 3])
def test_near_fingerprints_is_exact(spark, crowd):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    for b in list(base):
        for _ in range(4):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                b ^= 1 << bit
            base.append(b)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in base] + [0, 1, -1]
    df = spark.createDataFrame([(v,) for v in signed * 2], "simhash bigint")
    rows = fingerprints.near_fingerprints(df, crowd=crowd).collect()
    assert len(rows) == len({(r["a"], r["b"]) for r in rows})
    assert {(r["a"], r["b"]) for r in rows} == near(signed)


def test_near_dup_window_is_exact(spark):
    rng = random.Random(2)
    pool = [0, 1, 3, 1 << 40, (1 << 40) + 5, 12345, -7]
    rows = [(i, rng.choice(pool), rng.randrange(40 * 24)) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, simhash bigint, h bigint").withColumn("ts", F.timestamp_seconds(F.col("h") * 3600))
    got = {r["id"]: r["is_duplicate"] for r in fingerprints.near_dup_window(df, "id", "ts").collect()}
    for i, s, h in rows:
        earlier = [
            1 for j, t, g in rows
            if (g, j) < (h, i) and h - g <= 168 and bin((s ^ t) & (1 << 64) - 1).count("1") <= 3
        ]
        assert got[i] == bool(earlier)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_positions(spark, width):
    rows = [("a" if i % 3 else "b", i * 2 + 1) for i in range(100)]
    df = spark.createDataFrame(rows, "s string, seq bigint")
    got = {(r["s"], r["seq"]): r["position"] for r in ranking.positions(df, ["s"], "seq", width).collect()}
    for s in "ab":
        for n, key in enumerate(sorted(r for r in rows if r[0] == s), 1):
            assert got[key] == n


def resolve_rows(spark, rows, master=None, **kw):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "seq bigint, raw_name string, entity_type string, domain string, external_ids map<string,string>",
    )
    out = resolve.resolve_all(df, master if master is not None else resolve.seed_master(spark), **kw)
    return [(r["canonical_value"], r["decision"]) for r in out.orderBy("seq").collect()], out


CASES = [
    ("OpenAI", "", None, "OpenAI", {"EXACT_NAME_MATCH"}), ("Open AI", "", None, "OpenAI", {"ALIAS_MATCH"}),
    ("OpenAI, Inc.", "", None, "OpenAI", {"EXACT_NAME_MATCH", "ALIAS_MATCH"}),
    ("Whatever", "https://openai.com/about?src=1", None, "OpenAI", {"DOMAIN_MATCH"}),
    ("Whatever", "", {"crunchbase": "openai"}, "OpenAI", {"EXACT_EXTERNAL_ID_MATCH"}),
    ("Anthropic PBC", "", None, "Anthropic", {"EXACT_NAME_MATCH", "ALIAS_MATCH"}),
    ("OpenAI Labs", "", None, "Openai Labs", {"CREATE_NEW_CANONICAL"}),
    ("Apple Records", "", None, "Apple Records", {"CREATE_NEW_CANONICAL"}),
    ("Amazon Web Services", "", None, "Amazon Web Services", {"CREATE_NEW_CANONICAL"}),
    ("OpenAI Capital Partners", "", None, "Openai Capital Partners", {"CREATE_NEW_CANONICAL"}),
    ("OpenAI Labs", "blog.openai.com.example.net", None, "Openai Labs", {"CREATE_NEW_CANONICAL"}),
    ("OpenAI Europe", "blog.openai.com.example.net", None, "OpenAI", {"COMPOSITE_MATCH"}),
    ("", "", None, "Unknown Entity", {"NO_MATCH"}), (None, "https://openai.com", None, "Unknown Entity", {"NO_MATCH"}),
    ("???", "", None, "???", {"CREATE_NEW_CANONICAL"}),
]


def test_resolution_examples(spark):
    got, out = resolve_rows(spark, [(n, "STARTUP", d, i) for n, d, i, _, _ in CASES])
    for (name, _, _, canonical, decisions), (value, decision) in zip(CASES, got):
        assert value == canonical and decision in decisions, name
    again, _ = resolve_rows(spark, [(n, "STARTUP", d, i) for n, d, i, _, _ in CASES])
    assert got == again


def test_last_seed_wins_and_type_before_any(spark):
    columns = "seq bigint, canonical_entity_id string, entity_type string, canonical_name string, normalized_name string, aliases array<string>, domains array<string>, external_ids map<string,string>, source_urls array<string>"
    master = spark.createDataFrame(
        [(0, "a", "STARTUP", "Twin", "twin", [], ["t.com"], {}, []), (1, "b", "PRODUCT", "Twin", "twin", [], ["t.com"], {}, [])], columns
    ).withColumn("created_at", F.lit(None).cast("timestamp")).withColumn("updated_at", F.lit(None).cast("timestamp"))
    df = spark.createDataFrame(
        [(0, "twin", "STARTUP", "", None), (1, "twin", "JOB", "", None), (2, "x", "JOB", "t.com", None)],
        "seq bigint, raw_name string, entity_type string, domain string, external_ids map<string,string>",
    )
    out = resolve.resolve_all(df, master).orderBy("seq").collect()
    assert [r["canonical_entity_id"] for r in out] == ["a", "b", "b"]


def test_fuzzy_is_exact(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    spelled = ["".join(c for c in n if rng.random() > 0.1) + rng.choice(["", "a", "x"]) for n in names]
    master = spark.createDataFrame(
        [(i, f"id{i}", n.title(), n) for i, n in enumerate(names)],
        "seq bigint, canonical_entity_id string, canonical_name string, normalized_name string",
    )
    wanted = spark.createDataFrame([(s,) for s in spelled], "normalized_value string")
    got = {r["normalized_value"]: r["by_score"]["score"] for r in resolve.fuzzy_hits(wanted, master).collect()}
    for s in set(spelled) - {""}:
        best = max(_jaro_winkler(s, n) for n in names)
        assert (got.get(s) == pytest.approx(best)) if best >= 0.92 else s not in got


def record(kind, content, **more):
    return json.dumps({"schemaVersion": "1.0", "recordType": kind, "source": {"name": "s", "url": "u"}, "content": content, "collectedAt": "c", **more})


NEWS = {"title": "t", "summary": "s", "full_text": "f", "published_date": "", "entities_mentioned": []}


@pytest.mark.parametrize("kind, payload, errors", [
    ("STARTUP", record("STARTUP", {"entityName": "A", "data": {"employeeCount": 5.0}}), []),
    ("STARTUP", record("STARTUP", {"entityName": "A", "data": {"employeeCount": True}}), ["content.data.employeeCount: type"]),
    ("STARTUP", record("STARTUP", {"entityName": "A", "data": {"employeeCount": "many"}}), ["content.data.employeeCount: type"]),
    ("STARTUP", record("STARTUP", {"entityName": "A", "data": {"employeeCount": None}}, more=1), ["record: extra keys"]),
    ("NEWS", record("NEWS", NEWS), []), ("NEWS", record("NEWS", {**NEWS, "title": ""}), ["content.title: length"]),
    ("NEWS", record("NEWS", NEWS, source={"name": "s"}), ["source: missing url"]),
    ("NEWS", record("JOB", NEWS), ["recordType: allowed"]),
    ("JOB", record("JOB", {"company": "c", "date": None, "is_remote": True, "role_family": "r"}), ["content.date: type"]),
    ("JOB", "{oops", ["record: not JSON"]), ("JOB", "[]", ["record: type"]),
    ("PODCAST", "{}", ["no schema registered for 'PODCAST'"]),
])
def test_validation(spark, kind, payload, errors):
    df = spark.createDataFrame([(payload,)], "payload string")
    row = validate.validate(df, kind).first()
    assert (row["errors"], row["valid"]) == (errors, not errors)


def test_strict_mode(spark):
    df = spark.createDataFrame([("{}",)], "payload string")
    with pytest.raises(Exception, match="NEWS rejected"):
        validate.validate_or_fail(df, "NEWS").collect()


@pytest.mark.parametrize("fields, expected", [
    (("https://www.ycombinator.com/companies/x", None, None, None, None, None, None), (True, "YC_DIRECTORY_RECORD")),
    (("https://github.com/v", "V", "v", None, None, None, True), (True, "VERIFIED_COMPANY_DOMAIN")),
    (("https://github.com/a", "Acme Inc.", "a", None, None, None, False), (True, "EXPLICIT_LEGAL_ENTITY(Inc)")),
    (("https://github.com/p", "Plat", "p", None, "An AI platform", None, False), (False, "INSUFFICIENT_COMPANY_EVIDENCE")),
    (("https://github.com/u", "MIT University", "u", "mit.edu", None, None, True), (False, "ACADEMIC_OR_NON_PROFIT")),
    (("https://github.com/c", "C", "c", "https://c.dev", "Cloud platform", None, False), (True, "COMMERCIAL_WEBSITE_AND_PROFILE")),
    (("https://github.com/n", "N", "n", "https://netflix.com", "Cloud platform", None, False), (False, "INSUFFICIENT_COMPANY_EVIDENCE")),
])
def test_startup_evidence(spark, fields, expected):
    df = spark.createDataFrame([fields], "url string, name string, login string, blog string, description string, company string, v boolean")
    assert tuple(df.select(startup_evidence(*[F.col(c) for c in df.columns]).alias("e")).first()["e"]) == expected


def test_upsert_keeps_and_replaces(spark):
    cols = "source_url string, seq bigint, company string, published_date string, is_remote boolean, data_json string, collected_at string"
    stored = spark.createDataFrame([("u", 9, "Old", "d0", True, "{}", "t0")], cols)
    new = spark.createDataFrame([("u", 1, "Mid", "d1", False, "{1}", "t1"), ("u", 2, "New", "d2", False, "{2}", "t2"), ("w", 3, "W", "d", None, "", "t")], cols)
    once = upsert.upsert_records("jobs", stored, new)
    rows = {r["source_url"]: r.asDict() for r in once.collect()}
    assert rows["u"] == {"source_url": "u", "seq": 2, "company": "New", "published_date": "d2", "is_remote": True, "data_json": "{2}", "collected_at": "t2"}
    assert len(rows) == 2
    twice = upsert.upsert_records("jobs", once, new)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_checkpoint_examples(spark):
    states = ["STORED"] * 6 + ["FAILED"] * 2 + ["PROCESSING"] * 2
    df = spark.createDataFrame([(f"u{i}", i, s, None) for i, s in enumerate(states)], "source_url string, seq bigint, state string, error string")
    assert dedup.completed_urls(dedup.checkpoint_fold(df)).count() == 6


@pytest.mark.parametrize("status, url, expected", [
    (200, "https://github.com/o/r", ("COMPLETED", 1250)), (404, "https://github.com/o/r", ("PERMANENT_FAILURE", None)),
    (403, "https://github.com/o/r", ("RETRYABLE_FAILURE", None)), (200, None, ("NO_DATA", None)),
    (200, "https://example.org", ("PERMANENT_FAILURE", None)), (302, "https://github.com/o/r", ("PERMANENT_FAILURE", None)),
])
def test_enrichment_state(spark, status, url, expected):
    df = spark.createDataFrame([(url, status, 1250)], "u string, s int, n bigint")
    got = df.select(lookups.enrichment_state(F.col("u"), F.col("s"), F.col("n")).alias("x")).first()["x"]
    assert tuple(got) == expected


def test_chunks(spark):
    text = "\n\n".join(" ".join(["w"] * 300) for _ in range(10))
    df = spark.createDataFrame([(1, text), (2, "short"), (3, None), (4, "a " * 900 + "\n\nb")], "id int, t string")
    rows = chunks.chunk_rows(df, "id", "t", 800).orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"], len(r["chunk"].split())) for r in rows] == [
        (1, 0, 600), (1, 1, 600), (1, 2, 600), (1, 3, 600), (1, 4, 600), (2, 0, 1), (3, 0, 0), (4, 0, 900), (4, 1, 1),
    ]


def test_merge_partials(spark):
    rows = [
        (1, 0, "", [], None), (1, 1, "abc", ["x", "y", "x"], None), (1, 2, "abd", ["y", "z"], 5), (1, 3, "a", None, 7), (2, 0, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, pos int, s string, l array<string>, n int")
    got = {r["id"]: r for r in chunks.merge_partials(df, "id", "pos", ["s"], ["l"], ["n"]).collect()}
    assert (got[1]["s"], got[1]["l"], got[1]["n"]) == ("abc", ["x", "y", "x", "z"], 5)
    assert (got[2]["s"], got[2]["l"], got[2]["n"]) == (None, [], None)


def test_row_order_does_not_matter(spark):
    rows = [(i, f"HTTP://A.org/{i % 7}{'/' * (i % 2)}") for i in range(50)]
    df = spark.createDataFrame(rows, "seq bigint, url string")
    mixed = spark.createDataFrame(rows[::-1], "seq bigint, url string").repartition(5)
    a, b = (sorted(map(str, dedup.dedup_by_url(x).collect())) for x in (df, mixed))
    assert a == b and len(a) == 7


def test_replayed_mapping_ids_are_equal(spark):
    _, out = resolve_rows(spark, [("OpenAI", "STARTUP", "", None), ("New Co", "STARTUP", "", None)])
    logs = [resolve.mapping_log(out, F.lit("https://x.org"), F.lit("t")).select("mapping_id").collect() for _ in range(2)]
    assert sorted(logs[0]) == sorted(logs[1])


ROWS = [("a", None, "n1"), ("a", 2, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", 5, "only"), ("b", 5, "only"), (None, 1, "null key"), ("c", None, "n")]


def ordered(spark):
    return spark.createDataFrame(ROWS, "url string, seq long, raw_content string")


@pytest.mark.parametrize("newest", [False, True])
def test_exactly_one_row_per_key(spark, newest):
    """Null and equal places, repeated rows and a null key: one row each, the same in every run."""
    got = {r["url"]: (r["seq"], r["raw_content"]) for r in dedup.pick_by(ordered(spark), ["url"], "seq", newest).collect()}
    assert set(got) == {"a", "b", "c", None} and got["b"] == (5, "only") and got["c"] == (None, "n")
    assert got["a"] in ({(2, "x"), (2, "y")} if newest else {(None, "n1")})
    again = dedup.pick_by(ordered(spark).repartition(7), ["url"], "seq", newest).filter("url = 'a'").first()
    assert (again["seq"], again["raw_content"]) == got["a"]


def test_row_pickers_lose_and_double_nothing(spark):
    rows = ordered(spark)
    assert dedup.dedup_by_url(rows).count() == 4
    assert dedup.latest_content_hash(dedup.ledger(rows)).count() == 4
    report = dedup.dedup_report(rows)
    assert report.count() == len(ROWS) and report.filter("is_duplicate").count() == 3
    events = spark.createDataFrame(
        [("u", None, "NEW", None), ("u", 3, "OK", None), ("u", 3, "OK", None), ("v", None, "NEW", "e")],
        "source_url string, seq long, state string, error string")
    assert sorted(map(tuple, dedup.checkpoint_fold(events).collect())) == [("u", "OK", 3, None, 3), ("v", "NEW", 1, "e", None)]
    fresh = spark.createDataFrame([(1, "m"), (1, "m"), (None, "k")], "seq long, mapping_id string")
    assert upsert.append_new(fresh.limit(0), fresh, "mapping_id").count() == 2


def test_merges_keep_unplaced_and_repeated_arrivals(spark):
    rows = spark.createDataFrame(
        [("a", None, 1, 10), ("a", 4, 2, 20), ("a", 4, 2, 20), ("b", None, 3, 30), ("b", None, 3, 30)], "k string, seq long, new int, old int")
    got = sorted(map(tuple, upsert.merge_by_key(rows, "k", "seq", ["new"]).collect()))
    assert got == [("a", 4, 2, 10), ("b", None, 3, 30)]
    folds = upsert.fold_by_key(rows.filter("seq IS NULL"), "k", "seq", ["new"]).unionByName(
        upsert.fold_by_key(rows.filter("seq = 4"), "k", "seq", ["new"]))
    assert sorted(map(tuple, upsert.fold_by_key(folds, "k", "seq", ["new"]).drop("first_seq").collect())) == got


def test_stored_rows_precede_unplaced_arrivals(spark):
    kind = "source_url string, seq long, schema_version string, source_name string, company string, published_date string, is_remote boolean, role_family string, data_json string, collected_at string"
    stored = spark.createDataFrame([("u", 9, "1", "s", "Old", "d", True, "R", "{}", "t0")], kind)
    arrivals = spark.createDataFrame([("u", None, "1", "s2", "New", "d2", False, "Q", "{}", "t1"), ("w", None, "1", "s2", "W", "d2", False, "Q", "{}", "t1")], kind)
    got = {r["source_url"]: (r["company"], r["is_remote"]) for r in upsert.upsert_records("jobs", stored, arrivals).collect()}
    assert got == {"u": ("New", True), "w": ("W", False)}


def test_upsert_entity_refuses_taken_names(spark):
    kind = "canonical_entity_id string, entity_type string, normalized_name string, seq long, created_at string"
    stored = spark.createDataFrame([("e1", "STARTUP", "one", 1, "t"), ("e2", "STARTUP", "two", 2, "t")], kind)
    arrivals = spark.createDataFrame([
        ("e1", "COMPANY", "one ltd", 5, "x"),   # renamed; keeps its type
        ("e3", "STARTUP", "two", 6, "x"),       # held by e2
        ("e4", "COMPANY", "two", 7, "x"),       # same name, other type
        ("e5", "STARTUP", "new", 9, "x"), ("e6", "STARTUP", "new", 8, "x"),  # e6 comes first
        ("e7", "STARTUP", "one", 10, "x"),      # given up by e1, free in the next merge only
        (None, "STARTUP", "none", 11, "x"), ("e8", "STARTUP", None, 12, "x"),
    ], kind)
    merged, refused = upsert.upsert_entity(stored, arrivals)
    assert {(r[0], r[1], r[2]) for r in merged.collect()} == {
        ("e1", "STARTUP", "one ltd"), ("e2", "STARTUP", "two"), ("e4", "COMPANY", "two"), ("e6", "STARTUP", "new")}
    assert {(r["canonical_entity_id"], r["held_by"]) for r in refused.collect()} == {
        ("e3", "e2"), ("e5", "e6"), ("e7", "e1"), (None, None), ("e8", None)}


def test_equal_papers_are_taken_by_id(spark):
    from recordmill.operators.papers import recent_papers, top_starred

    rows = [(i * 7 % 40, "2026-01-02", None, 5) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, published_date string, arxiv_id string, github_stars long").repartition(5)
    assert sorted(r["id"] for r in recent_papers(df, F.lit("2026-01-01"), 6).collect()) == list(range(6))
    assert sorted(r["id"] for r in top_starred(df, 6).collect()) == list(range(6))


def test_unplaced_claims_of_one_url_are_taken_by_url(spark):
    for k in range(12):
        rows = [(None, f"HTTPS://H.ORG/{k}" + "/" * n) for n in (3, 2, 1)]
        found = dedup.dedup_by_url(spark.createDataFrame(rows, "seq bigint, url string")).collect()
        assert [r["url"] for r in found] == [f"HTTPS://H.ORG/{k}/"]
