from recordmill.llm import warc

SCHEMA = "record_id long, record_type string, target_uri string, ts long, http_headers string, status string"


def resolved(spark, rows, **more):
    return {r["record_id"]: r for r in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA), **more).collect()}


def test_validators_and_headers(spark):
    rows = [
        (1, "response", "http://www.A.org:80/x#f", 10, 'ETag: W/"1"\nContent-Type: text/html\nVary: a\nSet-Cookie: p\nSet-Cookie: q', "z"),
        (2, "revisit", "https://a.org/x", 20, 'ETag: "1"\r\nVary: b\r\nContent-Type: no', None),
        (3, "revisit", "http://a.org/x", 10, 'ETag: "1"', None),
        (4, "revisit", "http://a.org/x", 9, 'ETag: "1"', None),
        (5, "revisit", "http://a.org/x", 30, 'ETag: "2"', None),
        (6, "revisit", "http://a.org/x", 30, "Date: d", None),
        (7, "revisit", None, 30, None, None), (8, "revisit", "http://a.org/x", None, None, None),
        (9, "request", "http://a.org/x", 30, None, None), (10, "response", "no url", 11, None, None),
    ]
    got = resolved(spark, rows)
    assert {k: (r["status"], r["response_id"]) for k, r in got.items()} == {
        2: ("resolved", 1), 3: ("resolved", 1), 4: ("no_response", None), 5: ("mismatch", 1),
        6: ("no_validator", 1), 7: ("no_url", None), 8: ("no_url", None)}
    assert [tuple(h) for h in got[2]["headers"]] == [
        ("content-type", "text/html"), ("etag", '"1"'), ("set-cookie", "p"), ("set-cookie", "q"), ("vary", "b")]
    assert resolved(spark, [r for r in rows if r[0] > 100]) == {}


def test_hot_url_and_buckets_against_brute_force(spark):
    rows = []
    for i in range(600):
        url = "http://hot.org/" if i % 3 else f"http://b.org/{i % 7}"
        rows.append((i, "response" if i % 5 == 0 else "revisit", url, (i * 37) % 500, f'ETag: "{i % 2}"', None))
    for seconds in (1, 50, 100_000):
        got = resolved(spark, rows, bucket_seconds=seconds)
        for r in rows:
            if r[1] == "revisit":
                before = [(x[3], x[0]) for x in rows if x[1] == "response" and x[2] == r[2] and (x[3], x[0]) < (r[3], r[0])]
                want = max(before)[1] if before else None
                assert got[r[0]]["response_id"] == want
                assert got[r[0]]["status"] == ("no_response" if want is None else "resolved" if want % 2 == r[0] % 2 else "mismatch")
