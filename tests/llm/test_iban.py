"""Account numbers with other upper-case words and numbers around them."""

from pyspark.sql import functions as F

from recordmill.llm import pii

DE, SPACED, GB = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
#: Texts, and the numbers in them.
TEXTS = [
    (f"IBAN {DE} BIC COBADEFFXXX", [DE]), (f"IBAN {DE} USD 500", [DE]), (f"IBAN {SPACED} 2024-01-01", [SPACED]),
    (f"IBAN {SPACED} {GB} {DE}", [SPACED, GB, DE]), (f"IBAN DE12 {SPACED} 7", [SPACED]), (f"IBAN AB12 {GB} AND MORE", [GB]),
    ("IBAN NO93 8601 1117 947 KID 12", ["NO93 8601 1117 947"]), (f"IBAN: {DE}.", [DE]), (f"IBAN {DE}X", []), (f"IBAN X{DE}", []),
    ("IBAN MT84 MALT 0110 0001 2345 MTLC AST0 01S EUR 9", ["MT84 MALT 0110 0001 2345 MTLC AST0 01S"]),
    ("IBAN " + " ".join(DE) + " A", []), ("IBAN DE89 " + " ".join(DE[4:]) + " A", ["DE89 " + " ".join(DE[4:])]),
]


def checked(country):
    """An account number of 20 characters of a country without a listed length."""
    body = "12345678ABCDEFGH"
    digits = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{country}{98 - int(digits) % 97:02d}{body}"


def test_ibans_between_other_words(spark):
    other = checked("ZZ")
    texts = [*TEXTS, (f"IBAN {other} TO PAY 5", [other]), (f"IBAN {other}9 TO PAY 5", [])]
    made = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(made).select("doc_id", "spans").collect()}
    for i, (t, want) in enumerate(texts):
        assert [t[s["start"]:s["end"]] for s in got[i] if s["kind"] == "iban"] == want, t
    masked = {r["doc_id"]: r["text"] for r in pii.redact(made).where(F.col("doc_id") < 2).collect()}
    assert masked == {0: "IBAN [IBAN] BIC COBADEFFXXX", 1: "IBAN [IBAN] USD 500"}
