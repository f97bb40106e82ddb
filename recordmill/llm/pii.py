"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import find_spans, joined_spans, let, row_struct

# Possessive forms match the same spans as greedy ones here, without recursion on long runs. A match
# begins where a run begins or where the match before ended, so a long run is tried once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Where an account number may begin. What follows it can be any upper-case word or number, so its end is found apart.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
KINDS = ("email", "ip", "card", "phone")
ADDED = ("iban", "national_id")

#: Score of a proposed span, of a confirmed checksum, and of a context word within CONTEXT characters.
PROPOSED, CONFIRMED, NEARBY, CONTEXT = 0.5, 0.4, 0.3, 40
#: An added kind is reported from this score on; the four base kinds always are.
REPORTED = 0.8
#: Characters of an account number by country; other countries may have 15 to 34.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_MOST = 34
CONTEXT_WORDS = {
    "email": r"(?i)\b(e-?mail|contact|write)",
    "ip": r"(?i)\b(ip|host|server|address)\b",
    "card": r"(?i)\b(card|visa|credit|payment)",
    "phone": r"(?i)\b(phone|call|tel|mobile)",
    "iban": r"(?i)\b(iban|account|bank)",
    "national_id": r"(?i)\b(ssn|social security|national id|tax id)",
}


def luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            let(d.cast("int") * 2, lambda x: F.when(x > 9, x - 9).otherwise(x)))),
        F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """The mod-97 check of an account number without spaces."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda a, ch: F.when(
        ch.between("0", "9"), (a * 10 + ch.cast("int")) % 97).otherwise((a * 100 + F.ascii(ch) - 55) % 97))
    return rest == 1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _confirmed(kind: str, match: Column) -> Column:
    """Whether the checksum or the form of a kind holds."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
            r"\A(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\z"))
    if kind == "card":
        return let(_digits(match), lambda d: F.when(F.char_length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.char_length(_digits(match)).between(8, 15)
    return F.lit(True)


def _ibans(text: Column) -> Column:
    """Account numbers as structs of start and end. Every beginning is tried, with the length of its
    country, else with every end at a word border, the longest first; single spaces may lie anywhere."""
    known = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())
    countries = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")

    def any_end(rest: Column) -> Column:
        run = F.regexp_extract(rest, rf"\A(?:\x20?[A-Z0-9]){{15,{IBAN_MOST}}}", 0)
        ends = F.filter(F.sequence(F.char_length(run), F.lit(0), F.lit(-1)), lambda e: (e >= 15) & ~F.substring(
            rest, e, F.lit(2)).rlike(r"\A(?:\x20|.[A-Za-z0-9])"))
        return F.transform(ends, lambda e: F.substring(rest, F.lit(1), e))

    def number(rest: Column) -> Column:
        tried = F.when(rest.rlike(rf"\A(?:{countries})"), F.array(F.regexp_extract(rest, rf"\A(?:{known})(?![A-Za-z0-9])", 0))).otherwise(any_end(rest))
        return F.get(F.filter(tried, lambda v: let(F.regexp_replace(v, " ", ""), lambda x: (F.char_length(x) >= 15) & mod97(x))), F.lit(0))

    # A number with a space after each character, and the character after it.
    found = F.transform(find_spans(text, IBAN), lambda s: let(
        number(F.substring(text, s["start"] + 1, F.lit(2 * IBAN_MOST))), lambda v: F.struct(
            s["start"].alias("start"), (s["start"] + F.char_length(v)).alias("end"))))
    return F.filter(found, lambda s: s["end"].isNotNull())


def _spans(text: Column, kind: str, pattern: str) -> Column:
    def scored(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
        after = F.substring(text, s["end"] + 1, F.lit(CONTEXT))
        near = (before.rlike(CONTEXT_WORDS[kind]) | after.rlike(CONTEXT_WORDS[kind])).cast("double")
        proved = CONFIRMED if kind in ("card", "iban", "email", "ip") else 0.2
        score = F.least(F.lit(1.0), F.lit(PROPOSED + proved) + F.lit(NEARBY) * near)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

    kept = _ibans(text) if kind == "iban" else F.filter(find_spans(text, pattern), lambda s: _confirmed(kind, s["match"]))
    made = F.transform(kept, scored)
    return F.filter(made, lambda s: s["score"] >= REPORTED) if kind in ADDED else made


def pii_spans(text: Column) -> Column:
    """A struct of counts and of the spans (kind, start, end, score): ``base`` by kind as listed,
    then start; ``spans`` with the added kinds after them."""
    text = F.coalesce(text, F.lit(""))
    patterns = dict(zip((*KINDS, *ADDED), (EMAIL, IP, CARD, PHONE, IBAN, NATIONAL_ID), strict=True))
    found = F.struct(*(_spans(text, k, p).alias(k) for k, p in patterns.items()))
    return let(found, lambda f: F.struct(
        *(F.size(f[k]).cast("long").alias(f"n_{k}") for k in patterns),
        F.concat(*(f[k] for k in KINDS)).alias("base"),
        F.concat(*(f[k] for k in patterns)).alias("spans")))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, counts by kind, base and spans with scores. Null and empty texts
    have no spans; repeated rows stay repeated; other columns are ignored."""
    return row_struct(docs.select(id_col, text), [id_col], pii_spans(F.col(text)))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        id_col, *(f"n_{k}" for k in KINDS),
        F.sha2(joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))


def redacted(text: Column) -> Column:
    """The text with every span replaced by its kind in brackets. Overlapping spans become one, named
    after the first. Null stays null."""
    def masked(spans: Column) -> Column:
        by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        # The furthest end so far decides whether a span opens a new stretch of masked text.
        return let(by_start, lambda a: let(_running_max(F.transform(a, lambda s: s["end"])), lambda ends: let(
            F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (F.get(a, i)["start"] >= F.get(ends, i - 1))),
            lambda firsts: F.concat(
                F.substring(text, F.lit(1), F.get(a, F.lit(0))["start"]),
                F.array_join(F.transform(firsts, lambda i, k: let(
                    F.get(ends, F.coalesce(F.get(firsts, k + 1), F.size(a)) - 1), lambda end: F.concat(
                        F.lit("["), F.upper(F.get(a, i)["kind"]), F.lit("]"),
                        F.substring(text, end + 1, F.coalesce(
                            F.get(a, F.get(firsts, k + 1))["start"] - end, F.lit(2147483647)))))), "")))))

    return let(pii_spans(text)["spans"], lambda s: F.when(F.size(s) > 0, masked(s)).otherwise(text))


def _running_max(values: Column) -> Column:
    steps = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    return F.aggregate(F.sequence(F.lit(0), steps), values, lambda a, k: F.transform(
        a, lambda x, i: F.greatest(x, F.get(a, i - F.call_function("shiftleft", F.lit(1), k)))))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data masked in the text; a column ``n_chars`` is counted anew."""
    out = docs.withColumn(text, redacted(F.col(text)))
    return out.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
