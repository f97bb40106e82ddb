"""Secrets in texts: fixed shapes, and candidate strings of high entropy.

A candidate is a run of one character class: letters and digits mixed, hexadecimal, digits alone, or
letters alone in both cases. Shannon entropy slides over it in a window: the counts of the symbols in the
window and the sum of c·log2(c) are carried along and changed by the symbol that enters and the one that
leaves. A candidate whose highest window reaches the threshold of its class is a finding, unless that
window, or the part between separators that it lies in, is on the allow list; only paths and unique ids
are allowed as whole runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import find_spans, joined_spans, let, row_struct

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
#: Runs that mix letters and digits, runs of digits, and runs of letters with three of each case at least;
#: possessive, and begun only at the border of a run.
_SIGN = "[A-Za-z0-9+/_-]"
CANDIDATE = (
    rf"(?<!{_SIGN})(?:(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z]){_SIGN}{{20,}}+"
    rf"|[0-9]{{20,}}+(?!{_SIGN})|(?=(?:[a-z]*+[A-Z]){{3}})(?=(?:[A-Z]*+[a-z]){{3}})[A-Za-z]{{20,}}+(?!{_SIGN}))"
)
KINDS = ("assign", "access", "hex")

#: Symbols per window.
WINDOW = 20
#: Bits per symbol from which a window of the class counts as random. Twenty random digits have 2.9 on
#: average and twenty random letters of both cases 4.0.
HEX_BITS, MIXED_BITS, DIGIT_BITS, LETTER_BITS = 3.0, 3.6, 2.7, 3.7
HEX_ONLY = r"\A(?:[0-9a-f_-]+|[0-9A-F_-]+)\z"
DIGITS_ONLY, LETTERS_ONLY = r"\A[0-9]+\z", r"\A[A-Za-z]+\z"

#: Parts between separators that are not secrets: placeholders.
ALLOWED_PARTS = (r"(?i)example|sample|dummy|placeholder|changeme|redacted|xxxx",)
#: Windows that are not secrets: runs of one symbol, sequences.
ALLOWED = (
    r"(.)\1{5}",
    r"(?i)abcdefgh|01234567|12345678",
)
#: Whole runs that are not secrets: unique ids and paths.
ALLOWED_RUNS = (
    r"\A[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}\z",
    r"\A[a-z]*(?:[/_-][a-z]*){3,}[0-9]*\z",
)

SPAN = "struct<kind:string,start:int,end:int>"


def _kind(spans: Column, kind: str, keep=None) -> Column:
    if keep is not None:
        spans = F.filter(spans, keep)
    return F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _ncn(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def best_window(value: Column, window: int = WINDOW) -> Column:
    """The highest entropy in bits of any ``window`` consecutive characters of an ASCII string (bits), and
    where the first such window begins (at, from 0); null for shorter strings."""
    codes = F.transform(F.split(value, ""), lambda ch: F.ascii(ch))
    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("total"),
        F.lit(-1.0).alias("best"), F.lit(0).alias("at"))

    def slide(a: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            entering, leaving = F.get(a, i), F.get(a, i - window)
            n_in = F.get(state["counts"], entering)
            more = state["total"] + _ncn(n_in + 1) - _ncn(n_in)
            # What leaves is counted after the entering symbol, which can be the same.
            n_out = F.get(state["counts"], leaving) + F.when(leaving == entering, 1).otherwise(0)
            total = F.when(leaving.isNull(), more).otherwise(more + _ncn(n_out - 1) - _ncn(n_out))
            counts = F.transform(state["counts"], lambda c, k: c
                                 + F.when(k == entering, 1).otherwise(0) - F.when(k == leaving, 1).otherwise(0))

            def kept(t: Column) -> Column:
                bits = F.log2(F.lit(float(window))) - t / window
                higher = (i >= window - 1) & (bits > state["best"] + 1e-9)
                return F.struct(
                    counts.alias("counts"), t.alias("total"), F.when(higher, bits).otherwise(state["best"]).alias("best"),
                    F.when(higher, i - (window - 1)).otherwise(state["at"]).alias("at"))

            return let(total, kept)

        return F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), start, step, lambda s: F.struct(
            s["best"].alias("bits"), s["at"].alias("at")))

    return F.when(F.char_length(value) >= window, let(codes, slide))


def max_entropy(value: Column, window: int = WINDOW) -> Column:
    """The highest entropy in bits of any window; null for shorter strings."""
    return best_window(value, window)["bits"]


def is_random(value: Column, window: int = WINDOW) -> Column:
    def listed(text: Column, patterns: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for pattern in patterns:
            out = out | text.rlike(pattern)
        return out

    least = (
        F.when(value.rlike(DIGITS_ONLY), DIGIT_BITS).when(value.rlike(HEX_ONLY), HEX_BITS)
        .when(value.rlike(LETTERS_ONLY), LETTER_BITS).otherwise(MIXED_BITS)
    )
    def judged(w: Column) -> Column:
        # The part between separators that holds the middle of the window.
        middle = w["at"] + window // 2
        part = F.concat(F.element_at(F.split(F.substr(value, F.lit(1), middle), "[^A-Za-z0-9]", -1), -1),
                        F.regexp_extract(F.substr(value, middle + 1), r"\A[A-Za-z0-9]*+", 0))
        known = listed(F.substr(value, w["at"] + 1, F.lit(window)), ALLOWED) | listed(part, ALLOWED_PARTS)
        return F.coalesce((w["bits"] >= least) & ~known, F.lit(False))

    return F.when(listed(value, ALLOWED_RUNS), F.lit(False)).otherwise(let(best_window(value, window), judged))


def secret_spans(text: Column) -> Column:
    """A struct of the spans of each kind and of all kinds in the order of start, then kind."""
    text = F.coalesce(text, F.lit(""))
    found = F.struct(
        _kind(find_spans(text, ASSIGN, 2), "assign", lambda s: F.char_length(s["group"]) >= 6).alias("assign"),
        _kind(find_spans(text, ACCESS), "access", lambda s: F.char_length(s["match"]) >= 20).alias("access"),
        _kind(find_spans(text, HEX), "hex").alias("hex"),
        _kind(find_spans(text, CANDIDATE), "entropy", lambda s: is_random(s["match"])).alias("entropy"),
    )

    def ordered(*parts: Column) -> Column:
        rank = {k: i for i, k in enumerate((*KINDS, "entropy"))}
        ranks = F.create_map(*(x for k, i in rank.items() for x in (F.lit(k), F.lit(i))))
        keyed = F.transform(F.concat(*parts), lambda s: F.struct(
            s["start"].alias("start"), ranks[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.array_sort(keyed)

    return let(found, lambda f: F.struct(
        F.size(f["assign"]).cast("long").alias("n_assign"), F.size(f["access"]).cast("long").alias("n_access"),
        F.size(f["hex"]).cast("long").alias("n_hex"), F.size(f["entropy"]).cast("long").alias("n_entropy"),
        ordered(f["assign"], f["access"], f["hex"]).alias("base"),
        ordered(f["assign"], f["access"], f["hex"], f["entropy"]).alias("spans")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, counts by kind, base and spans (arrays of start, rank, end, kind;
    code points, end exclusive). ``entropy`` spans may overlap others. Null and empty texts have no
    spans; ids may be null; repeated rows stay repeated; an empty table gives an empty one; other
    columns are ignored."""
    return row_struct(docs.select(id_col, text), [id_col], secret_spans(F.col(text)))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        id_col, "n_assign", "n_access", "n_hex",
        F.sha2(joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))
