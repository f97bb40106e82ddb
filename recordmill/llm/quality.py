"""Quality rules as a short-circuit cascade.

Every rule is one Boolean column expression over the text and over counts that all rules share. Cost
and selectivity of each rule are measured on a small sample; the rules then run in order of rejected
rows per second, and a text that one rule rejects is not looked at by the later ones. The order can
change which rule is named as the reason, never whether a text is kept.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import WORD, let, row_struct, words
from recordmill.session import cut_lineage

#: Rows of the sample on which the cascade is ordered.
SAMPLE_ROWS = 400


def _repeats(w: Column) -> Column:
    """Words that lie in 3-word windows found at least twice in ``w``. Windows are compared by a
    64-bit hash; only texts with a repeated window sort their windows by hash and position."""
    windows = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        starts = F.array_sort(F.transform(twice, lambda x: x["p"]))
        return let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, b: a + b))

    return let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0),
    ).otherwise(let(
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), covered)))


def base_counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long). A null
    text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeats(w).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    ))


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


@dataclass(frozen=True)
class Rule:
    """Rejects a text where ``rejects`` is true. It takes the text and the shared counts."""

    name: str
    rejects: object

    def expression(self, text: Column, counts: Column) -> Column:
        return F.coalesce(self.rejects(text, counts), F.lit(False))


def _share_over(pattern: str, percent: int):
    """More matches of ``pattern`` than ``percent`` of the words."""
    return lambda t, c: 100 * F.regexp_count(t, F.lit(pattern)) > percent * c["n_words"]


#: A word none of whose characters is a lower-case letter, with two capitals at least.
CAPITALS = r"(?<![^\x20\x09-\x0D])[^\p{Ll}\x20\x09-\x0D]*\p{Lu}[^\p{Ll}\x20\x09-\x0D]*\p{Lu}[^\p{Ll}\x20\x09-\x0D]*(?![^\x20\x09-\x0D])"

DEFAULT_RULES = (
    Rule("symbols", lambda t, c: 10 * c["n_symbols"] > 3 * c["n_words"]),
    Rule("repeated_lines", lambda t, c: 2 * c["n_dup_lines"] > c["n_lines"]),
    Rule("word_length", lambda t, c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 15 * c["n_words"])),
    Rule("capitals", _share_over(CAPITALS, 50)),
    Rule("no_letters", lambda t, c: 2 * F.regexp_count(t, F.lit(r"\p{L}++")) < c["n_words"]),
    Rule("bullets", lambda t, c: 10 * F.regexp_count(t, F.lit(r"(?m)^[\x20\x09]*[-*•]")) > 9 * c["n_lines"]),
    Rule("ellipses", lambda t, c: 10 * F.regexp_count(t, F.lit(r"(?m)(\.\.\.|…)[\x20\x09]*$")) > 3 * c["n_lines"]),
)


def order_rules(docs: DataFrame, text: str = "text", rules=DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejected rows per second, measured on ``sample_rows`` rows; ties by name. Rules
    that reject nothing there come last, cheapest first."""
    sample = cut_lineage(docs.select(F.col(text).alias("t")).limit(sample_rows)
                         .select("t", base_counts(F.col("t")).alias("c")), "quality-sample")
    measured = []
    for rule in rules:
        began = time.perf_counter()
        hit = sample.agg(F.count_if(rule.expression(F.col("t"), F.col("c")))).first()[0] or 0
        seconds = max(time.perf_counter() - began, 1e-6)
        measured.append((-hit / seconds, seconds if not hit else 0.0, rule.name, rule))
    return [m[-1] for m in sorted(measured, key=lambda m: m[:3])]


def cascade(text: Column, counts: Column, rules) -> Column:
    """Name of the first rule that rejects, else null. Later branches are evaluated only for rows
    that earlier ones let pass; the base rule comes first, as its counts are there already."""
    text = F.coalesce(text, F.lit(""))
    chain = F.when(base_failed(counts), F.lit("base"))
    for rule in rules:
        chain = chain.when(rule.expression(text, counts), F.lit(rule.name))
    return chain


def quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules=DEFAULT_RULES,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: id, counts, base_failed, kept, rejected_by (first rule in the order of
    the cascade). Null and empty texts have zero words and fail the base rule; repeated rows stay
    repeated; an empty table gives an empty result; other columns are ignored."""
    ordered = order_rules(docs, text, rules, sample_rows)

    def judged(c: Column) -> Column:
        return F.struct(
            *(c[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
            base_failed(c).alias("base_failed"), cascade(F.col(text), c, ordered).alias("rejected_by"))

    rows = row_struct(docs.select(id_col, text), [id_col], let(base_counts(F.col(text)), judged))
    return rows.withColumn("kept", F.col("rejected_by").isNull())


def keep_quality(docs: DataFrame, text: str = "text", rules=DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    ordered = order_rules(docs, text, rules, sample_rows)
    verdict = let(base_counts(F.col(text)), lambda c: cascade(F.col(text), c, ordered))
    return docs.where(verdict.isNull())
