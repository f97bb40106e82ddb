"""Entity names, domains and ids."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from recordmill.fixed_values import LEGAL_SUFFIXES, SPACE, WORD
from recordmill.functions.text import strip, whole_words


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def compatibility_form(c: Column) -> Column:
    """Unicode NFKC, which Spark lacks. Plain ASCII never changes, so only other rows carry their
    text to Python; the rest send a null."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def normalize_ascii_entity(c: Column) -> Column:
    """Everything after the NFKC step; stays in the JVM."""
    text = F.lower(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(text, f"(?<={WORD})&(?={WORD})", "and")
    text = F.regexp_replace(text, r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x{85}\p{Z}]", " ")
    text = F.regexp_replace(text, whole_words(LEGAL_SUFFIXES), "")
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def normalize_entity(c: Column) -> Column:
    return normalize_ascii_entity(compatibility_form(c))


def normalize_domain(c: Column) -> Column:
    text = F.lower(strip(F.coalesce(c, F.lit(""))))
    text = F.regexp_replace(text, "^https?://", "")
    host = F.regexp_extract(text, r"^[^/?#:]*", 0)
    return strip(F.regexp_replace(host, r"^www\.", ""))


def entity_id(entity_type: Column, name: Column) -> Column:
    key = F.concat(F.lower(entity_type), F.lit(":"), strip(F.lower(name)))
    return F.concat(F.lit("cent_"), F.substring(F.sha2(key, 256), 1, 12))


def title_case(c: Column) -> Column:
    return F.initcap(c)


def _jaro_winkler(a: str | None, b: str | None, scale: float = 0.1, longest: int = 4) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = list(range(len(b)))
    matched_a, matched_at = [], []
    for i, ch in enumerate(a):
        j = next((j for j in free if abs(i - j) <= reach and b[j] == ch), None)
        if j is not None:
            free.remove(j)
            matched_a.append(ch)
            matched_at.append(j)
    m = len(matched_a)
    if m == 0:
        return 0.0
    matched_b = [b[j] for j in sorted(matched_at)]
    t = sum(x != y for x, y in zip(matched_a, matched_b)) // 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3.0
    prefix = 0
    for x, y in zip(a[:longest], b[:longest]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * scale * (1.0 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two names; the prefix bonus applies at every score."""
    return pd.Series([_jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")
