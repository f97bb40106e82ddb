"""Cosine search over stored vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def similar_vectors(df: DataFrame, key: str, vector: str, query: list[float], k: int) -> DataFrame:
    """The ``k`` rows closest to one query vector. The query is part of the plan, every row is
    scored where it lies, and each partition sends on only its best ``k``. Rows are ranked by
    the exact score; it is rounded afterwards."""
    q = F.array(*[F.lit(float(x)) for x in query])
    norm_q = sum(float(x) * float(x) for x in query) ** 0.5
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a * b), zero, lambda acc, x: acc + x)
    norm = F.sqrt(F.aggregate(v, zero, lambda acc, x: acc + x * x))
    score = F.when((norm > 0) & F.lit(norm_q > 0), dot / (norm * F.lit(norm_q))).otherwise(zero)
    return (
        df.select(key, score.alias("_score"))
        .orderBy(F.desc("_score"), F.asc(key))
        .limit(k)
        .select(key, F.round("_score", 6).alias("similarity"))
    )
