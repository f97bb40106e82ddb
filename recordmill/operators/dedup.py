"""Duplicate URLs, changed content, and anti joins against what is already stored.

"First" and "latest" rows are the first of a window per key. Spark cuts such a window to one row per key
and task before it shuffles, so a key that holds a large part of all rows sends one row from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill.functions.text import content_hash, url_fingerprint


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns, which settles the order of rows that are equal in everything else."""
    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return F.xxhash64(*[
        F.col(f"`{f.name}`") if plain(f.dataType) else F.to_json(F.struct(f"`{f.name}`")) for f in df.schema.fields
    ])


def pick_by(df: DataFrame, keys: list[str], order: str, newest: bool, ties: tuple[str, ...] = ()) -> DataFrame:
    """Exactly one whole row per key: the one with the lowest or the highest ``order``. A null order is
    lower than all others; of rows with equal order the one with the lowest ``ties``, and where these are
    equal too the same one in every run. A null key is a key of its own."""
    columns = df.columns
    place = F.col(order).desc_nulls_last() if newest else F.col(order).asc_nulls_first()
    window = Window.partitionBy(*keys).orderBy(place, *ties, F.col("_tie"))
    ranked = df.withColumn("_tie", row_hash(df)).withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).select(*columns)


def dedup_by_url(df: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """The first row per URL fingerprint, by ``seq`` (a null before all) and then by URL; fingerprints
    already in ``store`` are dropped."""
    hashed = df.withColumn("url_hash", url_fingerprint(F.col("url")))
    if store is not None:
        hashed = hashed.join(store.select("url_hash"), "url_hash", "left_anti")
    return pick_by(hashed, ["url_hash"], "seq", newest=False, ties=("url",))


def dedup_report(df: DataFrame) -> DataFrame:
    """Every row with its fingerprint and whether an earlier row claimed it; rows without ``seq`` come
    before all others, and rows of one ``seq`` claim together. The claims are one row per fingerprint,
    so in the join back only the row side can be skewed, and AQE splits it."""
    hashed = df.withColumn("url_hash", url_fingerprint(F.col("url")))
    claims = hashed.groupBy("url_hash").agg(
        F.min("seq").alias("first_seq"), F.max(F.col("seq").isNull()).alias("_unplaced"))
    later = F.when(F.col("_unplaced"), F.col("seq").isNotNull()).otherwise(F.col("seq") > F.col("first_seq"))
    return hashed.join(claims, "url_hash").withColumn("is_duplicate", later).drop("_unplaced")


def ledger(df: DataFrame) -> DataFrame:
    """Landing metadata of raw payloads, bodies left behind."""
    return df.select("seq", "url", content_hash(F.col("raw_content")).alias("content_hash"))


def latest_content_hash(rows: DataFrame) -> DataFrame:
    return pick_by(rows.select("url", "content_hash", "seq"), ["url"], "seq", newest=True)


def unchanged_content(fetched: DataFrame, known: DataFrame) -> DataFrame:
    """Fetched rows whose (url, hash) the ledger has held at any time."""
    seen = known.select("url", "content_hash").distinct()
    return fetched.join(seen, ["url", "content_hash"], "left_semi")


def skip_known(df: DataFrame, stored: DataFrame, key: str = "url") -> DataFrame:
    return df.join(stored.select(key).distinct(), key, "left_anti")


def completed_urls(states: DataFrame) -> DataFrame:
    return states.filter(F.col("state") == "STORED").select("source_url")


def change_cases(fetched: DataFrame, known: DataFrame, states: DataFrame) -> DataFrame:
    """What to do with each fetched row, given the ledger before the fetch and the states:

    ``SKIP``       stored, and a payload is on file (no refetch forced)
    ``UNCHANGED``  refetched although stored, and the content has been seen before
    ``REPROCESS``  stored, but the content is new
    ``PROCESS``    everything else
    """
    on_file = known.groupBy("url").agg(F.lit(True).alias("on_file"))
    seen = known.groupBy("url", "content_hash").agg(F.lit(True).alias("seen"))
    state = states.select(F.col("source_url").alias("url"), "state")
    stored = F.coalesce(F.col("state") == "STORED", F.lit(False))
    forced = F.coalesce(F.col("force_refetch"), F.lit(False))
    case = (
        F.when(stored & F.col("on_file").isNotNull() & ~forced, F.lit("SKIP"))
        .when(stored & F.col("seen").isNotNull(), F.lit("UNCHANGED"))
        .when(stored, F.lit("REPROCESS"))
        .otherwise(F.lit("PROCESS"))
    )
    return (
        fetched.join(state, "url", "left")
        .join(on_file, "url", "left")
        .join(seen, ["url", "content_hash"], "left")
        .withColumn("case", case)
        .drop("on_file", "seen")
    )


def checkpoint_fold(events: DataFrame) -> DataFrame:
    """State events folded to one checkpoint per URL: last state and error, number of updates."""
    updates = events.groupBy(F.col("source_url").alias("_url")).agg(F.count(F.lit(1)).alias("attempt_count"))
    last = pick_by(events.select("source_url", "seq", "state", "error"), ["source_url"], "seq", newest=True)
    return last.join(updates, F.col("source_url").eqNullSafe(F.col("_url"))).select(
        "source_url", "state", "attempt_count", F.col("error").alias("last_error"), F.col("seq").alias("updated_seq")
    )


def fold_checkpoints(folds: DataFrame) -> DataFrame:
    """Checkpoints of parts of the events, as :func:`checkpoint_fold` gives them, to those of all."""
    total = folds.groupBy(F.col("source_url").alias("_url")).agg(F.sum("attempt_count").alias("_total"))
    last = pick_by(folds, ["source_url"], "updated_seq", newest=True)
    return last.join(total, F.col("source_url").eqNullSafe(F.col("_url"))).select(
        "source_url", "state", F.col("_total").alias("attempt_count"), "last_error", "updated_seq"
    )


def candidate_fresh(df: DataFrame, seen: DataFrame) -> DataFrame:
    """Undated rows whose URL fingerprint was never seen on its source."""
    undated = df.filter(F.coalesce(F.col("published"), F.lit("")) == "").withColumn(
        "url_hash", url_fingerprint(F.col("url"))
    )
    return undated.join(seen.select("url_hash").distinct(), "url_hash", "left_anti")
