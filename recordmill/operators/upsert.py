"""Merges by key on plain tables: a new version is computed as one keyed aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.fixed_values import UPSERT_UPDATED
from recordmill.operators.dedup import pick_by
from recordmill.session import cut_lineage, join_side

#: Places in the order of a key: a stored row comes before every arrival, and an arrival without a
#: place comes before those that have one.
STORED, UNPLACED = -(1 << 63), -(1 << 63) + 1


def fold_by_key(df: DataFrame, key: str, seq: str, updated: list[str], first: str = "first_seq") -> DataFrame:
    """One row per key with the columns of ``df`` and ``first``: ``updated`` columns and ``seq`` come
    from the last row of the key, all others from the first, whose ``seq`` is ``first``. Rows may be
    folds themselves (if ``df`` has the column ``first``), so folds of parts fold to that of the whole.

    Both ends are whole rows cut to one per key and task before the shuffle. Rows without ``seq`` come
    before all others; of rows with equal ``seq`` the same one is taken in every run."""
    if first not in df.columns:
        df = df.withColumn(first, F.col(seq))
    columns = df.columns
    kept = [c for c in columns if c not in (key, seq, *updated)]
    head = pick_by(df, [key], first, newest=False).select(F.col(key).alias("_key"), *kept)
    last = pick_by(df, [key], seq, newest=True).select(key, seq, *updated)
    return last.join(head, F.col(key).eqNullSafe(F.col("_key"))).select(*columns)


def merge_by_key(df: DataFrame, key: str, seq: str, updated: list[str]) -> DataFrame:
    """One row per key. ``updated`` columns come from the last arrival, all others keep the value
    of the first."""
    return fold_by_key(df, key, seq, updated, "_first").select(*df.columns)


def _merge_into(
    stored: DataFrame, arrivals: DataFrame, key: str, updated: list[str]
) -> DataFrame:
    """Next version of ``stored``, which has one row per key. Stored rows precede every arrival;
    arrivals without ``seq`` precede the others.

    Rows whose key does not arrive pass through as they are. With few arrivals their keys are
    broadcast, and the stored table is neither shuffled nor sorted."""
    keys = join_side(arrivals.select(F.col(key).alias("_arriving")).distinct(), "arriving-keys")
    same = F.col(key).eqNullSafe(F.col("_arriving"))

    touched = stored.join(keys, same, "left_semi").select(*stored.columns)
    both = touched.withColumn("_turn", F.lit(STORED)).unionByName(
        arrivals.withColumn("_turn", F.coalesce(F.col("seq").cast("long"), F.lit(UNPLACED)))
    )
    merged = merge_by_key(both, key, "_turn", updated).drop("_turn")
    untouched = stored.join(keys, same, "left_anti").select(*stored.columns)
    return untouched.unionByName(merged)


def upsert_records(table: str, stored: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Next version of a record table, merged by source URL."""
    return _merge_into(stored, arrivals, "source_url", [*UPSERT_UPDATED[table], "seq"])


def upsert_entities(stored: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Next version of the entity master: by id, everything but id, type, creation time and place
    in the order is replaced."""
    fixed = ("canonical_entity_id", "entity_type", "created_at", "seq")
    updated = [c for c in stored.columns if c not in fixed]
    return _merge_into(stored, arrivals, "canonical_entity_id", updated)


def upsert_entity(stored: DataFrame, arrivals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next version of the entity master, and the arrivals it refuses, each with the entity that
    holds its name.

    (type, normalised name) belongs to one entity: to the stored one, else to the first arrival that
    claims it. An arrival of another id is refused whole; a name that a rename gives up stays taken
    until the next merge. The type that counts is the one the id keeps: that of its stored row, else of
    its first arrival. Arrivals without an id or without a name claim nothing and are refused."""
    ident = "canonical_entity_id"
    place = F.coalesce(F.col("seq").cast("long"), F.lit(UNPLACED))
    claims = stored.select(ident, "entity_type", "normalized_name", F.lit(STORED).alias("_turn")).unionByName(
        arrivals.select(ident, "entity_type", "normalized_name", place.alias("_turn")))
    kept_type = pick_by(claims.select(ident, "entity_type", "_turn"), [ident], "_turn", newest=False).select(
        F.col(ident).alias("_id"), F.col("entity_type").alias("_type"))
    named = claims.join(kept_type, F.col(ident) == F.col("_id")).filter(F.col("normalized_name").isNotNull())
    holders = pick_by(named.select("_type", "normalized_name", ident, "_turn"), ["_type", "normalized_name"], "_turn", newest=False)
    holders = holders.select(
        F.col("_type").alias("_held_type"), F.col("normalized_name").alias("_held_name"), F.col(ident).alias("held_by"))
    typed = arrivals.join(kept_type, F.col(ident) == F.col("_id"), "left")
    judged = typed.join(
        holders, F.col("_type").eqNullSafe(F.col("_held_type")) & (F.col("normalized_name") == F.col("_held_name")), "left")
    judged = cut_lineage(judged.select(*arrivals.columns, "held_by"), "entity-claims")
    own = F.coalesce(F.col("held_by") == F.col(ident), F.lit(False))
    return upsert_entities(stored, judged.filter(own).drop("held_by")), judged.filter(~own)


def entity_name_conflicts(entities: DataFrame) -> DataFrame:
    """(type, normalised name) pairs that more than one entity claims."""
    return (
        entities.groupBy("entity_type", "normalized_name")
        .agg(F.count_distinct("canonical_entity_id").alias("entities"))
        .filter(F.col("entities") > 1)
    )


def append_new(stored: DataFrame, arrivals: DataFrame, key: str) -> DataFrame:
    """Arrivals whose key is not stored, one row per key (the first)."""
    fresh = arrivals.join(stored.select(key).distinct(), key, "left_anti")
    return pick_by(fresh, [key], "seq", newest=False)


def prune_to_allowlist(stored: DataFrame, accepted: DataFrame, key: str) -> DataFrame:
    return stored.join(accepted.select(key).distinct(), key, "left_semi")
