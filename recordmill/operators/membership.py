"""A persistent membership filter before exact lookups in a large store.

The filter is a bitmap over hashes of the stored keys, kept in rows of 32,768 bits by bucket and in
folders by a prefix of the bucket. A key whose bit is not set was never stored; only the others reach the
store, and they decide there by equality. So a run over new keys neither makes the store distinct nor
moves it, and adding keys rewrites only the folders they fall into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.session import cut_lineage, join_side

#: Bits for each stored key, so that about one absent key in sixteen is looked up in vain, and the range of
#: filter sizes in powers of two. A larger store only makes more keys pass on to the exact lookup.
BITS_PER_KEY, LEAST, MOST = 16, 15, 38
#: Folders of a filter.
PREFIXES = 64


def size_for(keys: int) -> int:
    """Powers of two of bits for so many keys."""
    return min(max((keys * BITS_PER_KEY - 1).bit_length(), LEAST), MOST)


def _place(keys: list[str], bits: int) -> Column:
    """1 … 2^bits, as the bitmap functions count. Nulls are hashed like values."""
    shown = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.pmod(F.xxhash64(*shown), F.lit(1 << bits)) + 1


def _bitmaps(stored: DataFrame, keys: list[str], bits: int) -> DataFrame:
    place = _place(keys, bits)
    return stored.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))


def _write(rows: DataFrame, path: str, bits: int) -> None:
    rows.select("bucket", "bitmap", F.lit(bits).alias("bits"), F.pmod("bucket", F.lit(PREFIXES)).alias("prefix")).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("prefix").parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    # The schema is given because the filter of an empty store has no files.
    return spark.read.schema("bucket long, bitmap binary, bits int, prefix long").parquet(path)


def build(stored: DataFrame, keys: list[str], path: str, bits: int | None = None) -> None:
    """Writes the filter of all stored keys."""
    bits = bits or size_for(stored.count())
    _write(_bitmaps(stored, keys, bits), path, bits)


def extend(spark: SparkSession, new: DataFrame, keys: list[str], path: str) -> None:
    """Adds the keys of ``new``. Bits are only ever set, so an attempt that dies in between leaves a filter
    that is still right, and running it again gives the same one."""
    now = _read(spark, path)
    held = now.select("bits").first()
    if held is None:
        return build(new, keys, path)
    bits = held[0]
    more = _bitmaps(new, keys, bits)
    touched = sorted(r[0] for r in more.select(F.pmod("bucket", F.lit(PREFIXES)).alias("p")).distinct().collect())
    both = now.filter(F.col("prefix").isin(touched)).select("bucket", "bitmap").unionByName(more)
    merged = both.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    # Folders are read and written anew, so the rows settle in between.
    _write(cut_lineage(merged, "bitmaps"), path, bits)


def maybe_known(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """``df`` with ``maybe``: false if its key was never stored."""
    table = _read(df.sparkSession, path)
    first = table.select("bits").first()
    if first is None:
        return df.withColumn("maybe", F.lit(False))
    maps = join_side(table.select("bucket", "bitmap"), "membership")
    placed = df.withColumn("_p", _place(keys, first[0]))
    met = placed.withColumn("bucket", F.bitmap_bucket_number("_p")).join(maps, "bucket", "left")
    at = F.bitmap_bit_position("_p")
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1))
    return met.withColumn("maybe", F.coalesce(bit == 1, F.lit(False))).select(*df.columns, "maybe")


def _known(maybe: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``maybe`` that the store holds. Few are sent to the store where it lies."""
    asked = join_side(maybe.select(*keys).distinct(), "asked")
    return stored.select(*keys).join(asked, keys, "left_semi").distinct()


def skip_known(df: DataFrame, stored: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Rows whose key the store does not hold. A row with a null in its key is never known."""
    met = maybe_known(df, keys, path)
    sure, maybe = met.filter(~F.col("maybe")).drop("maybe"), met.filter("maybe").drop("maybe")
    known = join_side(_known(maybe, stored, keys), "known-keys")
    return sure.unionByName(maybe.join(known, keys, "left_anti").select(*df.columns))


def only_known(df: DataFrame, stored: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Rows whose key the store holds."""
    maybe = maybe_known(df, keys, path).filter("maybe").drop("maybe")
    known = join_side(_known(maybe, stored, keys), "known-keys")
    return maybe.join(known, keys, "left_semi").select(*df.columns)
