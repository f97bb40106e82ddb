"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words in order: the trimmed text, split at white space."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def row_struct(docs: DataFrame, ids: list[str], value: Column) -> DataFrame:
    """``ids`` and the fields of the struct ``value``, which is evaluated once per row: a generator
    is not merged into the projections above it."""
    return docs.select(*ids, F.inline(F.array(value)))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running_sum(values: Column) -> Column:
    """Inclusive prefix sums of an array, by doubling steps: n log n work on any length."""
    steps = F.expr("0") + F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    return F.aggregate(
        F.sequence(F.lit(0), steps),
        values,
        lambda sums, k: F.transform(
            sums,
            lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)),
        ),
    )


def find_spans(text: Column, pattern: str, group: int | None = None) -> Column:
    """All leftmost non-overlapping matches of a Java pattern as structs of start, end (code points,
    end exclusive), match and group. Matches and the pieces between them alternate, so running
    lengths give the positions."""
    def located(found: Column, inner: Column) -> Column:
        lengths = let(F.split(text, pattern, -1), lambda p: F.transform(
            found, lambda m, i: F.char_length(F.get(p, i)) + F.char_length(m)))
        return let(running_sum(lengths), lambda ends: F.transform(found, lambda m, i: F.struct(
            (F.get(ends, i) - F.char_length(m)).alias("start"), F.get(ends, i).alias("end"),
            m.alias("match"), F.get(inner, i).alias("group"))))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,match:string,group:string>>")
    spans = let(found, lambda m: let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda g: located(m, g)) if group else located(m, m))
    return F.when(text.rlike(pattern), spans).otherwise(none)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, joined by commas in the order given."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
