"""Reading landed payloads and record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.fixed_values import READABLE_TABLES
from recordmill.schemas import RAW_PAYLOAD, RSS_ITEM


def raw_scan(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Landed payloads. Parquet and JSON carry every column; with ``text`` each file is a payload
    and its path the URL."""
    if kind == "text":
        files = spark.read.text(path, wholetext=True)
        return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("raw_content"))
    return spark.read.schema(RAW_PAYLOAD).format(kind).load(path)


def read_feed_items(spark: SparkSession, path: str) -> DataFrame:
    """Items straight from feed files; large files are split between tasks at item tags."""
    return spark.read.format("xml").option("rowTag", "item").schema(RSS_ITEM).load(path)


def table_read(spark: SparkSession, folder: str, name: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """A record table by name. Names outside the list are refused."""
    if name not in READABLE_TABLES and name not in extra:
        raise ValueError(f"no readable table is called {name!r}")
    return spark.read.parquet(f"{folder}/{name}.parquet")
