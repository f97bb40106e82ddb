"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "recordmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution, and stream state kept on disk instead of on
    the heap. Partition counts are left to AQE and the cluster's own configuration."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Folders of intermediate tables by application, in the order they were made.
_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that every executor reaches: ``spark.checkpoint.dir``. Where the
    session names none, a temporary folder is made and used, but only if driver and executors are
    one process; on a cluster that is an error, as executors would write to their own disks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="recordmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/recordmill/{purpose}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> None:
    """Deletes the intermediate tables of this application, from the ``since``-th on. Frames that
    read them cannot be used afterwards."""
    made = _MADE.get(spark.sparkContext.applicationId, [])
    for path in made[since:]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    del made[since:]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """A job whose results are written inside the block; its intermediate tables go at the end."""
    since = len(_MADE.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, since)


def cut_lineage(df: DataFrame, purpose: str, *by: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several outputs share one computation and a
    lost executor re-reads files instead of recomputing the whole history. With ``by`` columns the
    files are in a folder per value, and a filter on them reads only its own."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


BROADCAST_BYTES = 32 * 1024 * 1024


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that no driver gathers. Left alone, Spark broadcasts what fills less than its
    threshold *compressed*: columns of numbers take many times that in the driver."""
    return df.hint("merge")


def join_side(df: DataFrame, purpose: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """One side of a join, written to the shared folder and measured while it is written. Up to
    ``limit`` bytes of text it is marked for broadcast, which spares the other side its shuffle;
    beyond that both sides are shuffled, and AQE splits skewed partitions."""
    watch = Observation()
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("bytes")
    table = cut_lineage(df.observe(watch, size), purpose)
    return F.broadcast(table) if (watch.get["bytes"] or 0) <= limit else shuffled(table)
