"""The record lifecycle on continuous input.

Every sink is safe against a replayed batch: what a batch writes goes to a folder named after the
batch id and replaces what an earlier attempt may have left there. State is folded when it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from recordmill.functions.text import url_fingerprint
from recordmill.functions.times import freshness
from recordmill.operators.audits import crawl_counters
from recordmill.operators.dedup import checkpoint_fold, fold_checkpoints, pick_by
from recordmill.operators.sinks import landed
from recordmill.operators.upsert import fold_by_key
from recordmill.operators.validate import present_types, split_valid, validate_by_type
from recordmill.session import ROCKSDB
from recordmill.streaming.levels import Log


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def _replace(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_batch_folder(path, batch_id))


def _start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
        .trigger(availableNow=True)
        .start()
    )


def stream_land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Continuous landing, one folder per source and day. The file sink keeps its own commit log."""
    return (
        landed(stream).writeStream.format("parquet")
        .partitionBy("source_name", "fetch_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class _Claims(StatefulProcessor):
    """Per URL the end of the claim that holds, and a timer that forgets it."""

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(rows, ignore_index=True).sort_values(["seq", "ts", "url"], na_position="first", kind="stable")
        until = self.until.get()[0] if self.until.exists() else None
        before, kept = until, []
        for i, ms in zip(arrived.index, arrived["ts"].astype("datetime64[ms]").astype("int64"), strict=True):
            if until is None or ms >= until:
                kept.append(i)
                until = ms + self.ttl_ms
        if kept:
            if before is not None:
                self.handle.deleteTimer(before)
            self.until.update((until,))
            self.handle.registerTimer(until)
            yield arrived.loc[kept, ["url_hash", "seq", "ts", "url"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def dedup_ttl(stream: DataFrame, ts: str = "ts", ttl_hours: float = 24, lateness: str = "24 hours") -> DataFrame:
    """Claims of URLs (url_hash, seq, ts, url): an arrival claims its URL for the time to live, counted in
    event time, and later arrivals within it are dropped; one beyond it claims anew. Inside a batch
    the lowest ``seq`` comes first (a null before all), so a replay decides as before. The state holds a
    number per claimed URL and is dropped by an event-time timer once the watermark passes its end."""
    claims = stream.select(
        url_fingerprint(F.col("url")).alias("url_hash"), F.col("seq").cast("long").alias("seq"),
        F.col(ts).cast("timestamp").alias("ts"), "url",
    ).withWatermark("ts", lateness)
    return claims.groupBy("url_hash").transformWithStateInPandas(
        _Claims(int(ttl_hours * 3_600_000)), "url_hash string, seq long, ts timestamp, url string", "Append", "EventTime")


def stream_dedup_ttl(
    stream: DataFrame, path: str, checkpoint: str, ts: str = "ts", ttl_hours: float = 24, lateness: str = "24 hours"
) -> StreamingQuery:
    """Values and timers of a key are column families, which only RocksDB keeps, whatever state store the
    session names for other streams; a query keeps the one it was started with."""
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, ROCKSDB)
    try:
        return _start(
            dedup_ttl(stream, ts, ttl_hours, lateness), lambda df, n: _replace(df, path, n), checkpoint
        )
    finally:
        conf.set(name, before)


def stream_fresh_gate(
    stream: DataFrame, path: str, checkpoint: str, clock: Callable[[int], Column],
    published: str = "published",
) -> StreamingQuery:
    """Gate every row against the time of its batch; ``clock`` gives that time for a batch id, so a
    replay decides as before."""
    def each(df: DataFrame, batch_id: int) -> None:
        gated = df.withColumn("gate", freshness(F.col(published), clock(batch_id)))
        _replace(gated, path, batch_id)

    return _start(stream, each, checkpoint)


def _states(spark: SparkSession, path: str) -> Log:
    return Log(spark, path, fold_checkpoints)


def stream_checkpoint_state(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """State events folded per URL and batch into a levelled log. What a batch contributes is a small
    aggregate, so nothing has to be kept in the stream's own state, however many URLs there are."""
    return _start(stream, lambda df, n: _states(df.sparkSession, path).append(checkpoint_fold(df), n), checkpoint)


def checkpoint_states(spark: SparkSession, path: str) -> DataFrame:
    """The checkpoints behind :func:`stream_checkpoint_state`: last state and error, all updates."""
    return _states(spark, path).read()


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current rows of an update-mode sink: per key those of the last batch that wrote it."""
    log = spark.read.option("basePath", path).parquet(path)
    return pick_by(log, keys, "batch_id", newest=True).drop("batch_id")


def _merged(spark: SparkSession, path: str, key: str, seq: str, updated: list[str]) -> Log:
    return Log(spark, path, lambda df: fold_by_key(df, key, seq, updated))


def stream_upsert(
    stream: DataFrame, path: str, checkpoint: str, key: str, seq: str, updated: list[str]
) -> StreamingQuery:
    """Arrivals folded per key and batch into a levelled log: the last values of ``updated`` columns, the
    first of all others."""
    def each(df: DataFrame, batch_id: int) -> None:
        _merged(df.sparkSession, path, key, seq, updated).append(df, batch_id)

    return _start(stream, each, checkpoint)


def upserted(
    spark: SparkSession, path: str, key: str, seq: str, updated: list[str]
) -> DataFrame:
    """The merged table behind :func:`stream_upsert`."""
    return _merged(spark, path, key, seq, updated).read().drop("first_seq")


def stream_dlq_split(
    stream: DataFrame, records: str, dead: str, checkpoint: str
) -> StreamingQuery:
    """Validated records and dead letters; each batch is read and validated once."""
    def each(df: DataFrame, batch_id: int) -> None:
        batch = df.persist()
        checked = validate_by_type(batch, types=present_types(batch)).persist()
        good, bad = split_valid(checked)
        _replace(good, records, batch_id)
        _replace(bad, dead, batch_id)
        checked.unpersist()
        batch.unpersist()

    return _start(stream, each, checkpoint)


def source_metrics(stream: DataFrame, width: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Crawl counters per source and tumbling window of ``ts``."""
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width).alias("w"), F.lower("source_name").alias("source_name"))
        .agg(*crawl_counters())
        .withColumn("window_start", F.col("w.start"))
        .drop("w")
    )


def stream_source_metrics(
    stream: DataFrame, path: str, checkpoint: str, width: str = "1 hour", lateness: str = "2 hours"
) -> StreamingQuery:
    return _start(
        source_metrics(stream, width, lateness), lambda df, n: _replace(df, path, n), checkpoint,
        "update",
    )
