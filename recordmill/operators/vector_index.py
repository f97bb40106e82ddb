"""Many cosine queries at once over an inverted-file index.

Cells are centroids fitted by k-means on a bounded sample; every stored vector goes to its nearest cell,
however many there are. A query visits the cells nearest to it, as many as the sample says are needed for
the recall asked for, and is scored there exactly. Cells that hold much are cut into tiles and their
queries into blocks, so one common vector loads no task, and each task sends on only the best of a tile.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordmill.session import cut_lineage

#: Most rows of the sample that cells and probes are fitted on, and its queries.
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 400
#: Vectors of a tile and queries of a block that meet in one task.
TILE, BLOCK = 4096, 512


def _units(column: pa.Array) -> np.ndarray:
    """Vectors at length 1; zero vectors stay zero."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    norm = np.sqrt(np.square(x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


@dataclass
class Index:
    """``table`` holds every usable row: key, v (unit vector), cell. ``probes`` cells are visited."""

    table: DataFrame
    key: str
    centroids: np.ndarray
    probes: int


def _fitted(x: np.ndarray, cells: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        home = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        norm = np.sqrt(np.square(sums).sum(axis=1, keepdims=True))
        centroids = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centroids)
    return centroids


def _needed(x: np.ndarray, centroids: np.ndarray, k: int, recall: float, seed: int) -> int:
    """The fewest cells that hold this share of the true neighbours of the sample's queries."""
    asked = np.random.default_rng(seed + 1).permutation(len(x))[:SAMPLE_QUERIES]
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -2
    k = min(k, len(x) - 1)
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else np.zeros((len(asked), 0), int)
    order = np.argsort(np.argsort(-(x[asked] @ centroids.T), axis=1), axis=1)
    home = (x @ centroids.T).argmax(axis=1)
    place = np.sort(np.take_along_axis(order, home[best], axis=1).ravel())
    return int(place[max(0, int(np.ceil(recall * len(place))) - 1)]) + 1 if len(place) else 1


def build_index(df: DataFrame, key: str, vector: str, k: int, cells: int = 64, recall: float = 0.97, seed: int = 7) -> Index | None:
    """Index of all rows whose vector is there, has only numbers and the most frequent length; None if
    there is none. The sample is the SAMPLE_ROWS rows of smallest hash, so it is the same in every run."""
    v = F.col(vector)
    usable = df.filter(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    size = usable.groupBy(F.size(vector).alias("d")).count().filter("d > 0").orderBy(F.desc("count"), "d").first()
    if size is None:
        return None
    rows = usable.filter(F.size(vector) == size["d"]).select(key, v.alias("v"))
    sample = rows.orderBy(F.xxhash64(key), key).limit(SAMPLE_ROWS).select("v").toArrow()
    x = _units(sample.column(0).combine_chunks())
    centroids = _fitted(x, cells, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                unit = _units(batch.column(1))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(unit.ravel()), unit.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), flat, pa.array((unit @ centroids.T).argmax(axis=1).astype(np.int32))], [key, "v", "cell"])

    kind = dict(df.dtypes)[key]
    table = cut_lineage(rows.mapInArrow(run, f"`{key}` {kind}, v array<double>, cell int"), "cells")
    return Index(table, key, centroids, _needed(x, centroids, k, recall, seed))


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """``(query, key, similarity, rank)``: for each row of ``queries`` (a part of the index's table) the
    ``k`` most similar other rows of the cells it visits, by exact cosine, ties by key."""
    key, kind = index.key, dict(index.table.dtypes)[index.key]
    centroids, probes = index.centroids, index.probes

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                near = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
                again = pa.array(np.repeat(np.arange(len(batch)), near.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(again), batch.column(1).take(again), pa.array(near.ravel())], ["query", "v", "cell"])

    asked = cut_lineage(queries.select(key, "v").mapInArrow(visits, f"query {kind}, v array<double>, cell int"), "visits")
    # One row per cell: how it and its queries are cut.
    held = index.table.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    wanted = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cuts = F.broadcast(cut_lineage(held.join(wanted, "cell"), "cuts"))  # at most as many rows as cells

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = index.table.join(cuts, "cell").select(
        "cell", F.pmod(F.xxhash64(key), "tiles").cast("int").alias("tile"), every("blocks").alias("block"), F.col(key).alias("key"), "v")
    right = asked.join(cuts, "cell").select(
        "cell", every("tiles").alias("tile"), F.pmod(F.xxhash64("query"), "blocks").cast("int").alias("block"), "query", "v")

    def best(rows: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(some):
            keys = rows["key"].to_numpy()
            by_key = np.argsort(keys, kind="stable")
            keys = keys[by_key]
            x = np.stack(rows["v"].to_numpy())[by_key]
            scores = np.stack(some["v"].to_numpy()) @ x.T
            for q, line in zip(some["query"], scores, strict=True):
                line = np.where(keys == q, -np.inf, line)
                n = min(k, len(line))
                # All that tie with the n-th, in the order of keys.
                least = np.partition(line, len(line) - n)[len(line) - n]
                at = np.flatnonzero((line >= least) & (line > -np.inf))
                at = at[np.argsort(-line[at], kind="stable")][:n]
                out.append(pd.DataFrame({"query": q, "key": keys[at], "similarity": line[at]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "key": [], "similarity": []})

    by = ["cell", "tile", "block"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(best, f"query {kind}, key {kind}, similarity double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "key")))
    return ranked.filter(F.col("rank") <= k).select("query", "key", F.round("similarity", 6).alias("similarity"), "rank")
