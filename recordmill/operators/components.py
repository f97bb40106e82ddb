"""Connected components, and links inside groups that may be crowded.

Members of a group are linked when they are close; what counts is only which members such links join.
So a group never returns its pairs but one link per part that joins another, and the parts themselves
are found in steps: inside tiles of a bounded size, then among one head per part, and at last between
the members that are still outside the group's largest part and all others. Crowded groups whose members
are all alike, which is the common case, end after the heads; links grow with the members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.session import cut_lineage, join_side, shuffled

#: (rows of some groups, their group numbers) to the matrix of close rows; other groups' cells are ignored.
Near = Callable[[pd.DataFrame], np.ndarray]


#: Bytes of labels that are sent to every task of a round; all rounds together stay far below what a driver bears.
LABEL_BYTES = 4 * 1024 * 1024


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id in an edge (a, b). Labels shrink to the smallest
    label among neighbours and then to the label of that label, until nothing changes; every round is
    written, so a lost executor repeats one round at most."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.filter("a <> b"), "edges")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
    labels = join_side(labels.select("id", F.least("id", "m").alias("component")), "labels", LABEL_BYTES)
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("m"))
        low = labels.join(shuffled(near), F.col("id") == F.col("a")).select(
            "id", F.col("component").alias("old"), F.least("component", "m").alias("low"))
        over = labels.select(F.col("id").alias("low"), F.col("component").alias("jump"))
        new = join_side(
            low.join(over, "low").select("id", "old", F.least("low", "jump").alias("component")), "labels", LABEL_BYTES)
        labels = new.select("id", "component")
        if new.filter("old <> component").isEmpty():
            return labels


def _forest(near: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs of rows, one for each part that joins another, that join what all close pairs join.
    Parts are reached from one part of each connected piece outwards."""
    reached_part = np.zeros(part.max() + 1, bool)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while not reached_part.all():
        reached_part[np.flatnonzero(~reached_part)[0]] = True
        while True:
            inside = reached_part[part]
            outer = np.flatnonzero(~inside)
            cells = near[np.ix_(outer, np.flatnonzero(inside))]
            hit = np.flatnonzero(cells.any(axis=1))
            if not len(hit):
                break
            new, first = np.unique(part[outer[hit]], return_index=True)
            left.append(outer[hit[first]])
            right.append(np.flatnonzero(inside)[cells[hit[first]].argmax(axis=1)])
            reached_part[new] = True
    return np.concatenate(left), np.concatenate(right)


def _joined(frame: pd.DataFrame, near: Near, block: int) -> np.ndarray:
    """Close pairs of ids and their labels (a, b, x, y), one for each label of a group that joins another.
    Whole groups are compared together as far as they fill a block."""
    out = [np.zeros((0, 4), np.int64)]
    group = frame["group"].to_numpy()
    starts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(frame))
    at = 0
    while at + 1 < len(starts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + block, "right")) - 1)
        rows = frame.iloc[starts[at]:starts[end]]
        at = end
        g, labels = np.unique(rows["group"].to_numpy(), return_inverse=True)[1], rows["label"].to_numpy()
        if len(rows) < 2 or len(np.unique(labels)) == 1:
            continue
        close = near(rows) & (g[:, None] == g[None, :])
        np.fill_diagonal(close, True)
        alone = close.sum(axis=1) < 2
        part = np.unique(np.stack([g, labels], axis=1), axis=0, return_inverse=True)[1].ravel()
        keep = np.flatnonzero(~alone)
        if len(keep) < 2:
            continue
        part = np.unique(part[keep], return_inverse=True)[1]
        i, j = (keep[x] for x in _forest(close[np.ix_(keep, keep)], part))
        ids = rows["id"].to_numpy()
        out.append(np.stack([ids[i], ids[j], labels[i], labels[j]], axis=1))
    return np.concatenate(out)


def _by_group(frames: Iterator[pd.DataFrame], near: Near, block: int) -> Iterator[pd.DataFrame]:
    """Frames sorted by group, as they come; a group may go on in the next frame."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        ids = frame["group"].to_numpy()
        cut = int(np.flatnonzero(ids != ids[-1])[-1]) + 1 if len(ids) and (ids != ids[-1]).any() else 0
        rest = frame.iloc[cut:]
        if cut:
            yield pd.DataFrame(_joined(frame.iloc[:cut], near, block), columns=["a", "b", "x", "y"])
    if rest is not None and len(rest):
        yield pd.DataFrame(_joined(rest, near, block), columns=["a", "b", "x", "y"])


def _compared(rows: DataFrame, near: Near, block: int) -> DataFrame:
    """Close pairs (a, b) with their labels (x, y) that join the labels of rows (group, id, label, and what
    ``near`` reads)."""
    # In the order of ids, so that equal tiles of several keys give equal links.
    made = rows.repartition("group").sortWithinPartitions("group", "id")
    return cut_lineage(
        made.mapInPandas(lambda frames: _by_group(frames, near, block), "a long, b long, x long, y long").distinct(), "links")


def _tiles(n: Column, tile: int, weight: Column | None, tile_weight: int | None) -> Column:
    """How many tiles hold so many rows of such a weight: a power of two, so that the tiles of a row are
    the same in groups of about the same size."""
    needed = n / tile
    if weight is not None:
        needed = F.greatest(needed, weight / tile_weight)
    return F.call_function("shiftleft", F.lit(1), F.ceil(F.log2(F.greatest(needed, F.lit(1.0)))).cast("int"))


def _tile(tiles: Column) -> Column:
    return F.pmod(F.xxhash64("id"), tiles).cast("int")


def spanning_links(
    members: DataFrame, near: Near, tile: int, tile_weight: int | None = None,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    block: int | None = None,
) -> DataFrame:
    """Links (a, b) between ids that join, inside every group, what chains of close members join.

    ``members`` has key, id (both long), with ``tile_weight`` also weight, and the columns that ``near``
    and ``refine`` read; it is read several times, so it should be a written table or cheap. ``refine``
    adds a column finer, an array of numbers of which close members of one key share one at least:
    groups that still have several parts are then compared by it. Without it, or where that leaves crowded groups too, members
    outside the largest part meet all others tile by tile."""
    block = block or tile
    payload = [c for c in members.columns if c not in ("key", "id")]
    total = [F.sum("weight").alias("weight")] if tile_weight else []

    def sized(rows: DataFrame, *by: str) -> DataFrame:
        n = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *total)
        return n.select(*by, "n", _tiles(F.col("n"), tile, F.col("weight") if total else None, tile_weight).alias("tiles"))

    # Keys of one member, nearly all, are gone here; while the others are few, members stay where they are.
    sizes = join_side(sized(members, "key").filter("n > 1"), "group-sizes")
    dealt = members.join(sizes, "key").select(
        F.xxhash64("key", _tile(F.col("tiles"))).alias("group"), "id", F.col("id").alias("label"), *payload)
    links = _compared(dealt, near, block)
    crowded = sizes.filter("tiles > 1").select("key")
    if crowded.isEmpty():
        return links.select("a", "b")
    crowd = cut_lineage(members.join(join_side(crowded, "crowded"), "key", "left_semi"), "crowd")

    def split(rows: DataFrame, joined: DataFrame) -> DataFrame:
        """Members of crowded groups that still have several parts after labels were joined."""
        found = components(joined.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("id", "was")
        rows = cut_lineage(rows.join(found, F.col("label") == F.col("was"), "left").select(
            "key", "id", F.coalesce("component", "label").alias("label"), *payload), "parts")
        several = rows.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y")
        return cut_lineage(rows.join(join_side(several.select("key"), "split"), "key", "left_semi"), "split-parts")

    rows, before = split(crowd.withColumn("label", F.col("id")), links), None
    while True:
        first = rows.groupBy("key", "label").agg(F.min("id").alias("id"))
        heads = cut_lineage(rows.join(first, ["key", "label", "id"], "left_semi"), "heads")
        n = heads.count()
        if not n or (before is not None and 2 * n > before):
            break
        before = n
        spread = sized(heads, "key")
        joined = _compared(heads.join(spread, "key").select(
            F.xxhash64("key", _tile(F.col("tiles"))).alias("group"), "id", "label", *payload), near, block)
        if joined.isEmpty():
            break
        links, rows = links.unionByName(joined), split(rows, joined)
    links = links.select("a", "b")
    if not n:
        return links
    if refine is not None:
        finer = refine(rows).select("key", "id", "label", *payload, F.explode("finer").alias("finer"))
        rows = cut_lineage(finer.withColumn("key", F.xxhash64("key", "finer")).drop("finer"), "refined")
    return links.unionByName(_outside(rows, near, tile, tile_weight, block, payload, sized).select("a", "b"))


def _outside(rows: DataFrame, near: Near, tile: int, tile_weight: int | None, block: int, payload: list[str], sized) -> DataFrame:
    """Links between members outside the largest part of their group and all other members: every tile of
    those outside meets every tile of the group."""
    counts = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("key").agg(F.max_by("label", "n").alias("main"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    kept = cut_lineage(rows.join(largest.select("key", "main"), "key"), "several-parts")
    outside = kept.filter("label <> main")
    tiles = sized(kept, "key").select("key", F.col("tiles").alias("all_tiles")).join(
        sized(outside, "key").select("key", F.col("tiles").alias("outer_tiles")), "key")
    columns = ["id", "label", *payload]
    inner = kept.join(tiles, "key").select(
        "key", *columns, _tile(F.col("all_tiles")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("outer_tiles") - 1)).alias("j"))
    outer = outside.join(tiles, "key").select(
        "key", *columns, F.explode(F.sequence(F.lit(0), F.col("all_tiles") - 1)).alias("i"), _tile(F.col("outer_tiles")).alias("j"))
    met = inner.unionByName(outer).select(F.xxhash64("key", "i", "j").alias("group"), *columns)
    return _compared(met, near, block)
