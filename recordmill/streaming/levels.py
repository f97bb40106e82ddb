"""A levelled log of folds behind a stream, read as one table.

A batch writes one run, folded so that it holds one row per key. ``fanout`` runs of a level are folded to
one run of the next, so after n batches a key lies in at most (fanout - 1) files on each of
log(n) levels, however long the stream runs. Which runs count is written in a manifest, one file per
commit that appears under its name by a rename; readers take the newest, so they see a batch and its
merges wholly or not at all. A batch that comes again under its id finds itself in the manifest and
changes nothing; one that died before its commit leaves a run that no manifest names and that the next
attempt replaces.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Fold = Callable[[DataFrame], DataFrame]


class Log:
    """``fold`` makes one row per key from rows or from folds of them."""

    def __init__(self, spark: SparkSession, path: str, fold: Fold, fanout: int = 8) -> None:
        self.spark, self.path, self.fold, self.fanout = spark, path.rstrip("/"), fold, fanout
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _manifests(self) -> list[str]:
        folder = self._at("manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self) -> dict | None:
        """The newest: number, schema, runs (level, first and last batch, folder), and the folders that
        its commit took out of use."""
        names = self._manifests()
        if not names:
            return None
        text = self.spark.read.text(f"{self.path}/manifests/{names[-1]}", wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, manifest: dict) -> None:
        name = f"{manifest['number']:012d}.json"
        draft, final = self._at(f"manifests/.{name}"), self._at(f"manifests/{name}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(draft, final):
            raise FileExistsError(f"another writer committed {name} in {self.path}")

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Adds a batch, merges full levels, and commits both at once. Folders that the commit before
        took out of use are deleted: its readers have had one batch's time."""
        now = self.manifest() or {"number": 0, "runs": [], "unused": [], "schema": None}
        if any(r["first"] <= batch_id <= r["last"] for r in now["runs"]):
            return
        folded = self.fold(batch)
        runs = [*now["runs"], self._written(folded, 0, batch_id, batch_id)]
        written = {r["folder"] for r in runs}
        level = 0
        while len(full := [r for r in runs if r["level"] == level]) >= self.fanout:
            rows = self._rows(full, folded.schema)
            merged = self._written(self.fold(rows), level + 1, min(r["first"] for r in full), max(r["last"] for r in full))
            runs = [r for r in runs if r["level"] != level] + [merged]
            written.add(merged["folder"])
            level += 1
        unused = sorted(written - {r["folder"] for r in runs})
        self._commit({"number": now["number"] + 1, "runs": runs, "unused": unused, "schema": folded.schema.json()})
        for folder in now["unused"]:
            self._fs.delete(self._at(folder), True)
        for name in self._manifests()[:-2]:
            self._fs.delete(self._at(f"manifests/{name}"), False)

    def _written(self, rows: DataFrame, level: int, first: int, last: int) -> dict:
        folder = f"runs/level-{level}-{first}-{last}"
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        return {"level": level, "first": first, "last": last, "folder": folder}

    def _rows(self, runs: list[dict], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{r['folder']}" for r in runs])

    def read(self) -> DataFrame:
        """The fold of everything committed."""
        now = self.manifest()
        if now is None:
            raise FileNotFoundError(f"nothing was committed in {self.path}")
        return self.fold(self._rows(now["runs"], T.StructType.fromJson(json.loads(now["schema"]))))
