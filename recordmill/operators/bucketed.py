"""Record tables laid out in hash buckets, merged without moving what is stored.

A table is partitioned into slots, each one version of one bucket of the key's hash, and bucketed by the
same hash, so Spark reads the stored side of a merge as it lies: only the arrivals are shuffled, bucket
meets bucket, and only the buckets that arrivals fall into are read and written anew, as new slots. A
manifest names the slot of every bucket; it is written under a new name by a rename, so readers see a
merge wholly or not at all, and what an unfinished merge wrote is named by no manifest.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill.operators.upsert import fold_by_key
from recordmill.session import cut_lineage


class BucketTable:
    """A table at ``path`` with one row per ``key``. The number of buckets is fixed when it is made."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.name = "buckets_" + re.sub(r"\W", "_", self.path.rsplit("/", 1)[-1]) + f"_{zlib.crc32(self.path.encode()):08x}"
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def manifest(self) -> dict | None:
        """The newest: number, schema, buckets, and the slot of each bucket that has rows."""
        folder = self._hadoop.Path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return None
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(folder))
        names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
        if not names:
            return None
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{names[-1]}", wholetext=True).first()[0])

    def _commit(self, manifest: dict) -> None:
        name = f"{manifest['number']:012d}.json"
        draft, final = (self._hadoop.Path(f"{self.path}/manifests/{n}") for n in (f".{name}", name))
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(draft, final):
            raise FileExistsError(f"another merge committed {name} in {self.path}")

    def _table(self, schema: T.StructType, slots: list[str]) -> DataFrame:
        """The rows of some slots. The catalog of this session learns table and slots from the manifest."""
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {self.name} ({columns}, _slot STRING) USING parquet PARTITIONED BY (_slot) "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/data'")
        if slots:
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (_slot='{s}')" for s in slots))
        return self.spark.table(self.name).filter(F.col("_slot").isin(slots) if slots else F.lit(False)).drop("_slot")

    def read(self) -> DataFrame:
        now = self.manifest()
        if now is None:
            raise FileNotFoundError(f"nothing was committed in {self.path}")
        return self._table(T.StructType.fromJson(json.loads(now["schema"])), sorted(now["slots"].values()))

    def bucket(self) -> Column:
        """The bucket of a row, as Spark deals rows of a bucketed table."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def merged(self, arrivals: DataFrame, updated: list[str], touched: list[str], schema: T.StructType) -> DataFrame:
        """Rows of the touched slots with the arrivals (one per key): a stored row keeps what is not
        ``updated``, a new one comes whole."""
        fresh = arrivals.select(*[F.col(f"`{n}`").alias(f"new_{i}") for i, n in enumerate(schema.names)], F.lit(True).alias("_arrived"))
        at = schema.names.index(self.key)
        both = self._table(schema, touched).withColumn("_stored", F.lit(True)).join(
            fresh, F.col(self.key) == F.col(f"new_{at}"), "full_outer")
        newer = F.col("_arrived").isNotNull()
        return both.select(*[
            F.when(newer if n in updated else F.col("_stored").isNull(), F.col(f"new_{i}")).otherwise(F.col(n)).alias(n)
            for i, n in enumerate(schema.names)])

    def merge(self, arrivals: DataFrame, seq: str, updated: list[str]) -> DataFrame:
        """Merges arrivals by key: on a stored key ``updated`` columns take the values of the last arrival
        by ``seq`` and all others stay; a new key takes the others from its first arrival. Stored rows
        precede all arrivals, unplaced arrivals all placed ones. Returns the arrivals without a key, which
        are refused. Merging the same arrivals again changes no value."""
        now = self.manifest() or {"number": 0, "slots": {}, "schema": arrivals.schema.json(), "buckets": self.buckets}
        if now["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {now['buckets']} buckets")
        schema = T.StructType.fromJson(json.loads(now["schema"]))
        keyed = arrivals.select(*schema.names).filter(F.col(self.key).isNotNull())
        folded = cut_lineage(fold_by_key(keyed, self.key, seq, [*updated], "_first").drop("_first"), "arrivals")
        buckets = sorted(r[0] for r in folded.select(self.bucket().alias("b")).distinct().collect())  # at most one per bucket
        if buckets:
            number = now["number"] + 1
            touched = [now["slots"][str(b)] for b in buckets if str(b) in now["slots"]]
            slot = F.concat(self.bucket().cast("string"), F.lit(f"-{number}"))
            rows = self.merged(folded, [*updated, seq], touched, schema).withColumn("_slot", slot)
            for b in buckets:  # what an attempt that died before its commit has left
                self._fs.delete(self._hadoop.Path(f"{self.path}/data/_slot={b}-{number}"), True)
            rows.write.mode("append").insertInto(self.name)
            self._commit({**now, "number": number, "slots": now["slots"] | {str(b): f"{b}-{number}" for b in buckets}})
        return arrivals.filter(F.col(self.key).isNull())

    def vacuum(self) -> None:
        """Deletes slots that the newest manifest does not name; readers of older ones lose them."""
        used = set(self.manifest()["slots"].values())
        for s in self._fs.listStatus(self._hadoop.Path(f"{self.path}/data")):
            name = s.getPath().getName()
            if name.startswith("_slot=") and name.removeprefix("_slot=") not in used:
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (_slot='{name.removeprefix('_slot=')}')")
                self._fs.delete(s.getPath(), True)
