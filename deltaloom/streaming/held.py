"""The held state of a feed: keys in hash buckets, a version for each micro-batch, and a manifest that names what holds.

path/version=N/bucket=B has what batch N left of the keys of bucket B, path/manifests/N.json the versions of each bucket
that are to be read. A batch reads the buckets of its own keys alone, and of each at most `most` versions: when a bucket
would have more, its keys are merged into the batch's own version. A manifest is switched in by a rename once its data
are there, so that a batch that runs again starts from the manifest before it and overwrites only its own.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.sources.tables import files_of, replace_text, text_of

#: Version of what was there before the first batch.
BASE = -1


class HeldState:
    """State by key. schema: pk columns and values; alive: SQL that tells rows of keys that are there from those that went.

    Data that only manifests before the last `keep` ones name are deleted; a reader of the newest one has as many batches.
    The driver holds a manifest, which is as large as buckets * most numbers at most.
    """

    def __init__(self, spark: SparkSession, path: str, pk: list[str], schema: T.StructType, alive: str, buckets: int = 64, most: int = 4, keep: int = 8):
        if most < 1 or buckets < 1 or keep < 2:
            raise ValueError("a bucket has a version at least, and a batch needs the manifest before its own")
        self.spark, self.path, self.pk, self.alive, self.buckets, self.most, self.keep = spark, path, pk, alive, buckets, most, keep
        self.schema = schema
        self.values = [c for c in schema.names if c not in pk]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.pk), F.lit(self.buckets)).cast("int")

    def _versions(self) -> list[int]:
        folder, files = files_of(self.spark, f"{self.path}/manifests")
        if not files.exists(folder):
            return []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def version(self, before: int | None = None) -> int | None:
        """The newest version (before a batch); None where there is none."""
        return max((v for v in self._versions() if before is None or v < before), default=None)

    def manifest(self, version: int | None) -> dict[int, list[int]]:
        if version is None:
            return {}
        return {int(b): v for b, v in json.loads(text_of(self.spark, f"{self.path}/manifests/{version}.json")).items()}

    def folders(self, buckets: list[int] | None = None, before: int | None = None) -> list[str]:
        """What is read of the given buckets (None: all): at most `most` folders for each."""
        held = self.manifest(self.version(before))
        return [f"{self.path}/version={v}/bucket={b}" for b in (held if buckets is None else buckets) for v in held.get(b, [])]

    def _newest(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.option("basePath", self.path).schema(T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])).parquet(*folders)
        last = rows.groupBy(*self.pk).agg(F.max_by(F.struct(*self.values), "version").alias("last"))
        return last.select(*self.pk, *(F.col("last")[c].alias(c) for c in self.values)).select(*self.schema.names)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of rows' keys."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def of(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """What versions before a batch hold of keys (those that went are left out)."""
        found = self._newest(self.folders(self.touched(keys), before)).where(self.alive)
        return found.join(keys.select(*self.pk).distinct(), self.pk, "left_semi").select(*self.schema.names)

    def rows(self, version: int | None = None) -> DataFrame:
        """The whole state as of a version (None: the newest)."""
        return self._newest(self.folders(None, None if version is None else version + 1)).where(self.alive)

    def start(self, rows: DataFrame) -> None:
        """What is there before the first batch; nothing happens where there is a version already."""
        if self.version() is None:
            self._commit(rows, BASE, {})

    def put(self, rows: DataFrame, batch: int) -> list[int]:
        """What a batch leaves of its keys, one row each -> its buckets. Full buckets are merged, keys that went then go."""
        return self._commit(rows, batch, self.manifest(self.version(batch)))

    def _commit(self, rows: DataFrame, version: int, held: dict[int, list[int]]) -> list[int]:
        rows = rows.select(*self.schema.names)
        touched = self.touched(rows)
        full = [b for b in touched if len(held.get(b, [])) >= self.most]
        new = rows.withColumn("bucket", self.bucket())
        if full:
            old = self._newest([f"{self.path}/version={v}/bucket={b}" for b in full for v in held[b]])
            merged = old.join(rows.select(*self.pk), self.pk, "left_anti").select(*self.schema.names).withColumn("bucket", self.bucket())
            new = new.unionByName(merged).where(~F.col("bucket").isin(full) | F.coalesce(F.expr(self.alive), F.lit(False)))
        new.repartition("bucket").sortWithinPartitions("bucket", *self.pk).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/version={version}")
        now = {**held, **{b: [version] if b in full else [*held.get(b, []), version] for b in touched}}
        there = self._there(version)
        now = {b: [v for v in vs if v != version or b in there] for b, vs in now.items()}
        replace_text(self.spark, f"{self.path}/manifests/{version}.json", json.dumps(now))
        self._forget()
        return touched

    def _there(self, version: int) -> set[int]:
        """Buckets that a version has files for: one whose keys all went has none."""
        folder, files = files_of(self.spark, f"{self.path}/version={version}")
        return {int(n[7:]) for n in (f.getPath().getName() for f in files.listStatus(folder)) if n.startswith("bucket=")}

    def _forget(self) -> None:
        versions = self._versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old:
            return
        needed = {(v, b) for m in map(self.manifest, kept) for b, vs in m.items() for v in vs}
        for m in old:
            for v, b in ((v, b) for b, vs in self.manifest(m).items() for v in vs):
                if (v, b) not in needed:
                    folder, files = files_of(self.spark, f"{self.path}/version={v}/bucket={b}")
                    files.delete(folder, True)
            name, files = files_of(self.spark, f"{self.path}/manifests/{m}.json")
            files.delete(name, False)
