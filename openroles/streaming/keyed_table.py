"""A stored table that merges rewrite in part.

Plain Parquet has no MERGE. Rows are dealt to a fixed number of buckets by the
hash of their key; a version is a manifest that names, for each bucket, the
version whose files hold it. A merge reads and writes only the buckets that the
incoming keys fall into, so its bytes follow the batch, and every bucket has one
set of files however many merges there were. A version counts once its manifest
is complete; doing it again gives the same version.
"""

from __future__ import annotations

import json
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a table unless it says otherwise; choose so many that one fits a task.
BUCKETS = 32


class Snapshots:
    """Numbered sets of Parquet files below a shared folder; one counts when Spark's committer has marked it complete."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def names(self, path: str) -> list[str]:
        where = self.fs_path(path)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def complete(self, version: int) -> bool:
        return self.fs.exists(self.fs_path(f"{self.path(version)}/_SUCCESS"))

    def versions(self) -> list[int]:
        """All complete versions, oldest first."""
        found = sorted(int(n[2:]) for n in self.names(self.root) if n.startswith("v="))
        return [v for v in found if self.complete(v)]

    def latest(self, below: int | None = None) -> int | None:
        return max((v for v in self.versions() if below is None or v < below), default=None)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self.path(version))

    def write(self, version: int, frame: DataFrame) -> None:
        frame.write.mode("overwrite").parquet(self.path(version))

    def remove(self, path: str) -> None:
        self.fs.delete(self.fs_path(path), True)


class KeyedTable:
    """Versions of a table with one row per ``key``.

    The number of buckets is that of the first version and stays. Rows whose key
    is null share a bucket. A column named ``bucket`` is not possible.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.manifests = Snapshots(spark, f"{root.rstrip('/')}/manifest")
        self.data = Snapshots(spark, f"{root.rstrip('/')}/data")

    def latest(self, below: int | None = None) -> int | None:
        return self.manifests.latest(below)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _manifest(self, version: int) -> tuple[dict[int, int], T.StructType]:
        """Where each bucket of a version is, and the table's schema; at most one row per bucket."""
        rows = self.manifests.read(version).collect()
        files = {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}
        return files, T.StructType.fromJson(json.loads(rows[0]["schema"]))

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of ``rows`` fall into."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    def read(self, version: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """The whole version, or the given buckets of it."""
        files, schema = self._manifest(version)
        wanted = files if buckets is None else [b for b in buckets if b in files]
        paths = [f"{self.data.path(files[b])}/bucket={b}" for b in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def start(self, table: DataFrame) -> None:
        """Version -1: the table before the first merge, if there is no version yet."""
        if self.latest() is None:
            self._write(-1, table, {}, range(self.buckets))

    def merge(self, version: int, incoming: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Makes ``version`` of the one before it.

        ``combine(stored, incoming)`` gets the stored rows of the buckets that the
        incoming keys fall into and returns the new rows of those buckets.
        """
        before = self.latest(below=version)
        touched = self.buckets_of(incoming)
        files, _ = self._manifest(before)
        self._write(version, combine(self.read(before, touched), incoming), files, touched)

    def _write(self, version: int, rows: DataFrame, files: dict[int, int], touched: Iterable[int]) -> None:
        touched = set(touched)
        if touched:
            (rows.withColumn("bucket", self._bucket()).repartition(len(touched), "bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(self.data.path(version)))
        held = {int(n[7:]) for n in self.data.names(self.data.path(version)) if n.startswith("bucket=")} if touched else set()
        files = {b: v for b, v in files.items() if b not in touched} | {b: version for b in held}
        listed = [(b, v, rows.schema.json()) for b, v in sorted(files.items())] or [(None, None, rows.schema.json())]
        self.manifests.write(version, self.spark.createDataFrame(listed, "bucket int, version int, schema string").coalesce(1))

    def clean_up(self, keep: int = 2) -> None:
        """Removes all but the last ``keep`` versions, and files that none of those names."""
        versions = self.manifests.versions()
        kept, gone = versions[-keep:], versions[:-keep]
        named = {(v, b) for k in kept for b, v in self._manifest(k)[0].items()}
        for v in gone:
            self.manifests.remove(self.manifests.path(v))
        # A version above the kept ones may be in the making.
        for v in [int(n[2:]) for n in self.data.names(self.data.root) if n.startswith("v=")]:
            if v > kept[-1]:
                continue
            for name in self.data.names(self.data.path(v)):
                if name.startswith("bucket=") and (v, int(name[7:])) not in named:
                    self.data.remove(f"{self.data.path(v)}/{name}")
            if not any(version == v for version, _ in named):
                self.data.remove(self.data.path(v))
