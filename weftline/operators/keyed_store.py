"""Keyed snapshots on shared storage: a table by key of which a change rewrites only the part that it touches.

Rows are dealt to buckets by a hash of their key. A version names, for each
bucket, the folder that holds its rows; a change reads the buckets that its keys
fall in, merges, writes those anew and commits a version that names the others
as they were. Files are never changed, so a reader keeps the version it opened
and a change that fails leaves no trace but files that nothing names. A version
notes the transaction that made it: the same change sent again is found there
and does nothing.

One writer at a time; a version that two writers commit at once is refused to
the second.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.operators.merge import upsert

_VERSION = "bucket int, path string, txn string, n_buckets int, version long"


class KeyedStore:
    """The snapshot in ``folder``; ``columns`` is a schema without the bucket, ``key`` its key columns."""

    def __init__(self, spark: SparkSession, folder: str, columns: str | StructType, key: list[str], n_buckets: int = 64) -> None:
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), list(key)
        self.schema = columns if isinstance(columns, StructType) else StructType.fromDDL(columns)
        # the number of buckets stays what it was when the first version was made
        self.n_buckets = next((r.n_buckets for r in self.versions().limit(1).collect()), n_buckets)

    def versions(self) -> DataFrame:
        """A row for each bucket of each version; one without a bucket for a version of no rows."""
        try:
            return self.spark.read.schema(_VERSION).option("basePath", f"{self.folder}/versions").parquet(f"{self.folder}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _VERSION)

    def latest(self) -> int:
        """The number of the last version, 0 before the first."""
        return self.versions().agg(F.max("version")).first()[0] or 0

    def _paths(self, version: int) -> dict[int, str]:
        """Where each bucket lies: at most n_buckets rows."""
        return {r.bucket: r.path for r in self.versions().where((F.col("version") == version) & F.col("bucket").isNotNull()).collect()}

    def _read(self, paths) -> DataFrame:
        paths = sorted(paths)
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def rows(self, version: int | None = None) -> DataFrame:
        """The snapshot, as of a version."""
        return self._read(self._paths(self.latest() if version is None else version).values())

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.n_buckets)).cast("int")

    def _touched(self, keys: DataFrame) -> list[int]:
        return sorted(r.b for r in keys.select(self.bucket().alias("b")).distinct().collect())

    def get(self, keys: DataFrame) -> DataFrame:
        """The rows of the asked keys, read from their buckets alone; keys that aren't there have none."""
        at = self._paths(self.latest())
        return self._read(at[b] for b in self._touched(keys) if b in at).join(keys.select(*self.key).distinct(), self.key, "left_semi")

    def put(self, changes: DataFrame, order: str, keep: tuple[str, ...] = ("created_at",), txn: str | None = None) -> int:
        """Upserts changes (the snapshot's columns and ``order``): the last of a key by order wins, ``keep`` stays as it first was. Returns the version after it."""
        now = self.latest()
        if txn is not None and (done := self.versions().where(F.col("txn") == txn).agg(F.max("version")).first()[0]):
            return done
        at = self._paths(now)
        # before the first version there is nothing to read, so changes needn't be gone through to see which buckets they touch
        old = self._read(at[b] for b in self._touched(changes) if b in at) if at else self._read([])
        merged = upsert(old, changes, self.key, order, keep).select(*self.schema.fieldNames()).withColumn("bucket", self.bucket())
        home = f"{self.folder}/rows/{uuid.uuid4().hex}"
        # the merge has dealt rows by the key's hash already, each bucket's to several tasks
        merged.write.partitionBy("bucket").option("compression", "zstd").parquet(home)
        written = {r.bucket for r in self.spark.read.schema(merged.schema).parquet(home).select("bucket").distinct().collect()}
        at |= {b: f"{home}/bucket={b}" for b in written}
        row = lambda b, path: (b, path, txn, self.n_buckets)
        version = self.spark.createDataFrame([row(b, p) for b, p in at.items()] or [row(None, None)], "bucket int, path string, txn string, n_buckets int")
        version.coalesce(1).write.mode("errorifexists").parquet(f"{self.folder}/versions/version={now + 1}")
        return now + 1
