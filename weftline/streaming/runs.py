"""Named runs: a stream that is run again and again, each time over what is new, with its state carried over.

A run has a folder of its own: Spark's checkpoint (which files were read, the
operators' state), the batches' rows, and a commit for each batch that names
its rows. A batch is committed once: its rows go to a folder that no other
attempt writes to, and only then does its commit appear, so a batch that is
taken again after a crash, by the same call or a later one, either finds its
commit and writes nothing, or is written anew, and rows of attempts that failed
are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.scratch import shared_dir

_COMMIT = "path string, n_rows long, batch long"


class NamedRun:
    """The run of a name, in ``root`` (the session's shared folder if not given)."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None) -> None:
        self.spark, self.home = spark, f"{(root or shared_dir(spark)).rstrip('/')}/run-{name}"

    def commits(self) -> DataFrame:
        """batch, path, n_rows of each batch that is committed."""
        try:
            return self.spark.read.schema(_COMMIT).option("basePath", f"{self.home}/commits").parquet(f"{self.home}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMIT)

    def _save(self, batch: DataFrame, n: int) -> None:
        if self.commits().where(F.col("batch") == n).count():
            return
        path = f"{self.home}/rows/{n}-{uuid.uuid4().hex}"
        batch.write.parquet(path)
        rows = self.spark.read.schema(batch.schema).parquet(path).count()
        self.spark.createDataFrame([(path, rows)], "path string, n_rows long").coalesce(1).write.mode("overwrite").parquet(f"{self.home}/commits/batch={n}")

    def advance(self, stream: DataFrame, mode: str = "append", save: Callable[[DataFrame, int], None] | None = None) -> NamedRun:
        """Run the stream over what came since the last call, and return when it is done.

        ``save`` takes the place of what commits a batch, in tests that stop it midway.
        """
        put = save or self._save
        query = stream.writeStream.outputMode(mode).foreachBatch(lambda b, n: put(b, n)).option("checkpointLocation", f"{self.home}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return self

    def rows(self, schema) -> DataFrame:
        """The rows of all committed batches with their batch."""
        found = self.commits().where("n_rows > 0").orderBy("batch").collect()  # one row for each batch
        out = self.spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("long"))
        if not found:
            return out
        at = {r.path: r.batch for r in found}
        read = self.spark.read.schema(schema).parquet(*at).withColumn("at", F.regexp_extract(F.col("_metadata.file_path"), r"/rows/(\d+)-[0-9a-f]+/", 1))
        return out.unionByName(read.withColumn("batch", F.col("at").cast("long")).drop("at"))

    def latest(self, schema, keys: list[str]) -> DataFrame:
        """The last value of each key, of a run in update mode."""
        rows = self.rows(schema)
        rest = [c for c in rows.columns if c not in (*keys, "batch")]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")
