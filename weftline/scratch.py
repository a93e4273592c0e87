"""Tables written to the folder that driver and executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that
is unset (tests, a laptop) a local folder is made once for the session.
A written table cuts lineage: later jobs read it again from storage, so the
loss of an executor costs at most the tasks that ran there.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder of this session, without a trailing slash."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share; the master is {master}")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="weftline-")
        path = _own[app]
    return path.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """df with its columns worked out once for each row: what comes out of a generator isn't put in again at each place that reads it, nor ahead of a filter."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
