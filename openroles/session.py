"""Session settings and the few cluster-facing helpers the jobs share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. They are runtime settings, so they can be put
# on a session somebody else built; none of them sizes the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A week of posting keys is more than executor heaps hold; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A join of two streams keeps one store in a partition instead of four, each with files and commits of its own.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def build_session(app: str = "openroles", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting (a laptop, the tests) gets a
    temporary folder; on a cluster the setting has to be there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None) if (
            spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()
        ) else None
    if not named:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^,\]]*(,\d+)?\])?$", master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="openroles-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs reread it, also after an executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_once(df: DataFrame, label: str) -> DataFrame:
    """Parquet below :func:`shared_dir`, for rows that several joins read, each some of the columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_bounded(df: DataFrame, rows: int | None, limit: int = 1_000_000) -> DataFrame:
    """Broadcast ``df`` only when ``rows``, a proven upper bound, is small.

    Without a bound, or beyond the limit, the frame is returned unhinted and
    the join falls back to a shuffle that AQE can still split or convert.
    """
    if rows is not None and rows <= limit:
        return F.broadcast(df)
    return df


def left_join_known(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` that leaves rows with a null key out of the join.

    They match nothing, so they are added afterwards and never meet in one task.
    A hot key that is not null is left to AQE's skew join.
    """
    joined = left.where(F.col(key).isNotNull()).join(right, key, "left")
    return joined.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


def rows_up_to(df: DataFrame, limit: int) -> int | None:
    """Row count when it is at most ``limit``, else ``None``; never scans past it."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None
