"""What the operators of this subpackage share."""

from __future__ import annotations

import sys
import uuid
from typing import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openroles.session import shared_dir

#: Rows and bytes of an Arrow batch; a longer row is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

#: White space between words: space and the control characters tab to carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that extra columns of any name cannot clash.

    Every operator starts here, so this is also where Arrow batches are bounded:
    a batch of whole texts or sets lies in the executor and in its worker at once.
    """
    bound_batches(df.sparkSession)
    return df.select(*[F.col(f"`{n}`") for n in names])


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Later jobs then read files, so a lost executor costs no recomputation, and
    rows that depend on their partition keep it.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores before it, as no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: A task turns this many bytes of text into Python objects at a time.
SLICE_BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in parts of about ``limit`` bytes; a longer row stands alone."""
    for batch in batches:
        rows = max(1, int(limit * batch.num_rows / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """``fn`` on slices of the rows of each task."""
    def run(batches):
        for part in slices(batches):
            yield fn(part)
    return df.mapInArrow(run, schema)


def worker_store() -> dict:
    """A dictionary that lives as long as the worker process.

    Functions travel with the job by value, module variables with them, so what
    should outlive a task (loaded vocabularies, remembered words) is kept here.
    """
    return sys.__dict__.setdefault("_openroles_worker_store", {})
