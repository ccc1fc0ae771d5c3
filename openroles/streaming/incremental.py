"""The daily jobs as incremental streams.

Each query runs with ``availableNow`` by default: it takes what has landed
since its last run and stops. State, offsets and output live in shared
folders. Merges into stored tables go through ``foreachBatch`` and are keyed by
the batch number, so a repeated batch writes the same version again.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from openroles.operators.dedup import posting_identity
from openroles.operators.merge import mark_notified, upsert_companies
from openroles.streaming.keyed_table import KeyedTable, Snapshots


def keyed(postings: DataFrame) -> DataFrame:
    """Postings with the identity that copies share, ``dedup_key``."""
    identity = posting_identity(F.col("source"), F.col("source_board"),
                                F.col("source_job_id"), F.col("job_url"))
    key = F.concat_ws("|", identity["k0"], identity["k1"], identity["k2"], identity["url"])
    return postings.withColumn("dedup_key", key)


def dedup_stream(postings: DataFrame, delay: str = "7 days") -> DataFrame:
    """Streaming postings, each identity once within the overlap of the daily polls.

    The watermark is on ingest time (``scraped_at``): posting dates may be
    missing or rightly old, and neither may drop a row. Rows that land later than
    ``delay`` are dropped here; ``dedup_with_late_rows`` keeps and marks them.
    """
    return (keyed(postings)
            .withWatermark("scraped_at", delay)
            .dropDuplicatesWithinWatermark(["dedup_key"]))


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def _merge_stream(stream: DataFrame, checkpoint: str,
                  merge: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.foreachBatch(merge).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def first_of_each(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of ``stream`` whose ``key`` no earlier batch had, one per key; for the output mode ``update``.

    The state store holds one row per key, in partitions by the key's hash. A
    batch looks up the keys it brings and nothing else, so its cost follows the
    batch and not what earlier ones had. A key is new if the first and the last
    batch that had it are the same, by the batch's own time, which a repeated
    batch keeps. Of rows that come together the first by ``order``, then by all
    other columns, is taken, so a repeated batch gives the same rows.
    """
    total = [*order, *[c for c in stream.columns if c not in (*order, key)]]
    states = stream.withColumn("_at", F.current_timestamp()).groupBy(key).agg(
        F.min(F.struct(*total)).alias("_row"), F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    return states.where("_first = _last").select(
        *[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in stream.columns])


def dedup_with_late_rows(postings: DataFrame, written: Snapshots, checkpoint: str,
                         delay: str = "7 days") -> StreamingQuery:
    """Streaming postings, each identity once over all runs; version ``n`` holds what batch ``n`` added.

    Identities are remembered in the state store however old they are, so rows of
    a backfill stay. ``late`` marks those more than ``delay`` behind the newest row
    written before; that one time is kept beside each version.
    """
    times = Snapshots(written.spark, f"{written.root}-newest")

    def merge(batch: DataFrame, number: int) -> None:
        before = times.latest(below=number)
        newest = times.read(before).first()["newest"] if before is not None else None
        behind = F.lit(newest).cast("timestamp") - F.expr(f"interval {delay}")
        written.write(number, batch.withColumn("late", F.coalesce(F.col("scraped_at") < behind, F.lit(False))))
        added = written.read(number).agg(F.max("scraped_at").alias("newest"))
        times.write(number, added.select(F.greatest("newest", F.lit(newest).cast("timestamp")).alias("newest")))

    return _merge_stream(first_of_each(keyed(postings), "dedup_key", ["scraped_at"]), checkpoint, merge, "update")


def upsert_companies_stream(stream: DataFrame, table: KeyedTable,
                            checkpoint: str) -> StreamingQuery:
    """Each batch of employer rows merged into the next version; last row per employer wins.

    Last is by ``ord``, which the table keeps: an older row that lands in a
    later batch changes nothing. The table's key is ``employer_name``; only
    buckets that employers of the batch fall into are read and written.
    """

    def combine(stored: DataFrame, batch: DataFrame) -> DataFrame:
        columns = [c for c in batch.columns if c != "employer_name"]
        latest = batch.groupBy("employer_name").agg(
            F.max_by(F.struct(*columns), "ord").alias("r")).select("employer_name", "r.*")
        if "ord" not in stored.columns:
            stored = stored.withColumn("ord", F.lit(None).cast(dict(batch.dtypes)["ord"]))
        had = stored.select("employer_name", F.col("ord").alias("_had"))
        newer = latest.join(had, "employer_name", "left").filter("_had is null or ord >= _had").drop("_had")
        return upsert_companies(stored, newer)

    return _merge_stream(stream, checkpoint, lambda batch, number: table.merge(number, batch, combine))


def deleted_keys(changes: DataFrame, key: str) -> DataFrame:
    """Keys whose last change, by ``ord``, is a deletion; of equal ``ord`` an insertion is the later one."""
    last = changes.groupBy(key).agg(F.max(F.struct("ord", (F.col("change") != "delete").alias("kept"))).alias("last"))
    return last.filter("not last.kept").select(key)


def cascade_stream(changes: DataFrame, tables: list[KeyedTable], checkpoint: str) -> StreamingQuery:
    """Deletions of a parent table carried into tables that refer to it.

    ``changes`` holds the parent's ``(key, ord, change)``, with ``change`` insert
    or delete. Each batch takes the deleted keys out of the buckets they fall into;
    other buckets are not read. A key that is deleted and inserted in one batch
    keeps its rows, one inserted in a later batch comes without. Null keys and
    keys that no row refers to change nothing. The tables' key is the column
    that refers to the parent and may have any number of rows.
    """

    def merge(batch: DataFrame, number: int) -> None:
        for table in tables:
            gone = deleted_keys(batch, table.key)
            table.merge(number, gone, lambda stored, keys, k=table.key: stored.join(keys, k, "left_anti"))

    return _merge_stream(changes, checkpoint, merge)


def notify_stream(pending: DataFrame, table: KeyedTable, sent_root: str, checkpoint: str,
                  render: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Digest of each batch of match ids still pending, then mark them.

    The document is written before the marks: after a crash in between it is
    written again (at least once), never skipped. ``render`` gets the pending
    match rows and returns ``(seq, id, html)``. The table's key is ``id``.
    """

    def send(batch: DataFrame, number: int) -> None:
        matches = table.read(table.latest(below=number), table.buckets_of(batch))
        due = matches.filter(~F.col("is_notified")).join(
            batch.select("id").distinct(), "id", "left_semi")
        out = f"{sent_root.rstrip('/')}/batch={number}"
        render(due).write.mode("overwrite").parquet(out)
        sent = batch.sparkSession.read.parquet(out).filter("id is not null").select("id")
        table.merge(number, sent, mark_notified)

    return _merge_stream(pending, checkpoint, send)
