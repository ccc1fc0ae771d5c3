"""Keyed merges into stored tables.

Plain Parquet has no MERGE, so a merge yields the next snapshot as a frame and
``write_snapshot`` publishes it. Keys are unique on both sides, which is what
keeps these joins free of skew; incoming rows are reduced to one per key first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles.functions.text import extract_skills
from openroles.operators.dedup import first_n
from openroles.operators.rollup import with_approval_rate
from openroles.session import scratch_path


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str],
           defaults: dict[str, Column] | None = None, order: list | None = None) -> DataFrame:
    """Next snapshot: incoming columns win, columns it lacks keep their old value.

    With an ``order`` the first incoming row of each key counts; without one
    incoming keys have to be unique. A new row gets ``defaults`` for those; stored rows without an incoming one
    stay as they are.
    """
    defaults = defaults or {}
    if order:
        incoming = first_n(incoming, keys, order)
    given = [c for c in incoming.columns if c not in keys]
    new = incoming.select(*keys, F.lit(True).alias("_hit"),
                          *[F.col(c).alias(f"_new_{c}") for c in given])
    old = stored.withColumn("_old", F.lit(True))
    merged = old.join(new, keys, "full_outer")
    columns = []
    for c in stored.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c in given:
            columns.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            fallback = defaults.get(c, F.lit(None))
            columns.append(F.when(F.col("_old"), F.col(c)).otherwise(fallback).alias(c))
    return merged.select(*columns)


def append_new(stored: DataFrame, incoming: DataFrame, key: str, order: list) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet, one per key."""
    fresh = incoming.join(stored.select(key), key, "left_anti")
    return first_n(fresh, [key], order)


def upsert_companies(stored: DataFrame, incoming: DataFrame, order: list | None = None) -> DataFrame:
    """Employers by their exact name; the rate is derived again on every write."""
    return with_approval_rate(upsert(stored, incoming, ["employer_name"], order=order))


def upsert_matches(stored: DataFrame, incoming: DataFrame, asof: Column,
                   order: list | None = None) -> DataFrame:
    """Matches by (job, résumé); notification state and match date survive."""
    return upsert(stored, incoming, ["job_id", "resume_id"], {
        "id": F.xxhash64("job_id", "resume_id"), "is_notified": F.lit(False),
        "matched_at": asof}, order)


def mark_notified(matches: DataFrame, notified: DataFrame) -> DataFrame:
    ids = notified.select("id").distinct().withColumn("_sent", F.lit(True))
    return matches.join(ids, "id", "left").withColumn(
        "is_notified", F.when(F.col("_sent"), F.lit(True)).otherwise(F.col("is_notified"))
    ).drop("_sent")


def upsert_resumes(stored: DataFrame, incoming: DataFrame, embed, order: list) -> DataFrame:
    """Profiles by name, whatever its case; skills and vector follow the text.

    A stored profile keeps its id and spelling. ``embed`` is a Column function
    from text to vector.
    """
    fresh = first_n(incoming.withColumn("_key", F.lower("profile_name")), ["_key"], order)
    fresh = fresh.withColumns({
        "skills": extract_skills(F.col("resume_text")), "embedding": embed(F.col("resume_text"))})
    new = fresh.select("_key", F.struct(
        *[c for c in stored.columns if c in fresh.columns]).alias("_new"))
    old = stored.withColumn("_key", F.lower("profile_name"))
    merged = old.join(new, "_key", "full_outer")
    columns = []
    for c in stored.columns:
        if c not in fresh.columns:
            columns.append(F.col(c))
        elif c in ("id", "profile_name"):
            columns.append(F.coalesce(F.col(c), F.col(f"_new.{c}")).alias(c))
        else:
            columns.append(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}"))
                           .otherwise(F.col(c)).alias(c))
    return merged.select(*columns)


def prune_orphans(jobs: DataFrame, embeddings: DataFrame,
                  matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Embeddings and matches of jobs that still exist."""
    alive = jobs.select("job_id")
    return (embeddings.join(alive, "job_id", "left_semi"),
            matches.join(alive, "job_id", "left_semi"))


def duplicate_keys(snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty for a sound snapshot."""
    return snapshot.groupBy(*keys).count().filter("count > 1")


def write_snapshot(snapshot: DataFrame, label: str, path: str | None = None) -> str:
    """Write a snapshot to a path of its own; readers switch over once it is complete."""
    target = path or scratch_path(snapshot.sparkSession, label)
    snapshot.write.mode("errorifexists").parquet(target)
    return target
