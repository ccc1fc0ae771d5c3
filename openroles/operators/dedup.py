"""First-per-key, caps per group and their combinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.text import canonical_url, text_or_empty


def first_n(rows: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    ``row_number() <= n`` is planned with a limit before the shuffle: every
    task sends at most ``n`` rows of a key, so a key with a third of all rows
    arrives as (tasks x n) rows. ``order`` must be total.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_n", number).filter(F.col("_n") <= n).drop("_n")


def posting_identity(source: Column, board: Column, job_id: Column, url: Column) -> Column:
    """Board identity when all three parts are there, else the canonical URL."""
    parts = (F.replace(text_or_empty(source), F.lit("_feed"), F.lit("")),
             F.lower(text_or_empty(board)), text_or_empty(job_id.cast("string")))
    known = (parts[0] != "") & (parts[1] != "") & (parts[2] != "")
    none = F.lit("")
    return F.when(known, F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)],
                                  none.alias("url"))).otherwise(
        F.struct(*[none.alias(f"k{i}") for i in range(3)], canonical_url(url).alias("url")))


def dedup_postings(postings: DataFrame, order: list) -> DataFrame:
    """First posting of each identity in the given order."""
    identity = posting_identity(F.col("source"), F.col("source_board"),
                                F.col("source_job_id"), F.col("job_url"))
    # Plain columns are shuffled in fewer bytes than a struct. Id and URL share one: the platform is empty
    # exactly where there is a URL instead of an id.
    keys = {"_platform": F.col("_identity.k0"), "_board": F.col("_identity.k1"),
            "_id_or_url": F.concat("_identity.k2", "_identity.url")}
    keyed = postings.withColumn("_identity", identity).withColumns(keys).drop("_identity")
    return first_n(keyed, list(keys), order).drop(*keys)


def union_direct_first(direct: DataFrame, searched: DataFrame) -> DataFrame:
    """Feed postings before searched ones; ``src_rank`` keeps that order."""
    return direct.withColumn("src_rank", F.lit(0)).unionByName(
        searched.withColumn("src_rank", F.lit(1)), allowMissingColumns=True)


def company_key() -> Column:
    name = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("company", "source_board")],
                      F.lit("unknown"))
    return F.lower(name)


def diverse_jobs(postings: DataFrame, max_jobs: int, order: list,
                 per_company: int = fixed.COMPANY_CAP) -> DataFrame:
    """Newest postings, at most ``per_company`` of one company, ``max_jobs`` in all.

    Equal to picking greedily by date: a company's postings are picked in date
    order until its cap, so the picked ones are its first ``per_company``.
    """
    newest = [F.col("posted_date").desc_nulls_last(), *order]
    capped = first_n(postings.withColumn("_company", company_key()), ["_company"], newest,
                     per_company)
    return capped.drop("_company").orderBy(*newest).limit(max_jobs)


def cap_listings(listings: DataFrame, board: list, order: list,
                 cap: int = fixed.BOARD_LISTING_CAP) -> DataFrame:
    """First ``cap`` listings of each board, whatever the size of its pages."""
    return first_n(listings, board, order, cap)


def newest_matches(matches: DataFrame) -> DataFrame:
    """Newest row per (job, résumé); rows with a null key or date are all kept."""
    kept = F.col("job_id").isNull() | F.col("resume_id").isNull() | F.col("matched_at").isNull()
    complete = first_n(matches.filter(~kept), ["job_id", "resume_id"],
                       [F.desc("matched_at"), F.desc("id")])
    return complete.unionByName(matches.filter(kept))


def union_queries(*results: DataFrame, order: list) -> DataFrame:
    """Matches of several queries: empty URLs dropped, first row per URL kept."""
    merged = results[0].withColumn("query_no", F.lit(0))
    for i, frame in enumerate(results[1:], 1):
        merged = merged.unionByName(frame.withColumn("query_no", F.lit(i)))
    merged = merged.filter(F.coalesce(F.col("job_url"), F.lit("")) != "")
    return first_n(merged, ["job_url"], [F.col("query_no"), *order])
