"""The posting job: landed feeds and searched pages to new job rows."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles.functions.dates import parse_posted
from openroles.functions.rules import (
    is_auth_eligible, is_recent, is_us_eligible, title_level,
)
from openroles.functions.text import canonical_url, embed_text, url_hash
from openroles.operators.dedup import dedup_postings, diverse_jobs, union_direct_first
from openroles.operators.employers import (
    job_rows, jobs_to_insert, new_companies, resolve_employers,
)

ORDER = ["src_rank", "source", "source_board", "page_no", "pos", "job_url"]
from openroles.session import cut_lineage


@dataclass
class IngestResult:
    jobs: DataFrame
    new_companies: DataFrame
    embeddings: DataFrame


def eligible(postings: DataFrame, level: str, asof: Column | None = None,
             lookback_days: int = 7) -> DataFrame:
    """The posting rules as one filter; recency only with ``asof`` (feed rows)."""
    keep = title_level(F.col("title"), level)
    if asof is not None:
        keep = keep & is_recent(F.col("posted_date"), asof, lookback_days)
    return postings.filter(
        keep & is_us_eligible(F.col("location"), F.col("description"))
        & is_auth_eligible(F.col("description"), F.col("title")))


def searched_postings(pages: DataFrame) -> DataFrame:
    """Parsed pages in the posting schema; both paths hash the canonical URL."""
    url = canonical_url(F.col("job_url"))
    return pages.withColumn("job_url", url).withColumns({
        "url_hash": url_hash(F.col("job_url")), "posted_date": parse_posted(F.col("posted_date")),
        "source_job_id": F.lit(""), "source_board": F.lit(""),
        "page_no": F.lit(0).cast("bigint"), "pos": F.lit(0)})


def select_candidates(direct: DataFrame, searched: DataFrame, level: str, asof: Column,
                      max_jobs: int, lookback_days: int = 7) -> DataFrame:
    """Deduplicated, balanced candidates of both paths."""
    both = union_direct_first(eligible(direct, level, asof, lookback_days),
                              eligible(searched, level))
    order = [F.col(c) for c in ORDER]
    return diverse_jobs(dedup_postings(both, order), max_jobs, order)


def ingest(candidates: DataFrame, jobs: DataFrame, companies: DataFrame,
           embed: Callable[[Column], Column]) -> IngestResult:
    """Rows to append to jobs, companies and embeddings for postings not stored yet.

    What the three results share is checkpointed, so that it is derived once and
    all three are of the same postings.
    """
    fresh = cut_lineage(jobs_to_insert(candidates, jobs, [F.col(c) for c in ORDER]))
    resolved = cut_lineage(resolve_employers(fresh, companies))
    rows = job_rows(fresh, resolved)
    vectors = rows.select(F.col("id").alias("job_id"),
                          embed(embed_text(F.col("title"), F.col("description"))).alias("embedding"))
    return IngestResult(rows, new_companies(resolved), vectors)
