"""Listings joined with detail documents that land later.

A left outer join of two streams: a listing waits in the state store for its
detail and leaves with it; when the watermark passes ``wait`` it leaves without,
as an error. State is bounded by what lands within ``wait`` and ``delay``.

Both time columns are times of arrival, as a landing zone gives them: rows more
than ``delay`` behind the newest of their stream are late. Spark drops those;
``late_rows`` counts them, and a job should stop if there are any. Time passes
with the slower of the two streams, so listings of the last ``wait`` are
neither postings nor errors yet. A listing meets every copy of its detail
(deduplicate the postings); a detail that does not parse counts as none, and
like a page without listings it does not make time pass. Null ids match nothing
and expire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from openroles.sources import feeds


def await_details(pages: DataFrame, details: DataFrame, platform: str, wait: str = "3 days",
                  delay: str = "1 day") -> DataFrame:
    """Listings of streamed pages (time ``scraped_at``) with streamed details (time ``landed_at``).

    ``detail`` is null for listings that have waited in vain.
    """
    listings, schema = feeds.DETAILED[platform]
    left = listings(pages, delay)
    right = feeds.parsed_details(details, platform, schema, "landed_at").withWatermark("landed_at", delay)
    right = right.withColumnsRenamed({"identifier": "_identifier", "detail_key": "_key"})
    meets = (F.col("identifier") == F.col("_identifier")) & (F.col("detail_key") == F.col("_key"))
    near = F.expr(f"landed_at between scraped_at - interval {wait} and scraped_at + interval {wait}")
    return left.join(right, meets & near, "left_outer").drop("_identifier", "_key")


def postings(joined: DataFrame, platform: str, asof: Column) -> DataFrame:
    """Postings of the listings that got their detail."""
    return feeds.detailed_postings(joined.filter("detail is not null"), platform, asof)


def errors(joined: DataFrame, platform: str) -> DataFrame:
    """Boards whose listings waited in vain, as ``feeds.feed_errors`` gives them."""
    return feeds.lost_details(joined.filter("detail is null"), platform)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's recent batches dropped as late."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
