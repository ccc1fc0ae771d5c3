"""Landed web-search results: rows, tier fallback and ordered distinct URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles import schemas
from openroles.functions.text import is_ats_url, text_or_empty


def search_queries(spark: SparkSession, level: str = "all") -> DataFrame:
    """Configured query per level; ``all`` means every level, in order."""
    rows = [(i, lvl, q) for i, (lvl, q) in enumerate(fixed.SEARCH_QUERIES)
            if level in ("all", lvl)]
    return spark.createDataFrame(rows, "query_no int, level string, query string")


def read_search_queries(spark: SparkSession, path: str, level: str = "all") -> DataFrame:
    """Configured queries from JSON files, each an array of objects with number, level and query."""
    rows = spark.read.schema("query_no int, level string, query string").option("multiLine", True).json(path)
    return rows if level == "all" else rows.filter(F.col("level") == level)


def search_rows(responses: DataFrame) -> DataFrame:
    """Every result row of landed responses (``query``, ``tier``, ``payload``)."""
    parsed = responses.withColumn("doc", F.from_json("payload", schemas.SEARCH_RESPONSE))
    keep = [c for c in responses.columns if c != "payload"]
    first = parsed.select(*keep, F.posexplode("doc.organic_results").alias("pos", "item")).select(
        *keep, "pos", text_or_empty(F.col("item.title")).alias("title"),
        text_or_empty(F.col("item.link")).alias("link"),
        text_or_empty(F.col("item.snippet")).alias("snippet"),
        F.coalesce(F.col("item.position"), F.lit(0)).alias("position"),
        F.lit("").alias("display_link"))
    second = parsed.select(
        *keep, F.posexplode("doc.items").alias("pos", "item")).select(
        *keep, "pos", text_or_empty(F.col("item.title")).alias("title"),
        text_or_empty(F.col("item.link")).alias("link"),
        text_or_empty(F.col("item.snippet")).alias("snippet"),
        F.lit(0).alias("position"),
        text_or_empty(F.col("item.displayLink")).alias("display_link"))
    return first.unionByName(second)


def ats_results(results: DataFrame, markers: tuple[str, ...] = fixed.ATS_URL_MARKERS) -> DataFrame:
    return results.filter((text_or_empty(F.col("link")) != "") & is_ats_url(F.col("link"), markers))


def tier_fallback(results: DataFrame, key: str = "query") -> DataFrame:
    """ATS results of the first tier that has any, per query.

    The winning tier comes from a combined aggregate and is joined back, so a
    query holding much of the data is never gathered in one window partition.
    """
    hits = ats_results(results)
    winner = hits.groupBy(key).agg(F.min("tier").alias("tier"))
    return hits.join(winner, [key, "tier"])


def distinct_urls(results: DataFrame, max_jobs: int | None = None) -> DataFrame:
    """Each URL once, in the order it was first seen; optionally the first ``max_jobs``."""
    first = results.groupBy("link").agg(F.min("ord").alias("ord"))
    return first if max_jobs is None else first.orderBy("ord", "link").limit(max_jobs)
