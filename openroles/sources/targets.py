"""Feed targets: the curated boards and the ones discovered in stored job URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.text import (
    brand_key, first_non_empty, let, origin_host, path_parts, text_or_empty, url_parts,
)
from openroles.session import left_join_known

LOCALE_PART = r"^[a-z]{2}-[A-Z]{2}$"
TARGET_SCHEMA = "platform string, identifier string, company string, base_url string, site string"


def seed_targets(spark: SparkSession, entries=fixed.SEED_TARGETS) -> DataFrame:
    """Curated boards given as tuples."""
    return curated_targets(spark.createDataFrame(list(entries), TARGET_SCHEMA))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Curated boards from JSON files, each an array of objects."""
    return curated_targets(spark.read.schema(TARGET_SCHEMA).option("multiLine", True).json(path))


def curated_targets(rows: DataFrame) -> DataFrame:
    """Unknown platforms are dropped, a missing company is the identifier."""
    return rows.filter(F.col("platform").isin(*fixed.PLATFORMS)).select(
        "platform", "identifier",
        first_non_empty(F.col("company"), F.col("identifier")).alias("company"),
        text_or_empty(F.col("base_url")).alias("base_url"),
        text_or_empty(F.col("site")).alias("site"))


def target_key() -> list:
    return [F.col("platform"), F.lower("identifier").alias("identifier_key"),
            F.lower("site").alias("site_key")]


def _last_per_key(targets: DataFrame, order: str) -> DataFrame:
    kept = F.max_by(F.struct("identifier", "company", "base_url", "site"), F.col(order))
    return targets.groupBy(*target_key()).agg(kept.alias("t")).select("platform", "t.*")


def url_targets(known_jobs: DataFrame) -> DataFrame:
    """Board coordinates of each stored job URL; one row in, at most one row out."""
    target = let(F.struct(url_parts(F.col("job_url")).alias("url"),
                          text_or_empty(F.col("employer_name")).alias("name")),
                 lambda t: _target(t["url"], t["name"]))
    # As a generator of nought or one row the target is derived once; a filter
    # on it would be copied below and derive it again.
    return known_jobs.select("*", F.explode(F.array_compact(F.array(target))).alias("t")).select(
        *known_jobs.columns, "t.*")


def _target(url: Column, name: Column) -> Column:
    where = F.struct(origin_host(url["origin"]).alias("host"), url["origin"].alias("origin"),
                     path_parts(url["path"]).alias("parts"))
    return let(where, lambda w: let(_board(w), lambda b: F.when(
        b["platform"].isNotNull() & (b["identifier"] != "")
        & ((b["platform"] != "workday") | ~b["site"].isin("", "job"))
        & (brand_key(b["identifier"]) == brand_key(name)),
        F.struct(b["platform"].alias("platform"), b["identifier"].alias("identifier"),
                 first_non_empty(name, b["identifier"]).alias("company"),
                 b["base_url"].alias("base_url"), b["site"].alias("site")))))


def _board(w: Column) -> Column:
    """Board of a URL; the identifier is empty when the path names none."""
    host, first = w["host"], text_or_empty(F.get(w["parts"], F.lit(0)))
    site = F.get(F.filter(w["parts"], lambda p: ~p.rlike(LOCALE_PART)), F.lit(0))
    none = F.lit("")

    def board(platform: str, identifier: Column, base: Column = none, site: Column = none):
        return F.struct(F.lit(platform).alias("platform"), identifier.alias("identifier"),
                        base.alias("base_url"), site.alias("site"))

    api = F.when(F.contains(host, F.lit(".eu.")), "https://api.eu.lever.co") \
        .otherwise("https://api.lever.co")
    tenant = F.when(first != "", F.substring_index(host, ".", 1)).otherwise(none)
    return (
        F.when((host == "greenhouse.io") | host.endswith(".greenhouse.io"), board("greenhouse", first))
        .when(host.isin("jobs.lever.co", "jobs.eu.lever.co"), board("lever", first, api))
        .when(host == "jobs.ashbyhq.com", board("ashby", first))
        .when(host == "jobs.smartrecruiters.com", board("smartrecruiters", first))
        .when((host == "myworkdayjobs.com") | host.endswith(".myworkdayjobs.com"),
              board("workday", tenant, w["origin"], text_or_empty(site))))


def discover_targets(known_jobs: DataFrame, order: str = "job_id") -> DataFrame:
    """One target per board whose slug agrees with the employer's brand; later jobs win."""
    return _last_per_key(url_targets(known_jobs), order)


def merge_targets(*groups: DataFrame) -> DataFrame:
    """Union of target groups, later groups winning per board, sorted by board key."""
    frames = [g.withColumn("_group", F.lit(i)) for i, g in enumerate(groups)]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return _last_per_key(merged, "_group").orderBy(
        "platform", F.lower("identifier"), F.lower("site"))


def known_feed_jobs(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Stored job URLs with the employer they are linked to, if any."""
    return left_join_known(jobs.select("job_id", "job_url", "company_id"),
                            companies.select("company_id", "employer_name"), "company_id")
