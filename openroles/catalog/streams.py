"""Streaming queries: each runs its stream over what has landed and returns the sink's table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles.catalog.feeds import LOST_DETAIL, RELEVANT, smartrecruiters_pages, workday_pages
from openroles.catalog.matching import DUE, tables
from openroles.catalog.postings import IDENTITY
from openroles.catalog.registry import query
from openroles.catalog.views import ASOF
from openroles.operators.digest import digest_fragments, eligible_pending
from openroles.operators.matching import unnotified_matches
from openroles.operators.merge import prune_orphans
from openroles.session import scratch_path, written_once
from openroles.streaming import details as late
from openroles.streaming import incremental as inc


BATCHES = 3
FILE_ROWS = 500_000


def landed_stream(v, root: str, table: str) -> DataFrame:
    """A given table, landed in files, as a stream of :data:`BATCHES` batches.

    Each task of the scan writes files of at most :data:`FILE_ROWS` rows, so batches of a large table have many.
    """
    rows = v(table)
    most = max(1, min(FILE_ROWS, math.ceil(rows.count() / (2 * BATCHES))))
    rows.write.option("maxRecordsPerFile", most).parquet(f"{root}/in")
    files = len(v.spark.read.schema(rows.schema).parquet(f"{root}/in").inputFiles())
    return (v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, math.ceil(files / BATCHES)))
            .parquet(f"{root}/in"))


@query("stream_dedup_postings", f"""
    SELECT DISTINCT CASE WHEN source_job_id = '' THEN '|||' || canon_url
           ELSE {IDENTITY} || '|' END AS dedup_key
    FROM @v_sightings""")
def stream_dedup_postings(v):
    root = scratch_path(v.spark, "dedup")
    postings = v("v_postings").select("job_id", "platform", "board", "ext_id", "raw_url", "canon_url",
                                      F.col("scraped_at").cast("timestamp").alias("scraped_at"))
    lines = landed_stream(v, root, "lineitem").join(postings, F.col("l_orderkey") == F.col("job_id"))
    searched = F.col("l_returnflag") == "N"
    even = F.col("l_linenumber") % 2 == 0
    sightings = lines.select(
        F.when(searched, "google_search").otherwise(F.concat("platform", F.lit("_feed"))).alias("source"),
        F.when(searched, "").when(even, F.upper("board")).otherwise(F.col("board")).alias("source_board"),
        F.when(searched, "").otherwise(F.col("ext_id")).alias("source_job_id"),
        F.when(even, F.col("canon_url")).otherwise(F.col("raw_url")).alias("job_url"), "scraped_at")
    inc.dedup_with_late_rows(sightings, inc.Snapshots(v.spark, f"{root}/out"), f"{root}/state").awaitTermination()
    return v.spark.read.parquet(f"{root}/out").select("dedup_key")


# Every part is one version of its employer's counts; the last one counts.
VERSIONS = """
    SELECT p_partkey AS ord, upper(employer) AS employer_name,
           CAST(p_size AS BIGINT) + 3 AS total_approvals, CAST(p_size % 7 AS BIGINT) AS total_denials
    FROM @v_parts"""


@query("stream_upsert_companies", f"""
    SELECT c.employer_name, c.naics_code IS NULL AS naics_missing,
           coalesce(n.total_approvals, c.total_approvals) AS total_approvals,
           coalesce(n.total_denials, c.total_denials) AS total_denials,
           CASE WHEN coalesce(n.total_approvals + n.total_denials, c.total_approvals + c.total_denials) > 0
             THEN round(CAST(coalesce(n.total_approvals, c.total_approvals) AS DECIMAL(18,0)) * 100
                  / coalesce(n.total_approvals + n.total_denials, c.total_approvals + c.total_denials), 2)
             ELSE 0 END::DOUBLE AS approval_rate
    FROM @v_companies c LEFT JOIN (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY employer_name ORDER BY ord DESC) AS k
                     FROM ({VERSIONS})) WHERE k = 1) n ON n.employer_name = c.employer_name""")
def stream_upsert_companies(v):
    root = scratch_path(v.spark, "companies")
    table = inc.KeyedTable(v.spark, f"{root}/table", "employer_name")
    table.start(v("v_companies").drop("company_id"))
    parts = landed_stream(v, root, "part")
    suffix = F.element_at(F.array(*[F.lit(s) for s in (" LLC", " Inc", " Technologies Ltd", " Holdings")]),
                          (F.col("p_partkey") % 4 + 1).cast("int"))
    name = F.concat("p_name", F.lit(" unit "), F.replace("p_brand", F.lit("Brand#"), F.lit("")), suffix)
    rows = parts.select(
        F.col("p_partkey").alias("ord"), F.upper(name).alias("employer_name"),
        (F.col("p_size").cast("bigint") + 3).alias("total_approvals"),
        (F.col("p_size") % 7).cast("bigint").alias("total_denials"))
    inc.upsert_companies_stream(rows, table, f"{root}/state").awaitTermination()
    table.clean_up()
    return table.read(table.latest()).select(
        "employer_name", F.col("naics_code").isNull().alias("naics_missing"), "total_approvals",
        "total_denials", F.col("approval_rate").cast("double").alias("approval_rate"))


@query("stream_notify", f"""
    SELECT id, is_notified OR id IN (SELECT id FROM ({DUE})) AS is_notified FROM @v_matches""")
def stream_notify(v):
    root = scratch_path(v.spark, "notify")
    # Each batch reads the other tables more than once; landed, they are not made of the given ones each time.
    matches, *others = tables(v)
    jobs, companies, resumes = (written_once(t, "notify-side") for t in others)
    table = inc.KeyedTable(v.spark, f"{root}/matches", "id")
    table.start(matches)
    ids = landed_stream(v, root, "orders").select(F.col("o_orderkey").alias("id"))

    def render(due: DataFrame) -> DataFrame:
        return digest_fragments(eligible_pending(
            unnotified_matches(due, jobs, companies, resumes)))

    inc.notify_stream(ids, table, f"{root}/sent", f"{root}/state", render).awaitTermination()
    table.clean_up()
    return table.read(table.latest()).select("id", "is_notified")


# Pages land in three rounds, ten days apart, by page number. Of details, by the digest of their key, some never
# land, some land with the round after (three days later), the others with the listing.
ROUND = "CAST(floor(job_id / 100.0) AS BIGINT) % 3"


@query("stream_details", f"""
    SELECT platform, board AS identifier, ext_id, 'posting' AS outcome FROM @v_postings
    WHERE platform IN ('smartrecruiters', 'workday') AND {RELEVANT} AND {LOST_DETAIL} NOT IN ('0', '1', '2')
      AND NOT ({LOST_DETAIL} IN ('3', '4', '5') AND {ROUND} = 2)
    UNION ALL
    SELECT platform, board, '' || count(*), 'lost' FROM @v_postings
    WHERE platform IN ('smartrecruiters', 'workday') AND {RELEVANT} AND {LOST_DETAIL} IN ('0', '1', '2')
      AND {ROUND} < 2
    GROUP BY platform, board""")
def stream_details(v):
    start = F.lit(ASOF).cast("timestamp")
    outcomes = []
    for platform, made in (("smartrecruiters", smartrecruiters_pages), ("workday", workday_pages)):
        root = scratch_path(v.spark, f"details-{platform}")
        pages, found = made(v)
        # Landed first: the rounds are read from what is landed, not from pages made again.
        pages = pages.withColumn("scraped_at", start + F.make_dt_interval((F.col("page_no") % 3 * 10).cast("int")))
        pages.withColumn("in_round", (F.col("page_no") % 3).cast("int")).write.partitionBy("in_round").parquet(f"{root}/pages")
        # A detail knows its listing's round by the page the listing is on.
        listings, _ = late.feeds.DETAILED[platform]
        rounds = listings(v.spark.read.schema(pages.schema).parquet(f"{root}/pages")).select("identifier", "detail_key", (F.col("page_no") % 3).cast("int").alias("round"))
        digit = F.left(F.md5("detail_key"), F.lit(1))
        after = digit.isin("3", "4", "5").cast("int")
        found = found.join(rounds, ["identifier", "detail_key"]).filter(~digit.isin("0", "1", "2")).withColumns({
            "landed_at": start + F.make_dt_interval(F.col("round") * 10 + after * 3, F.lit(1)),
            "in_round": F.col("round") + after}).drop("round")
        found.write.partitionBy("in_round").parquet(f"{root}/details")
        for n in range(3):
            for name in ("pages", "details"):
                v.spark.read.parquet(f"{root}/{name}").filter(F.col("in_round") == n).drop("in_round") \
                    .write.mode("append").parquet(f"{root}/in/{name}")
            left, right = (v.spark.readStream.schema(t.schema).parquet(f"{root}/in/{name}") for name, t in (
                ("pages", pages), ("details", found.drop("in_round"))))
            run = inc.run_to_parquet(late.await_details(left, right, platform, "5 days"), f"{root}/out", f"{root}/state")
            run.awaitTermination()
            if late.late_rows(run):
                raise ValueError("rows arrived later than the delay allows")
        joined = v.spark.read.parquet(f"{root}/out")
        key = F.col("detail_key")
        ids = F.regexp_extract(key, "Role_(.*)$", 1) if platform == "workday" else key
        # Postings of the join itself, so that the rows of the result are the operator's.
        asked = joined.filter("detail is not null").select("identifier", ids.alias("ext_id"))
        if late.postings(joined, platform, start).count() != asked.count():
            raise ValueError("a listing with its detail gave no posting")
        outcomes += [asked.withColumn("outcome", F.lit("posting")).withColumn("platform", F.lit(platform)),
                     late.errors(joined, platform).select(
                         "platform", "identifier", F.col("broken_details").cast("string").alias("ext_id"),
                         F.lit("lost").alias("outcome"))]
    first, *rest = outcomes
    for more in rest:
        first = first.unionByName(more)
    return first


@query("stream_cascade", """
    SELECT 'embedding' AS kind, vec_id AS row_id FROM @embeddings
    WHERE vec_id IN (SELECT job_id FROM @v_jobs WHERE is_active)
    UNION ALL SELECT 'match', id FROM @v_matches
    WHERE job_id IN (SELECT job_id FROM @v_jobs WHERE is_active)""")
def stream_cascade(v):
    root = scratch_path(v.spark, "cascade")
    jobs = v("v_jobs").select("job_id", "is_active")
    vectors, matches = prune_orphans(jobs, v("v_vectors"), v("v_matches"))
    tables_ = [inc.KeyedTable(v.spark, f"{root}/{name}", "job_id") for name in ("embeddings", "matches")]
    for table, rows in zip(tables_, (vectors, matches)):
        table.start(rows)
    # Every inactive job is taken out; some of the active ones are taken out and put back in one batch.
    out = jobs.filter("not is_active or job_id % 7 = 0").select(
        "job_id", F.lit(1).cast("bigint").alias("ord"), F.lit("delete").alias("change"))
    back = jobs.filter("is_active and job_id % 7 = 0").select(
        "job_id", F.lit(2).cast("bigint").alias("ord"), F.lit("insert").alias("change"))
    changes = out.unionByName(back).withColumn("round", F.pmod(F.col("job_id"), F.lit(BATCHES)).cast("int"))
    changes.write.partitionBy("round").parquet(f"{root}/changes")
    for n in range(BATCHES):
        v.spark.read.parquet(f"{root}/changes").filter(F.col("round") == n).drop("round") \
            .write.mode("append").parquet(f"{root}/in")
        stream = v.spark.readStream.schema(changes.drop("round").schema).parquet(f"{root}/in")
        inc.cascade_stream(stream, tables_, f"{root}/state").awaitTermination()
    left, right = (t.read(t.latest()) for t in tables_)
    return left.select(F.lit("embedding").alias("kind"), F.col("job_id").alias("row_id")).unionByName(
        right.select(F.lit("match").alias("kind"), F.col("id").alias("row_id")))
