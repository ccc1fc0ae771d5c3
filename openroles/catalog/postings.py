"""Posting queries: rules, recency, duplicates, balance, search results, targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.catalog import patterns
from openroles.catalog.registry import query
from openroles.catalog.views import ASOF, DESCRIPTIONS, LOOKBACK_DAYS, pick
from openroles.functions import rules
from openroles.functions.dates import iso_utc
from openroles.operators import dedup
from openroles.operators.matching import posting_funnel, scraped_on
from openroles.sources import search
from openroles.sources.feeds import board_api_rows, normalize_postings


def asof_ts():
    return F.lit(ASOF).cast("timestamp")


ISO = "coalesce(strftime(posted_date, '%Y-%m-%dT%H:%M:%SZ'), '')"


def shown_date():
    return F.coalesce(iso_utc(F.col("posted_date").cast("timestamp")), F.lit(""))


@query("title_level", f"""
    SELECT job_id, {patterns.title_level('title')} AS any_level,
           {patterns.title_level('title', 'newgrad')} AS newgrad,
           {patterns.title_level('title', 'midlevel')} AS midlevel
    FROM @v_postings""")
def title_level(v):
    title = F.col("title")
    return v("v_postings").select(
        "job_id", rules.title_level(title).alias("any_level"),
        rules.title_level(title, "newgrad").alias("newgrad"),
        rules.title_level(title, "midlevel").alias("midlevel"))


@query("recent_postings", f"""
    SELECT job_id, {ISO} AS posted FROM @v_postings
    WHERE posted_date IS NULL OR posted_date >= TIMESTAMP '{ASOF}' - INTERVAL {LOOKBACK_DAYS} DAY""")
def recent_postings(v):
    rows = v("v_postings")
    return rows.filter(rules.is_recent(F.col("posted_date").cast("timestamp"), asof_ts(),
                                       LOOKBACK_DAYS)).select("job_id", shown_date().alias("posted"))


@query("location_verdict", f"""
    SELECT job_id, split_part(verdict, '|', 1) = 'true' AS eligible,
           split_part(verdict, '|', 2) AS reason
    FROM (SELECT job_id, {patterns.location_verdict('loc', 'description')} AS verdict
          FROM (SELECT job_id, trim(location) AS loc, description FROM @v_postings))""")
def location_verdict(v):
    verdict = rules.location_verdict(F.col("location"), F.col("description"))
    return v("v_postings").select("job_id", verdict.alias("x")).select(
        "job_id", "x.eligible", "x.reason")


@query("auth_class", f"""
    SELECT job_id, split_part(verdict, '|', 1) AS status, split_part(verdict, '|', 2) AS reason
    FROM (SELECT job_id, {patterns.auth_class('description', 'title')} AS verdict
          FROM @v_postings)""")
def auth_class(v):
    verdict = rules.auth_class(F.col("description"), F.col("title"))
    return v("v_postings").select("job_id", verdict.alias("x")).select(
        "job_id", "x.status", "x.reason")


# The same rule over whole documents, each with one of the phrases at its end.
DOCUMENT_TEXT = "text || ' ' || " + pick("doc_id", DESCRIPTIONS)


@query("auth_class_documents", f"""
    SELECT doc_id, split_part(verdict, '|', 1) AS status, split_part(verdict, '|', 2) AS reason
    FROM (SELECT doc_id, {patterns.auth_class('body', "''")} AS verdict
          FROM (SELECT doc_id, {DOCUMENT_TEXT} AS body FROM @documents))""")
def auth_class_documents(v):
    docs = v.sql(f"SELECT doc_id, {DOCUMENT_TEXT} AS body FROM @documents")
    return docs.select("doc_id", rules.auth_class(F.col("body"), F.lit("")).alias("x")).select(
        "doc_id", "x.status", "x.reason")


@query("auth_eligible", f"""
    SELECT job_id FROM @v_postings
    WHERE NOT starts_with({patterns.auth_class('description', 'title')}, 'excluded')""")
def auth_eligible(v):
    return v("v_postings").filter(
        rules.is_auth_eligible(F.col("description"), F.col("title"))).select("job_id")


NORMALIZED = """
    SELECT job_id, trim(title) AS title, CASE WHEN company = '' THEN board ELSE company END AS company,
           trim(location) AS location, description || ' Python' AS description, canon_url AS job_url,
           md5(canon_url) AS url_hash, platform || '_feed' AS source, ext_id AS source_job_id,
           board AS source_board"""


@query("normalize_posting", NORMALIZED + ", " + ISO + " AS posted FROM @v_postings WHERE title <> ''")
def normalize_posting(v):
    raw = v("v_postings").select(
        F.col("job_id").alias("ord"), "title", "company", "location",
        F.concat(F.lit("<p>"), F.replace("description", F.lit("&"), F.lit("&amp;")),
                 F.lit("</p><ul><li> Python </li></ul>")).alias("description"),
        F.col("raw_url").alias("job_url"), F.concat("platform", F.lit("_feed")).alias("source"),
        "posted_date", F.col("ext_id").alias("source_job_id"),
        F.col("board").alias("source_board"), "scraped_at")
    return normalize_postings(raw).withColumnRenamed("ord", "job_id").withColumn(
        "posted", shown_date()).drop("posted_date", "scraped_at")


SIGHTING_ORDER = ["src_rank", "page_no", "pos"]
IDENTITY = """CASE WHEN source_job_id <> '' THEN replace(source, '_feed', '') || '|'
                   || lower(source_board) || '|' || source_job_id ELSE canon_url END"""


@query("dedup_postings", f"""
    SELECT job_id, source, page_no, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY {IDENTITY} ORDER BY src_rank, page_no, pos) AS n
      FROM @v_sightings) WHERE n = 1""")
def dedup_postings(v):
    rows = v("v_sightings").select("job_id", "src_rank", "source", "source_board",
                                   "source_job_id", "job_url", "page_no", "pos")
    kept = dedup.dedup_postings(rows, [F.col(c) for c in SIGHTING_ORDER])
    return kept.select("job_id", "source", "page_no", "pos")


MAX_JOBS = 500


@query("diverse_jobs", f"""
    SELECT job_id, company_key, {ISO} AS posted FROM (
      SELECT *, row_number() OVER (PARTITION BY company_key
             ORDER BY posted_date DESC NULLS LAST, job_id) AS n
      FROM (SELECT *, lower(CASE WHEN company = '' THEN board ELSE company END) AS company_key
            FROM @v_postings)) WHERE n <= 10
    ORDER BY posted_date DESC NULLS LAST, job_id LIMIT {MAX_JOBS}""")
def diverse_jobs(v):
    rows = v("v_postings").select("job_id", "company", F.col("board").alias("source_board"),
                                  "posted_date")
    chosen = dedup.diverse_jobs(rows, MAX_JOBS, [F.col("job_id")])
    return chosen.select("job_id", dedup.company_key().alias("company_key"),
                         shown_date().alias("posted"))


@query("board_cap", """
    SELECT board, count(*) AS listings, max(job_id) AS last_job FROM (
      SELECT board, job_id, row_number() OVER (PARTITION BY board ORDER BY job_id, page_no, pos) AS n
      FROM (SELECT platform AS board, job_id, page_no, pos FROM @v_sightings)) WHERE n <= 500
    GROUP BY board""")
def board_cap(v):
    rows = v("v_sightings").select(F.col("platform").alias("board"), "job_id", "page_no", "pos")
    capped = dedup.cap_listings(rows, ["board"], [F.col("job_id"), F.col("page_no"), F.col("pos")])
    return capped.groupBy("board").agg(F.count("*").alias("listings"),
                                       F.max("job_id").alias("last_job"))


@query("filter_funnel", f"""
    SELECT stage, reason, count(*) AS n FROM (
      SELECT CASE WHEN NOT relevant THEN 'title' WHEN old THEN 'recency'
                  WHEN loc LIKE 'false|%' THEN 'location'
                  WHEN auth LIKE 'excluded|%' THEN 'authorization' ELSE 'kept' END AS stage,
             CASE WHEN NOT relevant OR old THEN '' WHEN loc LIKE 'false|%' THEN split_part(loc, '|', 2)
                  WHEN auth LIKE 'excluded|%' THEN split_part(auth, '|', 2) ELSE '' END AS reason
      FROM (SELECT {patterns.title_level('title')} AS relevant,
                   coalesce(posted_date < TIMESTAMP '{ASOF}' - INTERVAL {LOOKBACK_DAYS} DAY, false) AS old,
                   {patterns.location_verdict('loc', 'description')} AS loc,
                   {patterns.auth_class('description', 'title')} AS auth
            FROM (SELECT *, trim(location) AS loc FROM @v_postings)))
    GROUP BY stage, reason""")
def filter_funnel(v):
    rows = v("v_postings").withColumn("posted_date", F.col("posted_date").cast("timestamp"))
    return posting_funnel(rows, asof_ts(), "all", LOOKBACK_DAYS)


@query("scraped_on_day", """
    SELECT CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS day, count(*) AS jobs FROM @v_jobs
    WHERE CAST(scraped_at AS DATE) = (SELECT max(CAST(scraped_at AS DATE)) FROM @v_jobs) GROUP BY 1""")
def scraped_on_day(v):
    latest = v("v_jobs").agg(F.max(F.to_date("scraped_at"))).scalar()
    rows = scraped_on(v("v_jobs"), latest)
    return rows.groupBy(F.to_date("scraped_at").cast("string").alias("day")).agg(
        F.count("*").alias("jobs"))


# Search results: every event is one result of a user's query at one of three tiers.
RESULTS = """
    SELECT 'q' || CAST(user_id AS STRING) AS query, event_id AS ord,
           CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS tier,
           'https://' || CASE CAST(floor(value) AS BIGINT) % 7 WHEN 0 THEN 'jobs.lever.co/a/'
             WHEN 1 THEN 'boards.greenhouse.io/b/jobs/' WHEN 2 THEN 'careers.icims.com/'
             ELSE 'example.com/' END || CAST(user_id % 40 AS STRING) || '-'
             || CAST(CAST(floor(value) AS BIGINT) AS STRING) AS link
    FROM @events"""


@query("search_tier_fallback", f"""
    SELECT query, tier, ord, link FROM (
      SELECT *, min(tier) OVER (PARTITION BY query) AS best FROM ({RESULTS})
      WHERE {patterns.contains_any('link', fixed.ATS_URL_MARKERS)}) WHERE tier = best""")
def search_tier_fallback(v):
    return search.tier_fallback(v.sql(RESULTS)).select("query", "tier", "ord", "link")


@query("distinct_urls_ordered", f"""
    SELECT link, min(ord) AS ord FROM ({RESULTS}) GROUP BY link""")
def distinct_urls_ordered(v):
    return search.distinct_urls(v.sql(RESULTS))


@query("search_results_rows", f"""
    SELECT query, tier, ord, link, CASE WHEN tier = 2 THEN 0 ELSE CAST(ord % 10 AS INTEGER) END AS position,
           CASE WHEN tier = 2 THEN 'site' ELSE '' END AS display_link
    FROM ({RESULTS})""")
def search_results_rows(v):
    item = F.when(F.col("tier") == 2, F.to_json(F.struct(F.array(F.struct(
        "link", F.lit("site").alias("displayLink"))).alias("items")))).otherwise(
        F.to_json(F.struct(F.array(F.struct(
            "link", (F.col("ord") % 10).alias("position"))).alias("organic_results"))))
    landed = v.sql(RESULTS).withColumn("payload", item).drop("link")
    return search.search_rows(landed).select("query", "tier", "ord", "link", "position",
                                             "display_link")


@query("multi_query_union", f"""
    SELECT job_url, query_no, job_id FROM (
      SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY query_no, job_id, page_no, pos) AS n
      FROM (SELECT CASE WHEN job_id % 50 = 0 THEN '' ELSE canon_url END AS job_url, src_rank AS query_no,
                   job_id, page_no, pos FROM @v_sightings) WHERE job_url <> '') WHERE n = 1""")
def multi_query_union(v):
    rows = v("v_sightings").select(
        F.when(F.col("job_id") % 50 == 0, "").otherwise(F.col("canon_url")).alias("job_url"),
        "job_id", "page_no", "pos", "src_rank")
    first = rows.filter("src_rank = 0").drop("src_rank")
    second = rows.filter("src_rank = 1").drop("src_rank")
    merged = dedup.union_queries(first, second,
                                 order=[F.col("job_id"), F.col("page_no"), F.col("pos")])
    return merged.select("job_url", "query_no", "job_id")


BOARD_APIS = {
    "remoteok": """SELECT title AS position, company, description, location, canon_url AS url,
                          CAST(posted_date AS STRING) AS date FROM @v_postings""",
    "github": """SELECT 'GH ' || title AS title, company, description, location, raw_url AS url,
                        CAST(scraped_at AS STRING) AS created_at FROM @v_postings""",
}
FEED_UNION = """
    SELECT title, company, description, CASE WHEN location = '' THEN 'Remote' ELSE location END AS location,
           canon_url AS job_url, 'remoteok' AS source,
           coalesce(CAST(posted_date AS VARCHAR), '') AS posted_date, md5(canon_url) AS url_hash
    FROM @v_postings
    UNION ALL
    SELECT 'GH ' || title, company, description, location, raw_url, 'github',
           CAST(scraped_at AS VARCHAR), md5(raw_url) FROM @v_postings"""


def board_apis(v):
    return board_api_rows(v.sql(BOARD_APIS["remoteok"]), "remoteok").unionByName(
        board_api_rows(v.sql(BOARD_APIS["github"]), "github")).withColumn(
        "posted_date", F.coalesce("posted_date", F.lit("")))


@query("feed_union_normalize", FEED_UNION)
def feed_union_normalize(v):
    return board_apis(v)
