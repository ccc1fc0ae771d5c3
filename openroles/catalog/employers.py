"""Employer queries: resolution, sponsor filters, and inserts of new postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from openroles.catalog.postings import FEED_UNION, board_apis
from openroles.catalog.registry import query
from openroles.functions.text import norm_employer
from openroles.operators import employers
from openroles.operators.merge import append_new
from openroles.session import cut_lineage, left_join_known


RESOLVED = """
    WITH asked AS (SELECT company, upper(trim(company)) AS name FROM @v_postings
                   WHERE trim(company) <> '' GROUP BY 1, 2),
    prefixed AS (
      SELECT name, arg_min(employer_name, (-total_approvals, employer_name)) AS employer_name
      FROM (SELECT DISTINCT name FROM asked) a JOIN @v_companies_rated c
           ON starts_with(upper(c.employer_name), a.name) AND c.total_approvals > 0
      GROUP BY name),
    chosen AS (
      SELECT a.company, a.name, coalesce(x.employer_name, s.employer_name, p.employer_name) AS employer_name,
             CASE WHEN x.employer_name IS NOT NULL THEN 'exact'
                  WHEN s.employer_name IS NOT NULL THEN 'spelled'
                  WHEN p.employer_name IS NOT NULL THEN 'prefix' ELSE 'new' END AS tier
      FROM asked a LEFT JOIN @v_companies_rated x ON x.employer_name = a.name
           LEFT JOIN @v_companies_rated s ON s.employer_name = a.company
           LEFT JOIN prefixed p ON p.name = a.name)
    SELECT c.company, coalesce(c.employer_name, CASE WHEN bool_or(c.company = c.name)
             OVER (PARTITION BY c.name) THEN c.name ELSE c.company END) AS employer_name,
           coalesce(r.total_approvals, 0) AS total_approvals,
           coalesce(r.approval_rate, 0)::DOUBLE AS approval_rate, c.tier
    FROM chosen c LEFT JOIN @v_companies_rated r ON r.employer_name = c.employer_name"""


@query("resolve_employer", RESOLVED)
def resolve_employer(v):
    rows = employers.resolve_employers(v("v_postings"), v("v_companies_rated"))
    return rows.select("company", "employer_name", "total_approvals",
                       F.col("approval_rate").cast("double").alias("approval_rate"), "tier")


@query("filter_by_sponsorship", """
    SELECT job_id, employer_name, approval_rate::DOUBLE AS approval_rate FROM (
      SELECT p.job_id, c.employer_name, c.approval_rate, row_number() OVER (
               PARTITION BY p.job_id ORDER BY c.total_approvals DESC, c.employer_name) AS n
      FROM @v_postings p JOIN @v_companies_rated c
           ON contains(upper(c.employer_name), upper(trim(p.company)))
      WHERE trim(p.company) <> '') WHERE n = 1 AND approval_rate >= 70""")
def filter_by_sponsorship(v):
    rows = employers.filter_by_sponsorship(
        v("v_postings").select("job_id", "company"), v("v_companies_rated"))
    return rows.select("job_id", "employer_name",
                       F.col("approval_rate").cast("double").alias("approval_rate"))


@query("feed_sponsored_only", f"""
    SELECT f.job_url, f.source, c.company_id, c.approval_rate::DOUBLE AS approval_rate
    FROM ({FEED_UNION}) f JOIN @v_companies_rated c ON c.employer_name = f.company""")
def feed_sponsored_only(v):
    stored = v("v_companies_rated")
    rows = employers.sponsored_only(board_apis(v), stored)
    return rows.select("job_url", "source", "company_id",
                       F.col("approval_rate").cast("double").alias("approval_rate"))


# The store holds two thirds of the postings, some under URLs of other hosts.
STORED = """
    SELECT job_id, CASE WHEN job_id % 12 = 4 THEN 'https://careers.example.com/o?ref=' || ext_id || '&x=1'
                        WHEN job_id % 3 = 0 THEN canon_url || '?utm=1' ELSE canon_url END AS job_url
    FROM @v_postings WHERE job_id % 3 <> 2"""
INCOMING = """
    SELECT job_id, src_rank, page_no, pos, company, title, description, location, source,
           source_job_id, posted_date, scraped_at,
           CASE WHEN job_id % 12 IN (4, 5) AND source_job_id <> ''
                THEN 'https://careers.example.com/jobs/' || ext_id ELSE canon_url END AS job_url
    FROM @v_sightings"""


NEW_ROWS = f"""
    WITH incoming AS (
      SELECT *, contains(job_url, 'careers.example.com') AS other_host
      FROM (SELECT *, row_number() OVER (PARTITION BY md5(job_url)
               ORDER BY src_rank, page_no, pos) AS n FROM ({INCOMING})) WHERE n = 1),
    stored AS (SELECT s.job_url, p.platform, p.ext_id,
                      contains(s.job_url, 'careers.example.com') AS other_host
               FROM ({STORED}) s JOIN @v_postings p USING (job_id))
    SELECT job_id, job_url, source FROM incoming i
    WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.job_url = i.job_url)
      AND NOT EXISTS (SELECT 1 FROM stored s WHERE NOT i.other_host AND NOT s.other_host
                      AND i.source_job_id <> '' AND s.ext_id = i.source_job_id
                      AND s.platform || '_feed' = i.source)
      AND NOT (i.other_host AND i.source_job_id <> '' AND EXISTS (
               SELECT 1 FROM stored s WHERE s.other_host AND contains(s.job_url, i.source_job_id)))
    """


def new_rows(v):
    incoming = v.sql(INCOMING).withColumn("url_hash", F.md5("job_url"))
    stored = v.sql(STORED).withColumn("url_hash", F.md5("job_url"))
    return employers.jobs_to_insert(incoming, stored, [F.col("src_rank"), F.col("page_no"), F.col("pos")])


@query("jobs_insert_new", NEW_ROWS)
def jobs_insert_new(v):
    return new_rows(v).select("job_id", "job_url", "source")


# The whole result of an ingest run: the rows of the job table, and the companies that come with them.
@query("jobs_insert_rows", f"""
    SELECT n.job_url, n.source, p.title, coalesce(p.description, '') AS description, coalesce(p.location, '') AS location,
           coalesce(r.employer_name, '') AS employer_name, trim(p.company) <> '' AS has_company,
           p.posted_date, true AS is_active, true AS no_salary
    FROM ({NEW_ROWS}) n JOIN @v_postings p USING (job_id) LEFT JOIN ({RESOLVED}) r ON r.company = p.company""")
def jobs_insert_rows(v):
    fresh = cut_lineage(new_rows(v))
    resolved = cut_lineage(employers.resolve_employers(fresh, v("v_companies_rated")))
    rows = employers.job_rows(fresh, resolved)
    names = resolved.select("company_id", "employer_name").distinct()
    return left_join_known(rows, names, "company_id").select(
        "job_url", "source", "title", "description", "location",
        F.coalesce("employer_name", F.lit("")).alias("employer_name"), F.col("company_id").isNotNull().alias("has_company"),
        "posted_date", "is_active", (F.col("salary_min").isNull() & F.col("salary_max").isNull()).alias("no_salary"))


@query("ingest_new_companies", f"""
    SELECT DISTINCT employer_name, 0::BIGINT AS total_approvals, 0::BIGINT AS total_denials
    FROM ({NEW_ROWS}) n JOIN @v_postings p USING (job_id) JOIN ({RESOLVED}) r ON r.company = p.company WHERE r.tier = 'new'""")
def ingest_new_companies(v):
    names = cut_lineage(new_rows(v).select("company").distinct())
    resolved = employers.resolve_employers(names, v("v_companies_rated"))
    return employers.new_companies(resolved).drop("company_id")


# Employers named by postings that the store lacks, each once, with its first posting.
@query("companies_append_new", """
    SELECT upper(trim(company)) AS employer_name, min(job_id) AS job_id FROM @v_postings
    WHERE trim(company) <> '' AND upper(trim(company)) NOT IN (SELECT employer_name FROM @v_companies) GROUP BY 1""")
def companies_append_new(v):
    named = v("v_postings").select(norm_employer(F.col("company")).alias("employer_name"), "job_id").where("employer_name <> ''")
    return append_new(v("v_companies"), named, "employer_name", [F.col("job_id")])
