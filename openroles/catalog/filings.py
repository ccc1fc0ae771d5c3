"""Filing queries: scans, roll-ups, totals, and the employer store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.catalog.registry import query
from openroles.catalog.views import Views, quoted
from openroles.functions.dates import candidate_releases, fiscal_year
from openroles.operators import observed, rollup
from openroles.operators.merge import upsert_companies
from openroles.plans.sponsorship import company_table, next_snapshot
from openroles.schemas import COUNTERS
from openroles.sources.filings import latest_release, scan_h1b

NULLS = ", ".join(quoted(t) for t in fixed.NULL_TOKENS)
H1B_NAMES = {
    "employer": "Employer", "initial_approval": "Initial Approval",
    "initial_denial": "Initial Denial", "continuing_approval": "Continuing Approval",
    "continuing_denial": "Continuing Denial", "naics": "NAICS",
}


def h1b(v: Views) -> DataFrame:
    return v("v_h1b").withColumnsRenamed(H1B_NAMES)


def perm(v: Views) -> DataFrame:
    return v("v_perm").withColumnsRenamed(
        {"emp_business_name": "EMP_BUSINESS_NAME", "case_status": "CASE_STATUS"})


def lca(v: Views) -> DataFrame:
    return v("v_lca").withColumnsRenamed(
        {"employer_name": "EMPLOYER_NAME", "case_status": "CASE_STATUS"})


def plain(companies: DataFrame) -> DataFrame:
    """Rate as double and missing NAICS as '', so result types are the same everywhere."""
    out = companies.withColumn("approval_rate", F.col("approval_rate").cast("double")) \
        if "approval_rate" in companies.columns else companies
    return out.withColumn("naics_code", F.coalesce("naics_code", F.lit(""))) \
        if "naics_code" in companies.columns else out


def name_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} IN ({NULLS}) THEN '' ELSE upper(trim({c})) END"


def count_sql(c: str) -> str:
    return f"CAST(trunc(coalesce(try_cast(trim({c}) AS DOUBLE), 0)) AS BIGINT)"


H1B_SCAN = f"""
    SELECT * FROM (
      SELECT ord, {name_sql('employer')} AS employer_name,
             CAST(CAST(trunc(try_cast(naics AS DOUBLE)) AS BIGINT) AS VARCHAR) AS naics_code,
             {count_sql('initial_approval')} AS initial_approvals,
             {count_sql('initial_denial')} AS initial_denials,
             {count_sql('continuing_approval')} AS continuing_approvals,
             {count_sql('continuing_denial')} AS continuing_denials
      FROM @v_h1b) WHERE employer_name <> ''"""
H1B_ROLLUP = f"""
    SELECT employer_name,
           (list(naics_code ORDER BY ord) FILTER (WHERE naics_code IS NOT NULL))[1] AS naics_code,
           CAST(sum(initial_approvals + continuing_approvals) AS BIGINT) AS h1b_approvals,
           CAST(sum(initial_denials + continuing_denials) AS BIGINT) AS h1b_denials
    FROM ({H1B_SCAN}) GROUP BY employer_name"""


def disclosure_sql(view: str, column: str, program: str) -> str:
    return f"""
    SELECT employer_name,
           count(*) FILTER (WHERE contains(status, 'CERTIFIED')) AS {program}_approvals,
           count(*) FILTER (WHERE contains(status, 'DENIED') OR contains(status, 'WITHDRAWN'))
             AS {program}_denials
    FROM (SELECT {name_sql(column)} AS employer_name,
                 upper(coalesce(case_status, '')) AS status FROM @{view})
    WHERE employer_name <> '' GROUP BY employer_name"""


PERM_ROLLUP = disclosure_sql("v_perm", "emp_business_name", "perm")
LCA_ROLLUP = disclosure_sql("v_lca", "employer_name", "lca")
ZEROED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in COUNTERS)
COMPANY_ROLLUP = f"""
    SELECT employer_name, naics_code, {ZEROED}
    FROM ({H1B_ROLLUP}) h FULL JOIN ({PERM_ROLLUP}) p USING (employer_name)
         FULL JOIN ({LCA_ROLLUP}) l USING (employer_name)"""


def totals_sql(companies: str) -> str:
    return f"""
    SELECT *, h1b_approvals + perm_approvals + lca_approvals AS total_approvals,
           h1b_denials + perm_denials + lca_denials AS total_denials FROM ({companies})"""


def rated_sql(companies: str) -> str:
    return f"""
    SELECT * , CASE WHEN total_approvals + total_denials > 0
           THEN round(CAST(total_approvals AS DECIMAL(18,0)) * 100
                      / (total_approvals + total_denials), 2) ELSE 0 END::DOUBLE AS approval_rate
    FROM ({companies})"""


COMPANY_TABLE = rated_sql(totals_sql(COMPANY_ROLLUP))
COLUMNS = ", ".join(["employer_name", "coalesce(naics_code, '') AS naics_code", *COUNTERS,
                     "total_approvals", "total_denials", "approval_rate"])


def table(v: Views) -> DataFrame:
    return company_table(h1b(v), perm(v), lca(v))


@query("h1b_scan_coerce", f"SELECT * REPLACE (coalesce(naics_code, '') AS naics_code) FROM ({H1B_SCAN})")
def h1b_scan_coerce(v):
    rows = scan_h1b(h1b(v))
    return plain(rows.withColumn("naics_code", F.col("naics").cast("string")).drop("naics"))


@query("h1b_rollup", f"SELECT * REPLACE (coalesce(naics_code, '') AS naics_code) FROM ({H1B_ROLLUP})")
def h1b_rollup(v):
    return plain(rollup.h1b_rollup(h1b(v)))


@query("perm_rollup", PERM_ROLLUP)
def perm_rollup(v):
    return rollup.perm_rollup(perm(v))


@query("lca_rollup", LCA_ROLLUP)
def lca_rollup(v):
    return rollup.lca_rollup(lca(v))


@query("company_rollup",
       f"SELECT * REPLACE (coalesce(naics_code, '') AS naics_code) FROM ({COMPANY_ROLLUP})")
def company_rollup(v):
    return plain(rollup.company_rollup(h1b(v), perm(v), lca(v)))


@query("company_totals",
       f"SELECT employer_name, total_approvals, total_denials FROM ({totals_sql(COMPANY_ROLLUP)})")
def company_totals(v):
    return rollup.with_totals(rollup.company_rollup(h1b(v), perm(v), lca(v))).select(
        "employer_name", "total_approvals", "total_denials")


@query("approval_rate",
       f"SELECT employer_name, approval_rate FROM ({COMPANY_TABLE})")
def approval_rate(v):
    return plain(table(v).select("employer_name", "approval_rate"))


@query("quality_companies", f"SELECT {COLUMNS} FROM ({COMPANY_TABLE}) WHERE total_approvals >= 3")
def quality_companies(v):
    return plain(rollup.quality_companies(table(v)))


@query("sponsorship_companies", f"""
    SELECT {COLUMNS} FROM ({COMPANY_TABLE}) WHERE approval_rate >= 70 AND total_approvals >= 3
    ORDER BY approval_rate DESC, total_approvals DESC, employer_name""")
def sponsorship_companies(v):
    return plain(rollup.sponsorship_companies(table(v)))


ETL_SUMMARY = f"""
    SELECT count(*) AS companies, count(*) FILTER (WHERE total_approvals >= 3) AS quality_companies
    FROM ({COMPANY_TABLE})"""


@query("etl_summary", ETL_SUMMARY)
def etl_summary(v):
    return rollup.etl_summary(table(v))


@query("etl_summary_observed", ETL_SUMMARY)
def etl_summary_observed(v):
    _, totals = observed.write_companies(table(v))
    return v.spark.createDataFrame([totals], "companies bigint, quality_companies bigint")


@query("h1b_preserve_merge", f"""
    SELECT employer_name, coalesce(s.naics_code, '') AS naics_code,
           coalesce(s.h1b_approvals, 0) AS h1b_approvals, coalesce(s.h1b_denials, 0) AS h1b_denials,
           coalesce(perm_approvals, 0) AS perm_approvals, coalesce(perm_denials, 0) AS perm_denials,
           coalesce(lca_approvals, 0) AS lca_approvals, coalesce(lca_denials, 0) AS lca_denials
    FROM (SELECT * FROM ({PERM_ROLLUP}) p FULL JOIN ({LCA_ROLLUP}) l USING (employer_name)) f
         FULL JOIN (SELECT upper(employer_name) AS employer_name, naics_code, h1b_approvals,
                           h1b_denials FROM @v_companies) s USING (employer_name)""")
def h1b_preserve_merge(v):
    fresh = rollup.company_rollup(None, perm(v), lca(v))
    return plain(rollup.preserve_h1b(fresh, v("v_companies")))


@query("companies_upsert", f"""
    SELECT coalesce(n.employer_name, o.employer_name) AS employer_name,
           coalesce(CASE WHEN n.employer_name IS NULL THEN o.naics_code ELSE n.naics_code END, '')
             AS naics_code,
           coalesce(n.total_approvals, o.total_approvals) AS total_approvals,
           coalesce(n.total_denials, o.total_denials) AS total_denials,
           coalesce(n.approval_rate, o.approval_rate) AS approval_rate
    FROM (SELECT * FROM ({COMPANY_TABLE}) WHERE total_approvals >= 3) n
         FULL JOIN ({rated_sql('SELECT * FROM @v_companies')}) o
         ON n.employer_name = o.employer_name""")
def companies_upsert(v):
    stored = v("v_companies").drop("company_id")
    return plain(next_snapshot(stored, table(v)).select(
        "employer_name", "naics_code", "total_approvals", "total_denials", "approval_rate"))


MANIFEST = """
    SELECT CASE o_custkey % 2 WHEN 0 THEN 'perm' ELSE 'lca' END AS program,
           year(o_orderdate) AS fy, quarter(o_orderdate) AS quarter,
           o_orderkey % 3 AS pattern_no, o_orderstatus <> 'P' AS ok,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'text/html'
                ELSE 'application/Spreadsheet' END AS content_type,
           CAST(floor(o_totalprice / 4) AS BIGINT) AS bytes,
           'release-' || CAST(year(o_orderdate) AS STRING) || '-'
             || CAST(quarter(o_orderdate) AS STRING) || '-' || CAST(o_orderkey % 3 AS STRING) AS url
    FROM @orders"""


@query("newest_release", f"""
    SELECT program, CAST(fy AS INTEGER) AS fy, CAST(quarter AS INTEGER) AS quarter,
           pattern_no, url FROM (
      SELECT *, row_number() OVER (PARTITION BY program
             ORDER BY fy DESC, quarter DESC, pattern_no, url DESC) AS n
      FROM ({MANIFEST})
      WHERE ok AND contains(lower(content_type), 'spreadsheet') AND bytes > 10000) WHERE n = 1""")
def newest_release(v):
    return latest_release(v.sql(MANIFEST))


@query("fiscal_year", """
    SELECT CAST(day AS VARCHAR) AS day, CAST(fy AS INTEGER) AS fiscal_year,
           string_agg(CAST(fy - b AS VARCHAR) || 'Q' || CAST(q AS VARCHAR), ' '
                      ORDER BY b, q DESC) AS candidates
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
                 year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS fy
          FROM @orders), (VALUES (0), (1)) t(b), (VALUES (1), (2), (3), (4)) u(q)
    GROUP BY day, fy""")
def fiscal_years(v):
    days = v("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    shown = F.transform(candidate_releases(F.col("day")), lambda r: F.concat(
        r["fy"].cast("string"), F.lit("Q"), r["quarter"].cast("string")))
    return days.select(F.col("day").cast("string").alias("day"),
                       fiscal_year(F.col("day")).alias("fiscal_year"),
                       F.array_join(shown, " ").alias("candidates"))
