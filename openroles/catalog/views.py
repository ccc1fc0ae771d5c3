"""Job-market views over the given tables, in SQL both Spark and DuckDB read.

The given tables hold orders, parts, documents and the like. Each view below
reads them whole and presents them as filings, postings, matches and so on, so
the catalog's queries grow with the tables. A view refers to tables and other
views as ``@name``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from openroles.session import prepare

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ASOF = "2001-08-02 00:00:00"
LOOKBACK_DAYS = 400

TITLES = (
    "Software Engineer II", " Backend Developer ", "Senior Software Engineer",
    "Junior Software Engineer", "Product Manager", "Data Engineer, New Grad",
    "Machine Learning Engineer", "Software Engineer Intern", "Staff Platform Engineer",
    "SDE I", "Site Reliability Engineer", "Cloud Developer - Secret Clearance",
    "Account Executive", "Member of Technical Staff", "Sr. DevOps Engineer",
    "Application Development Engineer", "Director of Data",
)
LOCATIONS = (
    "New York, NY", "Remote - US", "Pune, India", "Berlin, DE", "Toronto, ON, CA",
    "Austin, TX; Toronto, ON, CA", "Chennai, India; Bellevue, WA", "Global",
    "Worldwide / Remote", "North America", "Head Office", "", "São Paulo, Brasil",
    "Dublin, Ireland | Boston, MA", "Remote - US, Canada or India", "LATAM", "Paris, TX",
    "U.S. only", "Hybrid - Manchester", "Vancouver, BC, CA", "  Denver , CO ", "Kyiv",
    "Americas (remote)", "Sunnyvale Campus", "Remote",
)
DESCRIPTIONS = (
    "Build and run data services.",
    "Applicants need to be authorized to work in the United States.",
    "We will not offer visa sponsorship for this opening.",
    "H-1B sponsorship is provided for strong applicants.",
    "This role is based in India.",
    "US citizenship is required.",
    "Must hold an active security clearance.",
    "We do not accept STEM OPT holders.",
    "This position is open to people in the United States, India and Brazil.",
    "Candidates may work worldwide.",
    "Must be a lawful permanent resident.",
    "No sponsorship required to apply.",
    "You must be legally authorized to work without any future sponsorship.",
    "We can sponsor visas & relocation.",
    "The job is remote, located in Canada.",
    "Green card holders or US citizens only.",
    "No visa sponsorship.",
    "The team is growing; join us on global projects.",
    "Eligible to obtain a government clearance.",
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(index: str, values: tuple[str, ...]) -> str:
    """One of the texts, chosen by an integer expression."""
    joined = quoted("~".join(values))
    return f"split_part({joined}, '~', CAST(({index}) % {len(values)} + 1 AS INTEGER))"


PLATFORM_OF = (
    "CASE o_custkey % 5 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' WHEN 2 THEN 'ashby' "
    "WHEN 3 THEN 'smartrecruiters' ELSE 'workday' END"
)

VIEWS: dict[str, str] = {
    # One employer name per part.
    "v_parts": """
        SELECT p_partkey, p_size, p_name, replace(p_brand, 'Brand#', '') AS brand_no,
               p_name || ' unit ' || replace(p_brand, 'Brand#', '')
               || CASE p_partkey % 4 WHEN 0 THEN ' LLC' WHEN 1 THEN ' Inc'
                  WHEN 2 THEN ' Technologies Ltd' ELSE ' Holdings' END AS employer
        FROM @part""",
    "v_h1b": """
        SELECT p_partkey AS ord,
               CASE WHEN p_partkey % 41 = 0 THEN 'N/A' WHEN p_partkey % 43 = 0 THEN '  '
                    WHEN p_partkey % 3 = 0 THEN upper(employer)
                    WHEN p_partkey % 3 = 1 THEN '  ' || employer ELSE employer || ' ' END AS employer,
               CASE WHEN p_partkey % 7 = 0 THEN '1,234' WHEN p_partkey % 11 = 0 THEN NULL
                    ELSE CAST(p_size % 9 AS STRING) END AS initial_approval,
               CASE WHEN p_partkey % 13 = 0 THEN 'x' ELSE CAST(p_size % 3 AS STRING) END
                    AS initial_denial,
               CAST(p_size AS STRING) || '.0' AS continuing_approval,
               CASE WHEN p_size % 2 = 0 THEN '' ELSE '1' END AS continuing_denial,
               CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE '0' || CAST(51000 + p_size AS STRING) END
                    AS naics
        FROM @v_parts""",
    "v_lca": """
        SELECT CASE WHEN l_quantity = 50 THEN 'N/A' WHEN l_quantity = 49 THEN '   '
                    WHEN l_linenumber % 3 = 0 THEN upper(employer)
                    WHEN l_linenumber % 3 = 1 THEN '  ' || employer ELSE employer || ' ' END
                    AS employer_name,
               CASE l_returnflag WHEN 'A' THEN 'Certified' WHEN 'N' THEN 'Certified - Withdrawn'
                    ELSE CASE WHEN l_linestatus = 'F' THEN 'Denied' END END AS case_status
        FROM @lineitem JOIN @v_parts ON l_partkey = p_partkey""",
    "v_perm": """
        SELECT CASE WHEN l_partkey % 2 = 0 THEN n_name || ' Corp' ELSE employer END
                    AS emp_business_name,
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN 'Withdrawn'
                    WHEN l_returnflag = 'R' THEN 'Denied'
                    WHEN l_returnflag = 'N' THEN 'Certified-Expired' ELSE 'Certified' END
                    AS case_status
        FROM @lineitem JOIN @supplier ON l_suppkey = s_suppkey
             JOIN @nation ON s_nationkey = n_nationkey JOIN @v_parts ON l_partkey = p_partkey""",
    # The employer store as it was before a run.
    "v_companies": """
        SELECT min(p_partkey) AS company_id, upper(employer) AS employer_name,
               CAST(max(51000 + p_size) AS STRING) AS naics_code,
               CAST(sum(CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size % 9 END) AS BIGINT)
                    AS h1b_approvals,
               CAST(sum(p_size % 3) AS BIGINT) AS h1b_denials,
               CAST(sum(CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size % 4 END) AS BIGINT)
                    AS perm_approvals,
               CAST(sum(p_size % 2) AS BIGINT) AS perm_denials,
               CAST(0 AS BIGINT) AS lca_approvals, CAST(0 AS BIGINT) AS lca_denials,
               CAST(sum(CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size % 9 + p_size % 4 END)
                    AS BIGINT) AS total_approvals,
               CAST(sum(p_size % 3 + p_size % 2) AS BIGINT) AS total_denials
        FROM @v_parts GROUP BY upper(employer)
        UNION ALL
        SELECT 100000000 + n_nationkey, 'Startup ' || lower(n_name), NULL,
               0, 0, 0, 0, 0, 0, 0, 0
        FROM @nation""",
    "v_companies_rated": """
        SELECT *, CAST(CASE WHEN total_approvals + total_denials > 0
                  THEN CAST(total_approvals AS DECIMAL(18,4)) * 100
                       / (total_approvals + total_denials) ELSE 0 END AS DECIMAL(5,2))
                  AS approval_rate
        FROM @v_companies""",
    # One posting per order. `canon_url` is what `raw_url` was made from.
    "v_postings": f"""
        SELECT job_id, custkey, platform, company, employer, board, ext_id, title, location,
               description, canon_url, posted_date, scraped_at, is_active,
               CASE platform
                 WHEN 'lever' THEN canon_url || CASE job_id % 3 WHEN 0 THEN '/apply?lever-source=x#form'
                      WHEN 1 THEN '/' ELSE '' END
                 WHEN 'ashby' THEN canon_url || CASE job_id % 3 WHEN 0 THEN '/Application/'
                      WHEN 1 THEN '?utm_source=y' ELSE '' END
                 WHEN 'greenhouse' THEN replace(canon_url, 'boards.greenhouse.io',
                      'Boards.Greenhouse.io') || '?gh_src=' || CAST(job_id AS STRING)
                 WHEN 'workday' THEN canon_url || ';v=1'
                 ELSE '  ' || canon_url || '#top' END AS raw_url
        FROM (
          SELECT *, CASE platform
                 WHEN 'greenhouse' THEN 'https://boards.greenhouse.io/' || board || '/jobs/' || ext_id
                 WHEN 'lever' THEN 'https://jobs.lever.co/' || board || '/' || ext_id
                 WHEN 'ashby' THEN 'https://jobs.ashbyhq.com/' || board || '/' || ext_id
                 WHEN 'smartrecruiters' THEN 'https://jobs.smartrecruiters.com/' || board || '/'
                      || ext_id || '-engineer'
                 ELSE 'https://' || board || '.wd5.myworkdayjobs.com/en-US/Careers/job/City/Role_'
                      || ext_id END AS canon_url
          FROM (
            SELECT o_orderkey AS job_id, o_custkey AS custkey, {PLATFORM_OF} AS platform, employer,
                   CASE o_orderkey % 6 WHEN 0 THEN employer
                        WHEN 1 THEN p_name || ' unit' WHEN 2 THEN p_name
                        WHEN 3 THEN 'Startup nation_' || CAST(o_custkey % 25 AS STRING)
                        WHEN 4 THEN CASE WHEN o_orderkey % 4 = 0
                             THEN upper('Fresh ' || CAST(o_custkey AS STRING))
                             ELSE 'Fresh ' || CAST(o_custkey AS STRING) END
                        ELSE '' END AS company,
                   replace(lower(p_name), ' ', '') || 'unit' || brand_no AS board,
                   CASE o_custkey % 5 WHEN 0 THEN CAST(100000 + o_orderkey AS STRING)
                        WHEN 1 THEN md5(CAST(o_orderkey AS STRING))
                        WHEN 2 THEN 'job-' || CAST(o_orderkey AS STRING)
                        WHEN 3 THEN CAST(7430000 + o_orderkey AS STRING)
                        ELSE 'R' || CAST(o_orderkey AS STRING) END AS ext_id,
                   CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE {pick('o_orderkey', TITLES)} END
                        AS title,
                   {pick('o_orderkey', LOCATIONS)} AS location,
                   {pick('o_orderkey', DESCRIPTIONS)} AS description,
                   CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS posted_date,
                   o_orderdate + INTERVAL 1 DAY AS scraped_at,
                   o_orderkey % 8 <> 0 AS is_active
            FROM @orders JOIN @v_parts ON o_custkey = p_partkey
          ) a
        ) b""",
    # Stored jobs: the same postings linked to the employer store.
    "v_jobs": """
        SELECT p.job_id, c.company_id, trim(p.title) AS title, trim(p.location) AS location,
               p.description, p.canon_url AS job_url, p.posted_date, p.scraped_at, p.is_active
        FROM @v_postings p LEFT JOIN @v_companies c
             ON c.employer_name = CASE WHEN p.job_id % 6 = 3 THEN p.company
                                       WHEN p.job_id % 7 = 0 THEN NULL
                                       ELSE upper(p.employer) END""",
    # Every order line is one sighting of its order's posting, by a feed or a search.
    "v_sightings": """
        SELECT CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS src_rank,
               CASE WHEN l_returnflag = 'N' THEN 'google_search' ELSE platform || '_feed' END
                    AS source,
               CASE WHEN l_returnflag = 'N' THEN '' WHEN l_linenumber % 2 = 0 THEN upper(board)
                    ELSE board END AS source_board,
               CASE WHEN l_returnflag = 'N' THEN '' ELSE ext_id END AS source_job_id,
               CASE WHEN l_linenumber % 2 = 0 THEN canon_url ELSE raw_url END AS job_url,
               canon_url, platform, ext_id, board, job_id, title, company, location, description,
               posted_date, scraped_at, l_linenumber AS page_no,
               CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-'
               || CAST(l_quantity AS STRING) || '-' || CAST(l_extendedprice AS STRING) AS pos
        FROM @lineitem JOIN @v_postings ON l_orderkey = job_id""",
    # Résumé profiles: every document is one person's text.
    "v_resumes": """
        SELECT doc_id AS id,
               CASE WHEN doc_id % 9 = 0 THEN '  ' WHEN doc_id % 10 = 0 THEN NULL
                    ELSE 'Profile ' || CAST(doc_id AS STRING) END AS profile_name,
               text || CASE doc_id % 4 WHEN 0 THEN ' Python, SQL and Spark on AWS.'
                    WHEN 1 THEN ' Worked at Google on storage.' WHEN 2 THEN ' CI/CD with Docker' ELSE '' END
                    AS resume_text,
               doc_id % 3 <> 0 AS is_active
        FROM @documents""",
    # Stored matches, three rows per (job, résumé) pair.
    "v_match_log": """
        SELECT o_orderkey AS id, o_orderkey - o_orderkey % 3 AS job_id,
               CAST((o_orderkey - o_orderkey % 9) / 9 AS BIGINT) % 200 AS resume_id,
               CAST(CAST(o_orderkey % 10000 AS DECIMAL(9,4)) / 10000 AS DECIMAL(5,4))
                    AS cosine_similarity,
               CAST(floor(o_totalprice) AS BIGINT) % 101 AS score,
               'fits <' || o_orderpriority || '> & more' AS reasoning,
               o_custkey % 4 = 0 AS is_notified,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS matched_at
        FROM @orders""",
    # One stored match per pair.
    "v_matches": """
        SELECT max(id) AS id, job_id, resume_id, max(cosine_similarity) AS cosine_similarity,
               max(score) AS score, max(reasoning) AS reasoning,
               max(CASE WHEN is_notified THEN 1 ELSE 0 END) = 1 AS is_notified,
               coalesce(max(matched_at), TIMESTAMP '2000-01-01 00:00:00') AS matched_at
        FROM @v_match_log GROUP BY job_id, resume_id""",
    "v_vectors": "SELECT vec_id AS job_id, embedding FROM @embeddings",
    # What a model answered for each order's posting, good and bad.
    "v_answers": """
        SELECT o_orderkey AS job_id, o_custkey AS resume_id,
               CASE o_orderkey % 10
                 WHEN 0 THEN '{"score": ' || s || ', "reasoning": "ok ' || s || '", "key_matches": ["Go", "SQL"]}'
                 WHEN 1 THEN 'Sure! {"score": "' || s || '", "reasoning": "text", "meta": {"a": 1}} bye'
                 WHEN 2 THEN '{"score": ' || s || '.7, "reasoning": "fraction"}'
                 WHEN 3 THEN '{"reasoning": "no score"}'
                 WHEN 4 THEN '{"score": null, "reasoning": "null"}'
                 WHEN 5 THEN 'not json at all ' || s
                 WHEN 6 THEN NULL
                 WHEN 7 THEN '{"score": "high"}'
                 WHEN 8 THEN '{"score": 1' || s || ', "reasoning": "big"}'
                 ELSE '{"score": ' || s || ', "reasoning": "broken' END AS response,
               CASE WHEN o_orderkey % 10 = 6 THEN 'Rate limited, try again in '
                    || s || CASE WHEN o_orderkey % 4 = 0 THEN 'ms' ELSE '.5s' END END
                    AS provider_error,
               CASE WHEN o_orderkey % 30 = 6 THEN s WHEN o_orderkey % 30 = 16 THEN 'soon' END
                    AS retry_after,
               o_orderkey % 3 AS attempt,
               CASE o_orderkey % 4
                 WHEN 0 THEN 'SCORE: ' || s WHEN 1 THEN 'SCORE: 9' || s
                 WHEN 2 THEN 'Intro' ELSE 'SCORE: about ' || s END AS line_1,
               'REASONING: ' || o_orderpriority AS line_2, s
        FROM (SELECT *, CAST(CAST(floor(o_totalprice) AS BIGINT) % 101 AS STRING) AS s FROM @orders) o""",
}

REFERENCE = re.compile(r"@(\w+)")


class Views:
    """The given tables of one folder, and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir.rstrip("/")
        self.frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = self.sql(VIEWS[name]) if name in VIEWS else self.table(name)
        return self.frames[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run SQL with ``@name`` references."""
        names = {name: self(name) for name in REFERENCE.findall(text)}
        body = text.replace("{", "{{").replace("}", "}}")
        return self.spark.sql(REFERENCE.sub(r"{\1}", body), **names)


def duckdb_sql(body: str) -> str:
    """The same references as common table expressions, for a plain SQL engine."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in REFERENCE.findall(text):
            if name in VIEWS and name not in needed:
                need(VIEWS[name])
                needed.append(name)

    need(body)
    parts = [f"{n} AS ({REFERENCE.sub(r'\1', VIEWS[n])})" for n in needed]
    text = REFERENCE.sub(r"\1", body).strip()
    if text[:5].upper() == "WITH ":
        parts.append(text[5:].strip())
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + text
