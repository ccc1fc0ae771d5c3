"""Scalar queries: names, URLs, text, dates, answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.catalog.patterns import contains_any
from openroles.catalog.registry import query
from openroles.catalog.views import ASOF, quoted
from openroles.functions import dates, scores, text
from openroles.functions.html import html_to_text
from openroles.operators.employers import url_key
from openroles.operators.vectors import embedder
from openroles.sources.resumes import backfill_profile_names, clean_resumes


@query("norm_employer", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, upper(trim(p_name)) AS employer
    FROM @lineitem JOIN @part ON l_partkey = p_partkey""")
def norm_employer(v):
    noisy = v.sql("""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE l_linenumber % 3 WHEN 0 THEN '\\t' || p_name || '\\n' WHEN 1
                    THEN '\\u00a0' || initcap(p_name) ELSE p_name || '  ' END AS name
        FROM @lineitem JOIN @part ON l_partkey = p_partkey""")
    return noisy.withColumn("employer", text.norm_employer(F.col("name"))).drop("name")


@query("canonical_url", "SELECT job_id, canon_url AS url FROM @v_postings")
def canonical_url(v):
    return v("v_postings").select("job_id", text.canonical_url(F.col("raw_url")).alias("url"))


@query("canonical_page_url", """
    SELECT page_id, rtrim(regexp_replace(regexp_replace(url, '[?#].*$', ''),
           '^(https?://[^/]*).*$', '\\1'), '/')
           || rtrim(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://[^/]*', ''), '/')
           AS url
    FROM @pages""")
def canonical_page_url(v):
    return v("pages").select("page_id", text.canonical_url(F.col("url")).alias("url"))


@query("url_hash", "SELECT job_id, md5(canon_url) AS url_hash FROM @v_postings")
def url_hash(v):
    return v("v_postings").select(
        "job_id", text.url_hash(text.canonical_url(F.col("raw_url"))).alias("url_hash"))


@query("url_job_key", "SELECT job_id, platform, board, ext_id FROM @v_postings")
def url_job_key(v):
    return v("v_postings").select("job_id", url_key(F.col("raw_url")).alias("k")).select(
        "job_id", "k.platform", "k.board", F.col("k.id").alias("ext_id"))


@query("brand_key", f"""
    SELECT p_partkey, coalesce(array_to_string(list_filter(
               regexp_extract_all(lower(employer), '[a-z0-9]+'),
               lambda w: w NOT IN ({', '.join(quoted(w) for w in fixed.LEGAL_SUFFIX_WORDS)})), ''), '')
           AS brand
    FROM @v_parts""")
def brand_key(v):
    return v("v_parts").select("p_partkey", text.brand_key(F.col("employer")).alias("brand"))


@query("slug_company", """
    SELECT p_partkey, array_to_string(list_transform(
             regexp_extract_all(lower(replace(slug, '-', ' ')), '[a-z]+|[^a-z]+'),
             lambda r: upper(r[1]) || substr(r, 2)), '') AS company
    FROM (SELECT p_partkey, replace(p_name, ' ', '-') || brand_no || 'x' AS slug FROM @v_parts)""")
def slug_company(v):
    slug = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.col("brand_no"), F.lit("x"))
    return v("v_parts").select("p_partkey", text.slug_company(slug).alias("company"))


@query("location_join", """
    SELECT c_custkey, array_to_string(list_filter(
             [CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, n_name,
              CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE r_name END],
             lambda p: p IS NOT NULL AND p <> ''), ', ') AS location
    FROM @customer JOIN @nation ON c_nationkey = n_nationkey JOIN @region ON n_regionkey = r_regionkey""")
def location_join(v):
    rows = v("customer").join(v("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        v("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    parts = F.array(
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")), F.col("n_name"),
        F.when(F.col("c_custkey") % 2 != 0, F.col("r_name")))
    return rows.select("c_custkey", text.join_non_empty(parts, ", ").alias("location"))


@query("resume_text_clean", """
    SELECT doc_id AS id, regexp_replace(regexp_replace(regexp_replace(text,
             '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'),
             '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g') AS resume_text
    FROM @documents""")
def resume_text_clean(v):
    docs = v("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("resume_text"))
    return clean_resumes(docs)


@query("extract_skills", f"""
    SELECT id, coalesce(array_to_string(list_filter(
             [{', '.join(quoted(s) for s in fixed.KNOWN_SKILLS)}],
             lambda s: contains(lower(resume_text), lower(s))), '|'), '') AS skills
    FROM @v_resumes""")
def extract_skills(v):
    return v("v_resumes").select(
        "id", F.array_join(text.extract_skills(F.col("resume_text")), "|").alias("skills"))


@query("profile_backfill", """
    SELECT id, CASE WHEN profile_name IS NULL OR trim(profile_name) = '' THEN 'SDE'
               ELSE profile_name END AS profile_name FROM @v_resumes""")
def profile_backfill(v):
    return backfill_profile_names(v("v_resumes").select("id", "profile_name"))


@query("embed_text", """
    SELECT job_id, title || ' ' || description AS embed_text FROM @v_postings""")
def embed_text(v):
    return v("v_postings").select(
        "job_id", text.embed_text(F.col("title"), F.col("description")).alias("embed_text"))


@query("embed_documents", """
    WITH words AS (SELECT doc_id, ('0x' || left(md5(w), 8))::BIGINT AS code FROM (
           SELECT doc_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+')) AS w FROM @documents) WHERE w <> ''),
         places AS (SELECT doc_id, code % 384 + 1 AS place,
                           sum(CASE WHEN code >= 2147483648 THEN 1 ELSE -1 END) AS x
                    FROM words GROUP BY ALL HAVING x <> 0),
         vectors AS (SELECT doc_id, count(*) AS n, sqrt(sum(x * x)::DOUBLE) AS norm,
                            CASE WHEN count(*) < 384 THEN greatest(0, max(x)) ELSE max(x) END AS top,
                            sum(place * sign(x)) AS signed_places FROM places GROUP BY doc_id)
    SELECT doc_id, 384 AS dimension, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm,
           coalesce(round(CAST(top / norm AS FLOAT)::DOUBLE, 6), 0.0) AS largest,
           coalesce(n, 0)::BIGINT AS n_places, coalesce(signed_places, 0)::BIGINT AS signed_places
    FROM @documents LEFT JOIN vectors v USING (doc_id)""")
def embed_documents(v):
    encode = embedder()
    docs = v("documents").select("doc_id", encode(F.col("text")).alias("embedding"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return docs.select("doc_id", F.size("embedding").alias("dimension"),
                       F.round(norm, 4).alias("norm"),
                       F.round(F.array_max("embedding").cast("double"), 6).alias("largest"),
                       F.size(F.filter("embedding", lambda x: x != 0)).cast("bigint").alias("n_places"),
                       F.aggregate(F.transform("embedding", lambda x, i: (i + 1) * F.signum(x).cast("bigint")),
                                   F.lit(0).cast("bigint"), lambda a, x: a + x).alias("signed_places"))


@query("parse_vector_text", """
    SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN 0 ELSE len(embedding) END AS dimension,
           CASE WHEN vec_id % 10 = 0 THEN 0 ELSE round(embedding[1]::DOUBLE, 5) END AS first_value,
           vec_id % 10 = 0 AS embed_again
    FROM @embeddings""")
def parse_vector_text(v):
    as_text = F.when(F.col("vec_id") % 10 == 0, F.lit("[0.1, broken")).otherwise(
        F.to_json("embedding"))
    rows = v("embeddings").select("vec_id", text.parse_vector(as_text).alias("e"))
    return rows.select(
        "vec_id", F.coalesce(F.size("e"), F.lit(0)).cast("bigint").alias("dimension"),
        F.coalesce(F.round(F.get("e", F.lit(0)).cast("double"), 5), F.lit(0.0)).alias("first_value"),
        F.col("e").isNull().alias("embed_again"))


@query("html_to_text", """
    SELECT page_id, array_to_string(list_filter(list_transform(string_split(
             regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', chr(1), 'g'),
               '(?is)<(script|style)[^>]*>.*?</(script|style)>', chr(1), 'g'),
               '(?s)<[^>]*>', chr(1), 'g'), chr(1)),
             lambda p: regexp_replace(replace(replace(replace(replace(replace(replace(p, '&copy;', chr(169)), '&middot;', chr(183)),
               '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'),
               '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')),
             lambda p: p <> ''), ' ') AS page_text
    FROM @pages""")
def page_text(v):
    return v("pages").select("page_id", html_to_text(F.col("html")).alias("page_text"))


@query("sponsorship_signal", f"""
    SELECT company_id, CASE
        WHEN company_id % 3 = 0 AND total_approvals > 0 THEN
          printf('JD indicates sponsorship support; DOL history: %d approvals (%.1f%%).',
                 total_approvals, approval_rate::DOUBLE)
        WHEN company_id % 3 = 0 THEN {quoted(fixed.SIGNAL_EXPLICIT_ONLY)}
        WHEN total_approvals > 0 THEN
          printf('JD has no work-authorization exclusion; DOL history: %d approvals (%.1f%%). Confirm future sponsorship.',
                 total_approvals, approval_rate::DOUBLE)
        ELSE {quoted(fixed.SIGNAL_NONE)} END AS signal
    FROM @v_companies_rated""")
def sponsorship_signal(v):
    status = F.when(F.col("company_id") % 3 == 0, "explicit_sponsorship").otherwise("not_specified")
    return v("v_companies_rated").select("company_id", scores.sponsorship_signal(
        status, F.col("total_approvals"), F.col("approval_rate")).alias("signal"))


@query("parse_posted", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (7, 8) THEN ''
             ELSE strftime(CASE WHEN o_orderkey % 9 IN (0, 1, 2, 3)
                  THEN o_orderdate + INTERVAL 90 MINUTE ELSE o_orderdate END
                  , '%Y-%m-%dT%H:%M:%SZ') END AS posted
    FROM @orders""")
def parse_posted(v):
    rows = v.sql("""
        SELECT o_orderkey, o_orderkey % 9 AS form,
               CAST(unix_timestamp(o_orderdate) + 5400 AS BIGINT) AS secs,
               CASE o_orderkey % 9
                 WHEN 2 THEN date_format(o_orderdate + INTERVAL 90 MINUTE, "yyyy-MM-dd'T'HH:mm:ss'Z'")
                 WHEN 3 THEN date_format(o_orderdate + INTERVAL 210 MINUTE, "yyyy-MM-dd HH:mm:ss") || '+02:00'
                 WHEN 4 THEN date_format(o_orderdate, 'yyyy-MM-dd')
                 WHEN 5 THEN date_format(o_orderdate, 'MMMM d, yyyy')
                 WHEN 6 THEN date_format(o_orderdate, 'M/d/yyyy')
                 WHEN 7 THEN 'whenever' ELSE '' END AS txt
        FROM @orders""")
    epoch = F.when(F.col("form") == 1, F.col("secs") * 1000).otherwise(F.col("secs"))
    ts = F.when(F.col("form") < 2, dates.from_epoch(epoch)).otherwise(
        dates.parse_posted(F.col("txt")))
    return rows.select("o_orderkey", F.coalesce(dates.iso_utc(ts), F.lit("")).alias("posted"))


@query("relative_date", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_linenumber = 6 THEN '' ELSE strftime(
             TIMESTAMP '{ASOF}' - to_days(CAST(CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 1
               WHEN 3 THEN 31 WHEN 4 THEN l_quantity ELSE l_quantity + 7 END AS INTEGER)),
             '%Y-%m-%dT%H:%M:%SZ') END AS posted
    FROM @lineitem""")
def relative_date(v):
    rows = v.sql("""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber
             WHEN 1 THEN ' Posted Today' WHEN 2 THEN 'posted yesterday'
             WHEN 3 THEN 'Posted 30+ Days Ago'
             WHEN 4 THEN 'Posted ' || CAST(CAST(l_quantity AS INT) AS STRING) || ' Days Ago'
             WHEN 6 THEN 'unknown'
             ELSE 'POSTED  ' || CAST(CAST(l_quantity + 7 AS INT) AS STRING) || ' day ago' END AS txt
        FROM @lineitem""")
    ts = dates.relative_date(F.col("txt"), F.lit(ASOF).cast("timestamp"))
    return rows.withColumn("posted", F.coalesce(dates.iso_utc(ts), F.lit(""))).drop("txt")


@query("parse_score_json", """
    SELECT job_id, o IN (0, 1, 2, 3, 8) AS success,
           CASE o WHEN 0 THEN s WHEN 1 THEN s WHEN 2 THEN s WHEN 3 THEN '0'
                  WHEN 8 THEN '1' || s ELSE '' END AS score,
           CASE o WHEN 0 THEN 'ok ' || s WHEN 1 THEN 'text' WHEN 2 THEN 'fraction'
                  WHEN 3 THEN 'no score' WHEN 8 THEN 'big' ELSE '' END AS reasoning,
           CASE o WHEN 0 THEN 'Go|SQL' ELSE '' END AS key_matches,
           o = 8 AND CAST('1' || s AS INTEGER) > 100 AS out_of_range
    FROM (SELECT *, job_id % 10 AS o FROM @v_answers)""")
def parse_score_json(v):
    parsed = v("v_answers").select("job_id", scores.parse_score_json(
        F.col("response"), F.col("provider_error")).alias("r"))
    return parsed.select(
        "job_id", "r.success", F.coalesce(F.col("r.score").cast("string"), F.lit("")).alias("score"),
        "r.reasoning", F.array_join("r.key_matches", "|").alias("key_matches"), "r.out_of_range")


@query("parse_score_lines", """
    SELECT job_id, CASE job_id % 4 WHEN 0 THEN CAST(s AS BIGINT)
             WHEN 1 THEN least(CAST('9' || s AS BIGINT), 100) ELSE 0 END AS score,
           CASE WHEN job_id % 4 = 3 THEN substr(line_1 || chr(10) || line_2, 1, 200)
             ELSE replace(line_2, 'REASONING: ', '') END AS reasoning
    FROM @v_answers""")
def parse_score_lines(v):
    output = F.concat("line_1", F.lit("\n"), "line_2")
    return v("v_answers").select("job_id", scores.parse_score_lines(output).alias("r")).select(
        "job_id", "r.score", "r.reasoning")


@query("retry_wait", """
    SELECT job_id, round(CASE
        WHEN retry_after IS NOT NULL AND retry_after <> 'soon'
          THEN least(60.0, greatest(attempt + 1.0, CAST(retry_after AS DOUBLE) + 0.5))
        WHEN provider_error IS NULL THEN attempt + 1.0
        WHEN job_id % 4 = 0
          THEN least(60.0, greatest(attempt + 1.0, CAST(s AS DOUBLE) / 1000 + 0.5))
        ELSE least(60.0, greatest(attempt + 1.0, CAST(s || '.5' AS DOUBLE) + 0.5)) END::DOUBLE, 6) AS seconds
    FROM @v_answers""")
def retry_wait(v):
    seconds = scores.retry_wait(F.col("provider_error"), F.col("retry_after"), F.col("attempt"))
    return v("v_answers").select("job_id", F.round(seconds.cast("double"), 6).alias("seconds"))


@query("score_prompt", """
    SELECT m.id, 'Job Title: ' || title || chr(10) || 'Company: ' || company || chr(10) || chr(10)
           || 'Job Description:' || chr(10) || description || chr(10) || chr(10)
           || 'Resume:' || chr(10) || substr(resume_text, 1, 2000) || chr(10) || chr(10)
           || 'Rate this job''s relevance to the resume (0-100). Focus on:' || chr(10)
           || '1. Required skills match' || chr(10) || '2. Experience level alignment' || chr(10)
           || '3. Domain/industry fit' || chr(10) || '4. Career progression potential' || chr(10)
           || chr(10) || 'Respond with ONLY a JSON object.' AS prompt
    FROM @v_matches m JOIN @v_postings p ON p.job_id = m.job_id
         JOIN @v_resumes r ON r.id = m.resume_id""")
def score_prompt(v):
    rows = v("v_matches").select("id", "job_id", "resume_id").join(
        v("v_postings"), "job_id").join(
        v("v_resumes").select(F.col("id").alias("resume_id"), "resume_text"), "resume_id")
    return rows.select("id", scores.score_prompt(
        F.col("title"), F.col("company"), F.col("description"), F.col("resume_text"))
        .alias("prompt"))


@query("ats_url_filter", f"""
    SELECT page_id, {contains_any('link', fixed.ATS_URL_MARKERS)} AS any_ats,
           {contains_any('link', fixed.ATS_URL_MARKERS_SHORT)} AS short_list
    FROM (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '&to=jobs.lever.co'
            WHEN 1 THEN '/careers.icims.com' WHEN 2 THEN '&x=eightfold.ai' ELSE '' END AS link
          FROM @pages)""")
def ats_url_filter(v):
    rows = v.sql("""SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '&to=jobs.lever.co'
            WHEN 1 THEN '/careers.icims.com' WHEN 2 THEN '&x=eightfold.ai' ELSE '' END AS link
          FROM @pages""")
    return rows.select("page_id", text.is_ats_url(F.col("link")).alias("any_ats"),
                       text.is_ats_url(F.col("link"), fixed.ATS_URL_MARKERS_SHORT).alias("short_list"))


@query("search_query_text", f"""
    SELECT c_custkey, '({' OR '.join('site:' + s for s in fixed.SEARCH_SITES)}) '
           || lower(c_mktsegment) || ' engineer '
           || CASE c_custkey % 2 WHEN 0 THEN 'newgrad' ELSE 'midlevel' END AS query
    FROM @customer""")
def search_query_text(v):
    role = F.concat(F.lower("c_mktsegment"), F.lit(" engineer"))
    level = F.when(F.col("c_custkey") % 2 == 0, "newgrad").otherwise("midlevel")
    return v("customer").select("c_custkey", text.search_query(role, level).alias("query"))


def sql_text(text: str) -> str:
    """A Python text as SQL: quotes doubled, line breaks by their code."""
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _filled(template: str, *values: str) -> str:
    parts = template.split("%s")
    return " || ".join(x for pair in zip(map(sql_text, parts), [*values, None]) for x in pair if x)


@query("score_prompt_lines", f"""
    SELECT doc_id, {_filled(fixed.SCORE_LINES_TEMPLATE, "substr(coalesce(text, ''), 1, 2000)", "coalesce(source, '')",
                            "coalesce(lang, '')", "substr(coalesce(text, ''), 1, 1500)")} AS prompt FROM @documents""")
def score_prompt_lines(v):
    return v("documents").select("doc_id", scores.score_lines_prompt(
        F.col("source"), F.col("lang"), F.col("text"), F.col("text")).alias("prompt"))


@query("score_messages", f"""
    SELECT doc_id, 'system' AS first_role, {sql_text(fixed.SCORE_SYSTEM_PROMPT)} AS first_content, 'user' AS last_role,
           coalesce(text, '') AS last_content, 2 AS n FROM @documents""")
def score_messages(v):
    told = scores.score_messages(F.coalesce("text", F.lit("")))
    return v("documents").select("doc_id", told.alias("m")).select(
        "doc_id", F.col("m")[0]["role"].alias("first_role"), F.col("m")[0]["content"].alias("first_content"),
        F.col("m")[1]["role"].alias("last_role"), F.col("m")[1]["content"].alias("last_content"), F.size("m").alias("n"))
