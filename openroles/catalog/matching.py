"""Matching queries: vectors, candidates, scores, merges, digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.catalog import patterns
from openroles.catalog.registry import query
from openroles.catalog.views import ASOF, quoted
from openroles.operators import dedup, matching, merge, observed
from openroles.operators.vectors import cosine_topk, embedder, register_functions
from openroles.plans import digest as digest_plan
from openroles.operators.digest import eligible_pending
from openroles.session import rows_up_to
from openroles.sources.resumes import resume_profiles


def asof_ts():
    return F.lit(ASOF).cast("timestamp_ntz")


K = 50
THRESHOLD = 0.05

# One profile per label: the mean of all its vectors.
CENTROIDS = """
    SELECT resume_id, list(x ORDER BY i) AS embedding FROM (
      SELECT label AS resume_id, i, round(avg(embedding[i]::DOUBLE), 6) AS x
      FROM @embeddings, range(1, 65) r(i) GROUP BY label, i) GROUP BY resume_id"""
HITS = f"""
    SELECT resume_id, job_id, similarity, rank FROM (
      SELECT resume_id, job_id, similarity, CAST(row_number() OVER (
               PARTITION BY resume_id ORDER BY similarity DESC, job_id) AS INTEGER) AS rank
      FROM (SELECT resume_id, job_id,
                   round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding), 9) AS similarity
            FROM @v_vectors v, ({CENTROIDS}) q) WHERE similarity > {THRESHOLD}) WHERE rank <= {K}"""


def profiles(v) -> DataFrame:
    """Mean vector per label; a partial sum per task, so a hot label stays cheap."""
    cells = v("embeddings").select(
        F.col("label").cast("bigint").alias("resume_id"), F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("resume_id", "i").agg(F.round(F.avg("x"), 6).alias("x"))
    return means.groupBy("resume_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("embedding"))


def hits(v) -> DataFrame:
    return cosine_topk(profiles(v), v("v_vectors"), K, THRESHOLD)


@query("cosine_topk", f"""
    SELECT resume_id::BIGINT AS resume_id, job_id, round(similarity, 6) AS similarity, rank
    FROM ({HITS})""")
def topk(v):
    return hits(v).withColumn("similarity", F.round("similarity", 6))


# The nearest jobs to the mean of all vectors, by the table function, from SQL.
MEAN = "SELECT list(x ORDER BY i) FROM (SELECT i, round(avg(embedding[i]::DOUBLE), 6) AS x FROM @embeddings, range(1, 65) r(i) GROUP BY i)"


@query("match_jobs_sql", f"""
    SELECT job_id, round(similarity, 6) AS similarity FROM (
      SELECT job_id, round(list_cosine_similarity(embedding::DOUBLE[], ({MEAN})), 9) AS similarity FROM @v_vectors)
    WHERE similarity > 0.01 ORDER BY similarity DESC, job_id LIMIT 40""")
def match_jobs_sql(v):
    register_functions(v.spark)
    return v.spark.sql("""
        SELECT job_id, round(similarity, 6) AS similarity
        FROM match_jobs(TABLE(SELECT job_id, embedding FROM {vectors}), (
               SELECT transform(array_sort(collect_list(struct(i, x))), s -> s.x)
               FROM (SELECT i, round(avg(x), 6) AS x FROM (SELECT posexplode(embedding) AS (i, x) FROM {vectors})
                     GROUP BY i)), 0.01D, 40)
        ORDER BY similarity DESC, job_id LIMIT 40""", vectors=v("v_vectors"))


LOC = patterns.location_verdict("trim(location)", "description")
AUTH = patterns.auth_class("description", "title")
SIMILAR = f"""
    SELECT h.resume_id::BIGINT AS resume_id, h.job_id, h.rank, h.similarity, j.title, j.company_id
    FROM ({HITS}) h JOIN @v_jobs j ON j.job_id = h.job_id
    WHERE j.is_active AND {LOC} LIKE 'true|%' AND NOT starts_with({AUTH}, 'excluded')"""


def similar(v) -> DataFrame:
    rows = profiles(v)
    count = rows_up_to(rows, 10_000)
    found = cosine_topk(rows, v("v_vectors"), K, THRESHOLD, profiles=count)
    return matching.similar_jobs(found, v("v_jobs"), v("v_companies_rated"),
                                 None if count is None else count * K)


@query("similar_jobs", f"""
    SELECT s.resume_id, s.job_id, s.rank, round(s.similarity, 6) AS similarity, s.title,
           coalesce(c.employer_name, '') AS employer_name,
           coalesce(c.total_approvals, 0) AS total_approvals
    FROM ({SIMILAR}) s LEFT JOIN @v_companies_rated c USING (company_id)""")
def similar_jobs(v):
    return similar(v).select(
        "resume_id", "job_id", "rank", F.round("similarity", 6).alias("similarity"), "title",
        F.coalesce("employer_name", F.lit("")).alias("employer_name"),
        F.coalesce("total_approvals", F.lit(0)).alias("total_approvals"))


HIT_FUNNEL = f"""
    SELECT stage, reason, count(*) AS n FROM (
      SELECT CASE WHEN loc LIKE 'false|%' THEN 'location' WHEN auth LIKE 'excluded|%' THEN 'authorization'
                  ELSE 'kept' END AS stage,
             CASE WHEN loc LIKE 'false|%' THEN split_part(loc, '|', 2)
                  WHEN auth LIKE 'excluded|%' THEN split_part(auth, '|', 2) ELSE '' END AS reason
      FROM (SELECT {LOC} AS loc, {AUTH} AS auth
            FROM ({HITS}) h JOIN @v_jobs j ON j.job_id = h.job_id WHERE j.is_active))
    GROUP BY stage, reason"""


@query("hit_funnel", HIT_FUNNEL)
def hit_funnel(v):
    return matching.hit_funnel(matching.hit_jobs(hits(v), v("v_jobs")))


@query("hit_funnel_observed", HIT_FUNNEL)
def hit_funnel_observed(v):
    _, counts = observed.write_kept(matching.hit_jobs(hits(v), v("v_jobs")))
    return v.spark.createDataFrame(counts, "stage string, reason string, n bigint")


@query("score_candidates", f"""
    SELECT resume_id, job_id, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY resume_id ORDER BY rank, job_id) AS n
      FROM ({SIMILAR})) WHERE n <= 5""")
def score_candidates(v):
    return matching.score_candidates(similar(v), ["rank", "job_id"], 5).select(
        "resume_id", "job_id", "rank")


SCORED = f"""
    SELECT h.resume_id::BIGINT AS resume_id, h.job_id, h.rank, h.similarity,
           CASE o.job_id % 10 WHEN 0 THEN CAST(s AS BIGINT) WHEN 1 THEN CAST(s AS BIGINT)
             WHEN 2 THEN CAST(s AS BIGINT) WHEN 3 THEN 0
             WHEN 8 THEN CAST('1' || s AS BIGINT) END AS score
    FROM ({HITS}) h JOIN @v_answers o ON o.job_id = h.job_id"""


def scored_hits(v) -> DataFrame:
    answers = v("v_answers").select("job_id", "response", "provider_error")
    return matching.scored(hits(v).join(answers, "job_id"), joined="similarity")


@query("score_outcomes", """
    SELECT resume_id, count(*) FILTER (WHERE job_id % 10 IN (0, 1, 2, 3, 8)) AS succeeded,
           count(*) FILTER (WHERE job_id % 10 NOT IN (0, 1, 2, 3, 8)) AS deferred
    FROM @v_answers GROUP BY resume_id""")
def score_outcomes(v):
    return matching.score_outcomes(matching.scored(v("v_answers").select(
        "resume_id", "job_id", "response", "provider_error")), ["resume_id"])


@query("ranked_matches", f"""
    SELECT resume_id, job_id, score, rank FROM ({SCORED}) WHERE score IS NOT NULL
    ORDER BY score DESC, rank, resume_id, job_id""")
def ranked_matches(v):
    return matching.ranked(scored_hits(v)).select("resume_id", "job_id", "score", "rank")


@query("match_stats", f"""
    SELECT resume_id, round(min(similarity), 6) AS min_similarity,
           round(max(similarity), 6) AS max_similarity, count(*) AS matches,
           count(*) FILTER (WHERE score >= 80) AS at_threshold
    FROM ({SCORED}) GROUP BY resume_id""")
def match_stats(v):
    rows = matching.match_stats(scored_hits(v))
    return rows.withColumns({c: F.round(c, 6) for c in ("min_similarity", "max_similarity")})


@query("meets_threshold", f"""
    SELECT resume_id, job_id, coalesce(score >= 80, false) AS meets_threshold FROM ({SCORED})""")
def meets_threshold(v):
    return matching.with_threshold(scored_hits(v)).select("resume_id", "job_id", "meets_threshold")


@query("match_dedup_newest", """
    SELECT id, job_id, resume_id FROM (
      SELECT *, row_number() OVER (PARTITION BY job_id, resume_id ORDER BY matched_at DESC, id DESC) AS n
      FROM @v_match_log WHERE matched_at IS NOT NULL) WHERE n = 1
    UNION ALL SELECT id, job_id, resume_id FROM @v_match_log WHERE matched_at IS NULL""")
def match_dedup_newest(v):
    return dedup.newest_matches(v("v_match_log")).select("id", "job_id", "resume_id")


MATCH_ROWS = """
    SELECT m.id, m.job_id, m.score, m.matched_at, m.is_notified, m.reasoning, m.cosine_similarity,
           j.title, j.location, j.job_url, j.description, j.is_active,
           c.employer_name, c.approval_rate, c.total_approvals, r.profile_name
    FROM @v_matches m JOIN @v_jobs j ON j.job_id = m.job_id
         LEFT JOIN @v_companies_rated c ON c.company_id = j.company_id
         JOIN @v_resumes r ON r.id = m.resume_id"""


def tables(v):
    return v("v_matches"), v("v_jobs"), v("v_companies_rated"), v("v_resumes")


@query("active_matches", f"""
    SELECT id, job_id, score, title, coalesce(employer_name, '') AS employer_name,
           coalesce(total_approvals, 0) AS total_approvals, coalesce(profile_name, '') AS resume_profile
    FROM ({MATCH_ROWS}) WHERE is_active ORDER BY score DESC, matched_at DESC, id""")
def active_matches(v):
    return matching.active_matches(*tables(v)).select(
        "id", "job_id", "score", "title",
        F.coalesce("employer_name", F.lit("")).alias("employer_name"),
        F.coalesce("total_approvals", F.lit(0)).alias("total_approvals"),
        F.coalesce("resume_profile", F.lit("")).alias("resume_profile"))


PENDING = f"""
    SELECT id, job_id, score, reasoning, cosine_similarity, title, location, description, job_url,
           coalesce(employer_name, 'Unknown company') AS employer_name,
           coalesce(approval_rate, 0) AS approval_rate, coalesce(total_approvals, 0) AS total_approvals,
           coalesce(CASE WHEN profile_name = '' THEN NULL ELSE profile_name END, 'Default') AS resume_profile
    FROM ({MATCH_ROWS}) WHERE NOT is_notified AND score >= 80"""


@query("unnotified_matches", f"""
    SELECT id, score, title, employer_name, approval_rate::DOUBLE AS approval_rate, total_approvals,
           resume_profile FROM ({PENDING})""")
def unnotified_matches(v):
    return matching.unnotified_matches(*tables(v)).select(
        "id", "score", "title", "employer_name",
        F.col("approval_rate").cast("double").alias("approval_rate"), "total_approvals",
        "resume_profile")


@query("top10_report", f"""
    SELECT id, job_id, score FROM ({MATCH_ROWS}) WHERE is_active
    ORDER BY score DESC, cosine_similarity DESC, id LIMIT 10""")
def top10_report(v):
    rows = matching.active_matches(*tables(v))
    return matching.top_report(rows, [F.desc("score"), F.desc("cosine_similarity"), F.col("id")]) \
        .select("id", "job_id", "score")


def escape_sql(c: str) -> str:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                         ("''", "&#x27;")):
        c = f"replace({c}, '{raw}', '{escaped}')"
    return c


def field_sql(c: str, default: str) -> str:
    return escape_sql(f"coalesce(CASE WHEN {c} = '' THEN NULL ELSE {c} END, '{default}')")


SIGNAL = f"""CASE WHEN auth LIKE 'explicit%' AND total_approvals > 0 THEN
      printf({quoted(fixed.SIGNAL_EXPLICIT_HISTORY.replace('%s', '%.1f'))}, total_approvals, approval_rate::DOUBLE)
    WHEN auth LIKE 'explicit%' THEN {quoted(fixed.SIGNAL_EXPLICIT_ONLY)}
    WHEN total_approvals > 0 THEN
      printf({quoted(fixed.SIGNAL_HISTORY.replace('%s', '%.1f'))}, total_approvals, approval_rate::DOUBLE)
    ELSE {quoted(fixed.SIGNAL_NONE)} END"""
DUE = f"""
    SELECT *, row_number() OVER (ORDER BY score DESC, cosine_similarity DESC, id) AS seq FROM (
      SELECT *, {AUTH} AS auth FROM ({PENDING}) WHERE {LOC} LIKE 'true|%')
    WHERE NOT starts_with(auth, 'excluded')"""


def digest_sql() -> str:
    from openroles.operators.digest import FRAGMENT, HEAD, TAIL

    values = ["seq", field_sql("title", "N/A"), field_sql("employer_name", "N/A"),
              field_sql("resume_profile", "Default"), field_sql("location", "N/A"),
              "CAST(score AS VARCHAR)", escape_sql(SIGNAL),
              field_sql("reasoning", "No reasoning available"), field_sql("job_url", "#")]
    return f"""
    SELECT seq, printf({quoted(FRAGMENT)}, {', '.join(values)}) AS html FROM ({DUE})
    UNION ALL SELECT 0, printf({quoted(HEAD)}, count(*)) FROM ({DUE}) HAVING count(*) > 0
    UNION ALL SELECT count(*) + 1, {quoted(TAIL)} FROM ({DUE}) HAVING count(*) > 0"""


@query("digest_html", digest_sql())
def digest_html(v):
    return digest_plan.pending_digest(*tables(v)).select("seq", "html")


@query("mark_notified", f"""
    SELECT id, job_id, resume_id, is_notified OR id IN (SELECT id FROM ({DUE})) AS is_notified
    FROM @v_matches""")
def mark_notified(v):
    due = eligible_pending(matching.unnotified_matches(*tables(v)))
    return merge.mark_notified(v("v_matches"), due).select("id", "job_id", "resume_id", "is_notified")


@query("matches_upsert", f"""
    WITH stored AS (SELECT * FROM @v_matches),
    incoming AS (
      SELECT job_id, resume_id % 200 AS resume_id, CAST(s AS BIGINT) AS score, 'new ' || s AS reasoning
      FROM @v_answers WHERE response IS NOT NULL)
    SELECT coalesce(i.job_id, m.job_id) AS job_id, coalesce(i.resume_id, m.resume_id) AS resume_id,
           coalesce(i.score, m.score) AS score, coalesce(i.reasoning, m.reasoning) AS reasoning,
           coalesce(m.is_notified, false) AS is_notified,
           strftime(coalesce(m.matched_at, TIMESTAMP '{ASOF}'), '%Y-%m-%d') AS matched_on
    FROM stored m FULL JOIN incoming i ON i.job_id = m.job_id AND i.resume_id = m.resume_id""")
def matches_upsert(v):
    incoming = v.sql("""
      SELECT job_id, resume_id % 200 AS resume_id, CAST(s AS BIGINT) AS score, 'new ' || s AS reasoning
      FROM @v_answers WHERE response IS NOT NULL""")
    rows = merge.upsert_matches(v("v_matches"), incoming, asof_ts())
    return rows.select("job_id", "resume_id", "score", "reasoning", "is_notified",
                       F.date_format("matched_at", "yyyy-MM-dd").alias("matched_on"))


@query("embedding_append", """
    SELECT job_id, CAST(round(embedding[1]::DOUBLE, 5) AS DOUBLE) AS first_value FROM (
      SELECT job_id, embedding, row_number() OVER (PARTITION BY job_id ORDER BY vec_id) AS n FROM (
        SELECT vec_id, vec_id - vec_id % 4 + 1 AS job_id, embedding FROM @embeddings))
    WHERE n = 1 AND job_id NOT IN (SELECT vec_id FROM @embeddings WHERE label < 5)""")
def embedding_append(v):
    stored = v("embeddings").filter("label < 5").select(F.col("vec_id").alias("job_id"))
    incoming = v("embeddings").select(
        "vec_id", (F.col("vec_id") - F.col("vec_id") % 4 + 1).alias("job_id"), "embedding")
    fresh = merge.append_new(stored, incoming, "job_id", [F.col("vec_id")])
    return fresh.select("job_id", F.round(F.get("embedding", F.lit(0)).cast("double"), 5)
                        .alias("first_value"))


@query("cascade_prune", """
    SELECT 'embedding' AS kind, vec_id AS row_id FROM @embeddings
    WHERE vec_id IN (SELECT job_id FROM @v_jobs WHERE is_active)
    UNION ALL SELECT 'match', id FROM @v_matches
    WHERE job_id IN (SELECT job_id FROM @v_jobs WHERE is_active)""")
def cascade_prune(v):
    jobs = v("v_jobs").filter("is_active")
    vectors, matches = merge.prune_orphans(jobs, v("v_vectors"), v("v_matches"))
    return vectors.select(F.lit("embedding").alias("kind"), F.col("job_id").alias("row_id")) \
        .unionByName(matches.select(F.lit("match").alias("kind"), F.col("id").alias("row_id")))


@query("resume_profiles", """
    SELECT id, coalesce(profile_name, '') AS profile_name, resume_text FROM @v_resumes
    WHERE is_active ORDER BY profile_name""")
def active_profiles(v):
    return resume_profiles(v("v_resumes")).select(
        "id", F.coalesce("profile_name", F.lit("")).alias("profile_name"), "resume_text")


@query("resume_upsert", f"""
    WITH stored AS (SELECT id, 'Profile ' || CAST(id AS VARCHAR) AS profile_name, resume_text, is_active
                    FROM @v_resumes),
    incoming AS (SELECT id + 5000000 AS id, 'PROFILE ' || CAST(id + 100 AS VARCHAR) AS profile_name,
                        'New: ' || resume_text AS resume_text, true AS is_active FROM @v_resumes)
    SELECT coalesce(s.id, i.id) AS id, coalesce(s.profile_name, i.profile_name) AS profile_name,
           coalesce(i.resume_text, s.resume_text) AS resume_text,
           coalesce(i.is_active, s.is_active) AS is_active,
           CASE WHEN i.id IS NULL THEN '' ELSE coalesce(array_to_string(list_filter(
             [{', '.join(quoted(s) for s in fixed.KNOWN_SKILLS)}],
             lambda k: contains(lower(i.resume_text), lower(k))), '|'), '') END AS skills,
           i.id IS NOT NULL AS embedded
    FROM stored s FULL JOIN incoming i ON lower(s.profile_name) = lower(i.profile_name)""")
def resume_upsert(v):
    base = v("v_resumes")
    stored = base.select(
        "id", F.concat(F.lit("Profile "), F.col("id").cast("string")).alias("profile_name"),
        "resume_text", F.lit(None).cast("array<float>").alias("embedding"),
        F.array().cast("array<string>").alias("skills"), "is_active")
    incoming = base.select(
        (F.col("id") + 5000000).alias("id"),
        F.concat(F.lit("PROFILE "), (F.col("id") + 100).cast("string")).alias("profile_name"),
        F.concat(F.lit("New: "), "resume_text").alias("resume_text"),
        F.lit(True).alias("is_active"))
    rows = merge.upsert_resumes(stored, incoming, embedder(), [F.col("id")])
    return rows.select("id", "profile_name", "resume_text", "is_active",
                       F.array_join("skills", "|").alias("skills"),
                       F.col("embedding").isNotNull().alias("embedded"))


def length_scorer():
    """A scorer without a model: the length of the prompt, with some prompts it refuses."""
    def answer(prompt: str) -> str:
        n = len(prompt)
        if n % 7 == 0:
            raise ValueError("busy")
        return '{"score": %d, "reasoning": "length"}' % (n % 101) if n % 5 else "no object"

    return answer


# The scorer hook: answers and refusals of a scorer, parsed; refused ones stay as deferred rows.
@query("score_with_hook", """
    SELECT job_id, custkey AS resume_id, NOT (n % 7 = 0 OR n % 5 = 0) AS success,
           CASE WHEN n % 7 <> 0 AND n % 5 <> 0 THEN n % 101 END AS score,
           CASE WHEN n % 7 = 0 THEN 'busy' WHEN n % 5 = 0 THEN 'response is not a score object' END AS error
    FROM (SELECT *, length(title || '|' || location || '|' || description) AS n FROM @v_postings)""")
def score_with_hook(v):
    prompts = v("v_postings").select("job_id", F.col("custkey").alias("resume_id"),
                                     F.concat_ws("|", "title", "location", "description").alias("prompt"))
    return matching.scored(matching.score_with(prompts, lambda: length_scorer())).select(
        "job_id", "resume_id", "success", "score", "error")
