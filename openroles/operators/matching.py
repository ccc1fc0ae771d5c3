"""From vector hits to scored, ranked matches."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.rules import auth_class, is_recent, location_verdict, title_level
from openroles.functions.scores import parse_score_json
from openroles.operators.dedup import first_n
from openroles.session import broadcast_if_bounded, left_join_known

COMPANY_FACTS = ("employer_name", "approval_rate", "total_approvals", "h1b_approvals",
                 "perm_approvals", "lca_approvals")


def hit_jobs(hits: DataFrame, jobs: DataFrame, hit_bound: int | None = None) -> DataFrame:
    """Vector hits with their active jobs and both rule verdicts, rank kept.

    Hits are few (``k`` per profile), jobs are many: with a proven bound on the
    hits they are broadcast, and the job table is scanned without a shuffle.
    The text rules then see the joined rows only.
    """
    active = jobs.filter("is_active").drop("is_active")
    joined = active.join(broadcast_if_bounded(hits, hit_bound), "job_id")
    return joined.withColumns({
        "location_check": location_verdict(F.col("location"), F.col("description"),
                                           joined=F.col("similarity")),
        "auth_check": auth_class(F.col("description"), F.col("title"),
                                 joined=F.col("similarity"))})


def eligible_hits(checked: DataFrame) -> DataFrame:
    kept = F.col("location_check.eligible") & (F.col("auth_check.status") != "excluded")
    return checked.filter(kept).drop("location_check", "auth_check")


def with_history(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Employer history, attached after all filters; absent history stays null."""
    facts = companies.select("company_id", *[c for c in COMPANY_FACTS if c in companies.columns])
    return left_join_known(rows, facts, "company_id")


def similar_jobs(hits: DataFrame, jobs: DataFrame, companies: DataFrame,
                 hit_bound: int | None = None) -> DataFrame:
    return with_history(eligible_hits(hit_jobs(hits, jobs, hit_bound)), companies)


def hit_funnel(checked: DataFrame) -> DataFrame:
    """How many hits each rule excluded, with reasons, and how many were kept."""
    stage, reason = _stage_reason(F.col("location_check"), F.col("auth_check"))
    return checked.groupBy(stage.alias("stage"), reason.alias("reason")).agg(
        F.count("*").alias("n"))


def _stage_reason(location: Column, auth: Column) -> tuple[Column, Column]:
    stage = F.when(~location["eligible"], "location") \
        .when(auth["status"] == "excluded", "authorization").otherwise("kept")
    reason = F.when(~location["eligible"], location["reason"]) \
        .when(auth["status"] == "excluded", auth["reason"]).otherwise("")
    return stage, reason


def posting_funnel(postings: DataFrame, asof: Column, level: str = "all",
                   lookback_days: int = 7) -> DataFrame:
    """First rule that drops each posting, counted by rule and reason."""
    location = location_verdict(F.col("location"), F.col("description"))
    auth = auth_class(F.col("description"), F.col("title"))
    # One struct per posting decides both columns, so each rule runs once.
    outcome = (
        F.when(~title_level(F.col("title"), level), F.struct(
            F.lit("title").alias("stage"), F.lit("").alias("reason")))
        .when(~is_recent(F.col("posted_date"), asof, lookback_days), F.struct(
            F.lit("recency").alias("stage"), F.lit("").alias("reason")))
    )
    stage, reason = _stage_reason(F.col("loc"), F.col("auth"))
    cheap = postings.withColumn("early", outcome)
    full = cheap.withColumns({
        "loc": F.when(F.col("early").isNull(), location),
        "auth": F.when(F.col("early").isNull(), auth)})
    return full.groupBy(
        F.coalesce("early.stage", stage).alias("stage"),
        F.coalesce("early.reason", reason).alias("reason"),
    ).agg(F.count("*").alias("n"))


def score_candidates(similar: DataFrame, rank: list[str],
                     max_jobs: int = fixed.SCORE_LIMIT) -> DataFrame:
    """First ``max_jobs`` survivors per profile, in similarity order."""
    return first_n(similar, ["resume_id"], [F.col(c) for c in rank], max_jobs)


def score_with(candidates: DataFrame, load: Callable[[], Callable[[str], str]],
               keys: tuple[str, ...] = ("resume_id", "job_id")) -> DataFrame:
    """Raw answers of a scorer for each candidate's ``prompt``.

    ``load`` builds the scorer once per task and returns prompt -> answer. An
    error it raises is recorded with the row, which is then deferred.
    """
    names = list(keys)
    schema = ", ".join(f"{k} {dict(candidates.dtypes)[k]}" for k in names)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for batch in batches:
            answers, errors = [], []
            for prompt in batch["prompt"]:
                try:
                    answers.append(scorer(prompt))
                    errors.append(None)
                except Exception as exc:
                    answers.append(None)
                    errors.append(str(exc) or type(exc).__name__)
            yield batch[names].assign(response=answers, provider_error=errors)

    return candidates.select(*names, "prompt").mapInPandas(
        ask, f"{schema}, response string, provider_error string")


def scored(answers: DataFrame, joined: str | None = None) -> DataFrame:
    """Answers parsed; failures stay as rows with a null score (deferred).

    ``joined``: a column of the rows the answers were joined to, if they were.
    """
    return answers.withColumn("r", parse_score_json(
        F.col("response"), F.col("provider_error"), F.col(joined) if joined else None)) \
        .drop("response", "provider_error").select("*", "r.*").drop("r")


def score_outcomes(parsed: DataFrame, by: list[str]) -> DataFrame:
    return parsed.groupBy(*by).agg(
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("deferred"))


def ranked(matches: DataFrame, score: str = "score", tie: str = "rank") -> DataFrame:
    """Best score first; equal scores stay in similarity order."""
    return matches.filter(F.col(score).isNotNull()).orderBy(
        F.desc(score), tie, *[c for c in ("resume_id", "job_id") if c in matches.columns])


def match_stats(matches: DataFrame, threshold: int = fixed.NOTIFY_SCORE,
                by: tuple[str, ...] = ("resume_id",)) -> DataFrame:
    return matches.groupBy(*by).agg(
        F.min("similarity").alias("min_similarity"), F.max("similarity").alias("max_similarity"),
        F.count("*").alias("matches"),
        F.count_if(F.col("score") >= threshold).alias("at_threshold"))


def with_threshold(scored_rows: DataFrame, threshold: int = fixed.NOTIFY_SCORE) -> DataFrame:
    return scored_rows.withColumn("meets_threshold",
                                  F.coalesce(F.col("score") >= threshold, F.lit(False)))


def active_matches(matches: DataFrame, jobs: DataFrame, companies: DataFrame,
                   resumes: DataFrame) -> DataFrame:
    """Matches of active jobs with job, employer and profile columns, best first."""
    return _match_rows(matches, jobs.filter("is_active"), companies, resumes).orderBy(
        F.desc("score"), F.desc("matched_at"), "id")


def _match_rows(matches: DataFrame, jobs: DataFrame, companies: DataFrame,
                resumes: DataFrame) -> DataFrame:
    job_facts = jobs.drop("is_active", "posted_date")
    profile = resumes.select(F.col("id").alias("resume_id"),
                             F.col("profile_name").alias("resume_profile"))
    return with_history(matches.join(job_facts, "job_id"), companies).join(profile, "resume_id")


def unnotified_matches(matches: DataFrame, jobs: DataFrame, companies: DataFrame,
                       resumes: DataFrame, min_score: int = fixed.NOTIFY_SCORE) -> DataFrame:
    """Pending matches at or above the score, flattened with explicit defaults."""
    pending = matches.filter(~F.col("is_notified") & (F.col("score") >= min_score))
    rows = _match_rows(pending, jobs, companies, resumes)
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(dict(rows.dtypes)[c]))
            for c in COMPANY_FACTS[1:] if c in rows.columns}
    return rows.withColumns({
        **zero,
        "employer_name": F.coalesce(F.when(F.col("employer_name") != "", F.col("employer_name")),
                                    F.lit("Unknown company")),
        "description": F.coalesce("description", F.lit("")),
        "resume_profile": F.coalesce(F.when(F.col("resume_profile") != "",
                                            F.col("resume_profile")), F.lit("Default")),
    })


def top_report(ranked_rows: DataFrame, order: list, n: int = 10) -> DataFrame:
    return ranked_rows.orderBy(*order).limit(n)


def scraped_on(jobs: DataFrame, day: Column) -> DataFrame:
    """Jobs scraped on a day."""
    return jobs.filter(F.to_date("scraped_at") == day)
