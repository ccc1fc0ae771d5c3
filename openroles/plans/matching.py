"""The matching job: profiles to candidates, and scored answers to stored matches."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.scores import score_prompt
from openroles.functions.text import parse_vector
from openroles.operators.matching import score_candidates, similar_jobs
from openroles.operators.merge import upsert_matches
from openroles.operators.vectors import cosine_topk
from openroles.session import rows_up_to

HIT_BOUND = 1_000_000  # hits of three numbers each, the most that is broadcast


def profile_vectors(resumes: DataFrame, embed: Callable[[Column], Column]) -> DataFrame:
    """Vector of each profile: stored as an array or as text, else embedded again.

    Only profiles without a usable vector go through the encoder.
    """
    stored = F.col("embedding")
    if dict(resumes.dtypes)["embedding"] == "string":
        stored = parse_vector(stored)
    rows = resumes.withColumn("embedding", stored)
    usable = F.coalesce(F.size("embedding") > 0, F.lit(False))
    ready = rows.filter(usable).select(F.col("id").alias("resume_id"), "embedding")
    missing = rows.filter(~usable).select(
        F.col("id").alias("resume_id"), embed(F.col("resume_text")).alias("embedding"))
    return ready.unionByName(missing)


def candidates(profiles: DataFrame, vectors: DataFrame, jobs: DataFrame, companies: DataFrame,
               k: int = fixed.MATCH_LIMIT, threshold: float = fixed.MATCH_THRESHOLD,
               max_jobs: int = fixed.SCORE_LIMIT) -> DataFrame:
    """Per profile: top-k by similarity, rule filters, history, first ``max_jobs``.

    The filters come after the top-k on purpose, so fewer than ``k`` may remain.
    """
    count = rows_up_to(profiles, HIT_BOUND // k)
    hits = cosine_topk(profiles, vectors, k, threshold, profiles=count)
    survivors = similar_jobs(hits, jobs, companies, None if count is None else count * k)
    return score_candidates(survivors, ["rank", "job_id"], max_jobs)


def with_prompts(rows: DataFrame, resumes: DataFrame) -> DataFrame:
    text = resumes.select(F.col("id").alias("resume_id"), "resume_text")
    return rows.join(text, "resume_id").withColumn("prompt", score_prompt(
        F.col("title"), F.col("employer_name"), F.col("description"), F.col("resume_text"))
    ).drop("resume_text")


def save_matches(stored: DataFrame, candidate_rows: DataFrame, parsed: DataFrame,
                 asof: Column) -> DataFrame:
    """Next match snapshot: successful scores only, deferred ones are left for a retry."""
    done = parsed.filter("success").select("resume_id", "job_id",
                                           F.col("score").cast("int").alias("score"), "reasoning")
    rows = candidate_rows.select("resume_id", "job_id", F.col("similarity")
                                 .cast("decimal(5,4)").alias("cosine_similarity"))
    return upsert_matches(stored, rows.join(done, ["resume_id", "job_id"]), asof)
