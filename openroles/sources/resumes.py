"""Résumé profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.text import clean_layout, strip


def read_resume_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file, whole file as one text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), strip(F.col("value")).alias("resume_text"))


def clean_resumes(resumes: DataFrame) -> DataFrame:
    return resumes.withColumn("resume_text", clean_layout(F.col("resume_text")))


def resume_profiles(resumes: DataFrame, profile_name: str | None = None) -> DataFrame:
    """The named profile, whatever its case, or else every active one; by name."""
    if profile_name:
        chosen = resumes.filter(F.lower("profile_name") == profile_name.lower())
    else:
        chosen = resumes.filter("is_active")
    return chosen.orderBy("profile_name", *[c for c in chosen.columns if c == "id"])


def backfill_profile_names(resumes: DataFrame) -> DataFrame:
    blank = F.trim(F.coalesce(F.col("profile_name"), F.lit(""))) == ""
    return resumes.withColumn("profile_name", F.when(
        blank, fixed.DEFAULT_PROFILE).otherwise(F.col("profile_name")))
