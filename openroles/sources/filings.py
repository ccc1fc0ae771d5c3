"""Filing inputs: raw scans, coercion, and the choice of the newest release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from openroles import fixed_values as fixed
from openroles import schemas
from openroles.functions.text import missing_to_null, norm_employer, strip

NUMBER_TEXT = r"^[+\-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+\-]?\d+)?$"


def read_h1b(spark: SparkSession, path: str) -> DataFrame:
    """H-1B rows as text, the columns taken by name, and ``ord``, their order in a file.

    Other columns may be there, in any order. Rows of one file are ordered by
    where their split starts and their place in it; files have no order.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = spark.read.option("header", True).csv(path)
    return rows.select(*[F.col(f"`{f.name}`") for f in _parse_datatype_string(schemas.H1B_RAW).fields],
                       (F.col("_metadata.file_block_start") + row).alias("ord"))


def read_disclosures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """PERM or LCA disclosures, landed as Parquet or CSV; callers select two columns."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path)


def to_count(c: Column) -> Column:
    """Counter text to a whole number; text that is none, or too large for one, counts 0."""
    text = strip(c)
    number = F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    return F.coalesce(number.try_cast("long"), F.lit(0).cast("long"))


def scan_h1b(raw: DataFrame) -> DataFrame:
    """Employer, NAICS number and the four counters of each H-1B row, blank employers dropped."""
    naics = F.when(strip(raw["NAICS"]).rlike(NUMBER_TEXT), strip(raw["NAICS"]).try_cast("double"))
    return raw.select(
        norm_employer(missing_to_null(raw["Employer"])).alias("employer_name"),
        naics.try_cast("long").alias("naics"),
        to_count(raw["Initial Approval"]).alias("initial_approvals"),
        to_count(raw["Initial Denial"]).alias("initial_denials"),
        to_count(raw["Continuing Approval"]).alias("continuing_approvals"),
        to_count(raw["Continuing Denial"]).alias("continuing_denials"),
        *[c for c in raw.columns if c == "ord"],
    ).filter(F.col("employer_name") != "")


def scan_disclosures(raw: DataFrame, employer_column: str) -> DataFrame:
    """Employer and upper-case status of one disclosure row, blank employers dropped."""
    return raw.select(
        norm_employer(missing_to_null(raw[employer_column])).alias("employer_name"),
        F.upper(F.coalesce(missing_to_null(raw["CASE_STATUS"]), F.lit(""))).alias("status"),
    ).filter(F.col("employer_name") != "")


def newest_file(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Path of the file whose name is last in order; file contents are not read."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
               .load(folder).select("path"))
    return listing.agg(F.max_by("path", F.element_at(F.split("path", "/"), -1)).alias("path"))


def latest_release(manifest: DataFrame) -> DataFrame:
    """Newest valid release per program: fiscal year, quarter, then pattern order.

    One aggregate with map-side combine, so a program with most of the
    candidates costs no more than the others.
    """
    valid = manifest.filter(
        F.col("ok") & F.contains(F.lower("content_type"), F.lit("spreadsheet"))
        & (F.col("bytes") > fixed.RELEASE_MIN_BYTES)
    )
    newest = F.max(F.struct("fy", "quarter", (-F.col("pattern_no")).alias("order"), "url"))
    return valid.groupBy("program").agg(newest.alias("r")).select(
        "program", "r.fy", "r.quarter", (-F.col("r.order")).alias("pattern_no"), "r.url")
