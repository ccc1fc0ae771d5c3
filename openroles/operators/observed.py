"""Totals taken while a table is written, by observed metrics, so that nothing is scanned for them.

Metrics are counted in the pass before the write. There is no shuffle between
them and the files, so a repeated task counts once. Counts of an empty table are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.operators.matching import _stage_reason
from openroles.session import scratch_path

#: Every outcome of the two rules: the first that drops a hit, with its reason, or none.
OUTCOMES = (("location", fixed.REASON_FOREIGN), *(("authorization", r) for r in (
    fixed.REASON_TITLE_CLEARANCE, fixed.REASON_NO_SPONSORSHIP, fixed.REASON_CITIZENSHIP, fixed.REASON_PERMANENT_RESIDENT,
    fixed.REASON_CLEARANCE, fixed.REASON_OPT_EXCLUDED)), ("kept", ""))


def _written(observed: DataFrame, path: str) -> DataFrame:
    observed.write.parquet(path)
    return observed.sparkSession.read.schema(observed.schema).parquet(path)


def write_companies(companies: DataFrame, path: str | None = None,
                    min_approvals: int = fixed.MIN_QUALITY_APPROVALS) -> tuple[DataFrame, dict[str, int]]:
    """The employer table as written, and the totals ``rollup.etl_summary`` gives."""
    seen = Observation()
    observed = companies.observe(seen, F.count(F.lit(1)).alias("companies"),
                                 F.count_if(F.col("total_approvals") >= min_approvals).alias("quality_companies"))
    stored = _written(observed, path or scratch_path(companies.sparkSession, "companies"))
    return stored, seen.get


def write_kept(checked: DataFrame, path: str | None = None) -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """The hits that both rules keep, as written, and what ``matching.hit_funnel`` counts of all hits.

    Outcomes that no hit had are left out; one that is none of :data:`OUTCOMES` is an error.
    """
    def one_of(n: int) -> Column:
        return (F.col("_outcome.stage") == OUTCOMES[n][0]) & (F.col("_outcome.reason") == OUTCOMES[n][1])

    seen = Observation()
    stage, reason = _stage_reason(F.col("location_check"), F.col("auth_check"))
    told = checked.withColumn("_outcome", F.struct(stage.alias("stage"), reason.alias("reason"))).observe(
        seen, F.count(F.lit(1)).alias("all"), *[F.count_if(one_of(n)).alias(f"n{n}") for n in range(len(OUTCOMES))])
    kept = told.filter("_outcome.stage = 'kept'").drop("_outcome", "location_check", "auth_check")
    stored = _written(kept, path or scratch_path(checked.sparkSession, "kept"))
    counts = seen.get
    if sum(counts[f"n{n}"] for n in range(len(OUTCOMES))) != counts["all"]:
        raise ValueError("a rule gave an outcome that is not listed")
    return stored, [(*o, counts[f"n{n}"]) for n, o in enumerate(OUTCOMES) if counts[f"n{n}"]]
