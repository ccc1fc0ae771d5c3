"""Employer roll-up over the three filing programs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.text import norm_employer
from openroles.schemas import COUNTERS
from openroles.sources.filings import scan_disclosures, scan_h1b


def _first_naics() -> Column:
    """First known NAICS code. Kept a number until here, so the aggregate stays a hash one."""
    known = F.when(F.col("naics").isNotNull(), F.col("ord"))
    return F.min_by("naics", known).cast("string")


def h1b_rollup(raw: DataFrame) -> DataFrame:
    """Sums per employer and the first NAICS code in input order (``ord``)."""
    rows = scan_h1b(raw)
    return rows.groupBy("employer_name").agg(
        _first_naics().alias("naics_code"),
        F.sum(F.col("initial_approvals") + F.col("continuing_approvals")).alias("h1b_approvals"),
        F.sum(F.col("initial_denials") + F.col("continuing_denials")).alias("h1b_denials"),
    )


def _approved(status: Column) -> Column:
    return F.contains(status, F.lit("CERTIFIED"))


def _denied(status: Column) -> Column:
    """A certified case later withdrawn counts on both sides."""
    return F.contains(status, F.lit("DENIED")) | F.contains(status, F.lit("WITHDRAWN"))


def disclosure_rollup(raw: DataFrame, employer_column: str, program: str) -> DataFrame:
    rows = scan_disclosures(raw, employer_column)
    return rows.groupBy("employer_name").agg(
        F.count_if(_approved(F.col("status"))).alias(f"{program}_approvals"),
        F.count_if(_denied(F.col("status"))).alias(f"{program}_denials"),
    )


def perm_rollup(raw: DataFrame) -> DataFrame:
    return disclosure_rollup(raw, "EMP_BUSINESS_NAME", "perm")


def lca_rollup(raw: DataFrame) -> DataFrame:
    return disclosure_rollup(raw, "EMPLOYER_NAME", "lca")


def _in_wide_form(rows: DataFrame, **values: Column) -> DataFrame:
    filled = [values.get(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTERS]
    naics = values.get("naics", F.lit(None)).cast("bigint").alias("naics")
    order = values.get("ord", F.lit(None)).cast("bigint").alias("ord")
    return rows.select("employer_name", naics, order, *filled)


def company_rollup(h1b: DataFrame | None, perm: DataFrame | None,
                   lca: DataFrame | None) -> DataFrame:
    """One row per employer over whichever programs are given.

    The programs are unioned in one wide shape and aggregated once: a single
    shuffle of partial sums, however uneven the employers are, where joining
    three roll-ups would shuffle and match them pairwise.
    """
    parts = []
    if h1b is not None:
        parts.append(_in_wide_form(
            scan_h1b(h1b), naics=F.col("naics"), ord=F.col("ord"),
            h1b_approvals=F.col("initial_approvals") + F.col("continuing_approvals"),
            h1b_denials=F.col("initial_denials") + F.col("continuing_denials")))
    for raw, column, program in ((perm, "EMP_BUSINESS_NAME", "perm"), (lca, "EMPLOYER_NAME", "lca")):
        if raw is not None:
            status = F.col("status")
            parts.append(_in_wide_form(scan_disclosures(raw, column), **{
                f"{program}_approvals": _approved(status).cast("bigint"),
                f"{program}_denials": _denied(status).cast("bigint")}))
    if not parts:
        raise ValueError("no filing program given")
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("employer_name").agg(
        _first_naics().alias("naics_code"), *[F.sum(c).alias(c) for c in COUNTERS])


def preserve_h1b(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Quarterly refresh without an H-1B file: stored H-1B counts replace the fresh ones."""
    old = (
        stored.select(norm_employer(F.col("employer_name")).alias("employer_name"),
                      F.col("employer_name").alias("_spelling"), "naics_code",
                      "h1b_approvals", "h1b_denials")
        .filter(F.col("employer_name") != "")
        # Stored names are unique as spelled; spellings that normalize alike
        # collapse to the last one.
        .groupBy("employer_name").agg(F.max_by(
            F.struct("naics_code", "h1b_approvals", "h1b_denials"), "_spelling").alias("s"))
    )
    other = [c for c in COUNTERS if not c.startswith("h1b")]
    filled = F.when(F.coalesce(F.col("naics_code"), F.lit("")) != "", F.col("naics_code")) \
        .otherwise(F.col("s.naics_code"))

    def h1b(name: str) -> Column:
        return F.when(F.col("s").isNotNull(), F.coalesce(f"s.{name}", F.lit(0))) \
            .otherwise(F.col(name)).alias(name)

    return fresh.join(old, "employer_name", "full_outer").select(
        "employer_name", filled.alias("naics_code"),
        h1b("h1b_approvals"), h1b("h1b_denials"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in other])


def with_totals(companies: DataFrame) -> DataFrame:
    def total(kind: str) -> Column:
        return F.col(f"h1b_{kind}") + F.col(f"perm_{kind}") + F.col(f"lca_{kind}")

    return companies.withColumns({
        "total_approvals": total("approvals"), "total_denials": total("denials")})


def approval_rate(approvals: Column, denials: Column) -> Column:
    """Percentage with two decimals, 0 without any case. Always derived, never taken over."""
    cases = approvals + denials
    rate = F.try_divide(approvals.cast("decimal(18,0)"), cases.cast("decimal(18,0)")) * 100
    return F.coalesce(F.when(cases > 0, rate), F.lit(0)).cast("decimal(5,2)")


def with_approval_rate(companies: DataFrame) -> DataFrame:
    return companies.withColumn("approval_rate", approval_rate(
        F.coalesce("total_approvals", F.lit(0)), F.coalesce("total_denials", F.lit(0))))


def quality_companies(companies: DataFrame,
                      min_approvals: int = fixed.MIN_QUALITY_APPROVALS) -> DataFrame:
    return companies.filter(F.col("total_approvals") >= min_approvals)


def sponsorship_companies(companies: DataFrame, min_rate: float = fixed.MIN_SPONSOR_RATE,
                          min_approvals: int = fixed.MIN_QUALITY_APPROVALS) -> DataFrame:
    return companies.filter(
        (F.col("approval_rate") >= min_rate) & (F.col("total_approvals") >= min_approvals)
    ).orderBy(F.desc("approval_rate"), F.desc("total_approvals"), "employer_name")


def etl_summary(companies: DataFrame, min_approvals: int = fixed.MIN_QUALITY_APPROVALS) -> DataFrame:
    return companies.agg(
        F.count("*").alias("companies"),
        F.count_if(F.col("total_approvals") >= min_approvals).alias("quality_companies"))
