"""The sponsorship job: filings to the employer snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from openroles import fixed_values as fixed
from openroles.operators.merge import upsert_companies
from openroles.operators.rollup import (
    company_rollup, preserve_h1b, quality_companies, with_approval_rate, with_totals,
)


def company_table(h1b: DataFrame | None, perm: DataFrame | None, lca: DataFrame | None,
                  stored: DataFrame | None = None, keep_stored_h1b: bool = False) -> DataFrame:
    """Employers with totals and rate; an H-1B file makes stored H-1B counts moot."""
    rollup = company_rollup(h1b, perm, lca)
    if keep_stored_h1b and h1b is None and stored is not None:
        rollup = preserve_h1b(rollup, stored)
    return with_approval_rate(with_totals(rollup))


def next_snapshot(stored: DataFrame, companies: DataFrame,
                  min_approvals: int = fixed.MIN_QUALITY_APPROVALS) -> DataFrame:
    """Stored employers with the qualifying new rows merged in; nothing is deleted."""
    return upsert_companies(stored, quality_companies(companies, min_approvals))
