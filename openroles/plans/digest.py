"""The digest job: pending matches to a document, and what becomes of them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from openroles import fixed_values as fixed
from openroles.operators.digest import digest_fragments, eligible_pending
from openroles.operators.matching import unnotified_matches
from openroles.operators.merge import mark_notified


def pending_digest(matches: DataFrame, jobs: DataFrame, companies: DataFrame,
                   resumes: DataFrame, min_score: int = fixed.NOTIFY_SCORE) -> DataFrame:
    return digest_fragments(eligible_pending(
        unnotified_matches(matches, jobs, companies, resumes, min_score)))


def after_sending(matches: DataFrame, fragments: DataFrame) -> DataFrame:
    """Match snapshot once the document was sent: its matches are notified."""
    return mark_notified(matches, fragments.filter("id is not null").select("id"))
