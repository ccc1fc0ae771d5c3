"""Digest of pending matches: re-check, label, render, mark.

The document is kept as numbered fragments, one row per match plus a head and
a tail, instead of one string: writing them in order yields the document, and
nothing has to hold all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles.functions.rules import auth_class, is_us_eligible
from openroles.functions.scores import sponsorship_signal
from openroles.functions.text import escape_html
from openroles.operators.ranking import with_global_rank

# The document's markup.
HEAD = (
    "<html><head><style>"
    "body { font-family: Arial, sans-serif; } "
    ".match { border: 1px solid #ddd; padding: 15px; margin: 10px 0; border-radius: 5px; } "
    ".score { color: #2ecc71; font-weight: bold; font-size: 18px; } "
    ".company { color: #3498db; } "
    ".title { font-size: 16px; font-weight: bold; } "
    ".reasoning { color: #666; font-style: italic; margin-top: 10px; }"
    "</style></head><body><h2>🎯 Your Daily Job Matches</h2>"
    "<p>Found %d high-quality, OPT-compatible job matches for you!</p>"
)
FRAGMENT = (
    '<div class="match"><div class="title">%d. %s</div>'
    '<div class="company">🏢 %s</div><div>👤 Resume profile: %s</div><div>📍 %s</div>'
    '<div class="score">⭐ Match Score: %s/100</div><div>🛂 %s</div>'
    '<div class="reasoning">💡 %s</div><div style="margin-top: 10px;">'
    '<a href="%s" style="color: #3498db;">View Job →</a></div></div>'
)
TAIL = "</body></html>"


def eligible_pending(pending: DataFrame) -> DataFrame:
    """Pending matches that still pass both posting rules, with their signal."""
    match = F.col("score")
    checked = pending.filter(is_us_eligible(F.col("location"), F.col("description"), match)) \
        .withColumn("_auth", auth_class(F.col("description"), F.col("title"), match)["status"])
    return checked.filter(F.col("_auth") != "excluded").withColumn(
        "sponsorship_signal",
        sponsorship_signal(F.col("_auth"), F.col("total_approvals"), F.col("approval_rate")),
    ).drop("_auth")


def digest_fragments(eligible: DataFrame) -> DataFrame:
    """``(seq, id, html)`` in document order; head has ``seq`` 0, the tail comes last.

    Without matches there is no document.
    """
    order = [F.desc("score"), F.asc("rank_key"), F.asc("id")]
    shown = eligible.select("id", "score", F.negative("cosine_similarity").alias("rank_key"), "title", "employer_name",
                            "resume_profile", "location", "sponsorship_signal", "reasoning", "job_url")
    ranked = with_global_rank(shown, order, "seq")

    def field(name: str, default: str):
        return escape_html(F.coalesce(F.when(F.col(name) != "", F.col(name)), F.lit(default)))

    rows = ranked.select(
        "seq", "id",
        F.format_string(
            FRAGMENT, F.col("seq"), field("title", "N/A"), field("employer_name", "N/A"),
            field("resume_profile", "Default"), field("location", "N/A"),
            F.coalesce("score", F.lit(0)).cast("string"), escape_html(F.col("sponsorship_signal")),
            field("reasoning", "No reasoning available"), field("job_url", "#"),
        ).alias("html"))
    total = ranked.agg(F.count("*").alias("n")).filter("n > 0")
    no_id = F.lit(None).cast(dict(ranked.dtypes)["id"]).alias("id")
    head = total.select(F.lit(0).cast("bigint").alias("seq"), no_id,
                        F.format_string(HEAD, F.col("n")).alias("html"))
    tail = total.select((F.col("n") + 1).alias("seq"), no_id, F.lit(TAIL).alias("html"))
    return head.unionByName(rows).unionByName(tail)


def write_digest(fragments: DataFrame, path: str) -> None:
    """The document as text parts whose name order is the document order."""
    fragments.orderBy("seq").select("html").write.mode("overwrite").text(path)
