"""Posting rules: title level, recency, US location and work-authorization language.

All are single Column expressions. The order of the ``when`` branches is the
precedence; a branch is evaluated only when the ones before it did not match,
so the long description patterns run only on rows the location left open.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.text import let, strip, text_or_empty

# i: ignore case, u: in all of Unicode, U: \b \s \w are Unicode, d: only \n ends a line.
FLAGS = "(?iuUd)"
FLAGS_DOTALL = "(?iuUds)"


def any_of(patterns: tuple[str, ...] | str, flags: str = FLAGS) -> str:
    """One alternation, so a list of patterns costs one scan of the text."""
    if isinstance(patterns, str):
        patterns = (patterns,)
    return flags + "|".join(f"(?:{p})" for p in patterns)


US_ANY = any_of((*fixed.US_NAMED_LOCATION, fixed.US_STATE_CODE))
US_NAMED = any_of(fixed.US_NAMED_LOCATION)
US_CODE = any_of(fixed.US_STATE_CODE)
FOREIGN = any_of(fixed.FOREIGN_LOCATION)


def title_level(title: Column, level: str = "all") -> Column:
    """Early or mid-career engineering title, at the asked level."""
    if level not in ("newgrad", "midlevel", "all"):
        raise ValueError(f"unknown level: {level}")

    def fits(t: Column) -> Column:
        relevant = t.rlike(any_of(fixed.ENGINEERING_TITLE)) & ~t.rlike(
            any_of(fixed.UPPER_LEVEL_TITLE))
        if level == "newgrad":
            return relevant & t.rlike(any_of(fixed.EARLY_CAREER_TITLE))
        return relevant & ~t.rlike(any_of(fixed.INTERN_TITLE))

    return let(text_or_empty(title), fits)


def is_recent(posted: Column, asof: Column, lookback_days: int = 7) -> Column:
    """Unknown dates are kept; known ones must not be older than the lookback."""
    return posted.isNull() | (posted >= asof - F.make_dt_interval(F.lit(lookback_days)))


def location_verdict(location: Column, description: Column,
                     joined: Column | None = None) -> Column:
    """``struct(eligible, reason)``: may the role be worked from the US.

    ``joined``: see :func:`openroles.functions.text.let`.
    """
    texts = F.struct(strip(text_or_empty(location)).alias("loc"),
                     strip(text_or_empty(description)).alias("desc"))
    return let(texts, lambda t: _location_verdict(t["loc"], t["desc"]), joined)


def _location_verdict(loc: Column, desc: Column) -> Column:
    def verdict(eligible: bool, reason: str) -> Column:
        return F.struct(F.lit(eligible).alias("eligible"), F.lit(reason).alias("reason"))

    foreign = verdict(False, fixed.REASON_FOREIGN)
    canada = FLAGS + fixed.CANADIAN_CODE_SEGMENT
    # Both segment rules are about codes behind a comma; most texts have none.
    has_comma = F.contains(loc, F.lit(","))
    only_canadian = has_comma & loc.rlike(canada) & ~F.regexp_replace(loc, canada, " ").rlike(US_ANY)

    # A segment such as "Berlin, DE": foreign place plus a state-like code and
    # nothing else American. The two cheap tests on the whole text come first;
    # no segment can match them when the text does not.
    segments = F.filter(F.transform(F.split(loc, "[;/|]"), strip), lambda s: s != "")

    def ambiguous(segment: Column) -> Column:
        return segment.rlike(FOREIGN) & segment.rlike(US_CODE) & ~segment.rlike(US_NAMED)

    others = F.array_join(F.filter(segments, lambda s: ~ambiguous(s)), " ; ")
    only_ambiguous = (
        has_comma & loc.rlike(US_CODE) & loc.rlike(FOREIGN)
        & F.exists(segments, ambiguous) & ~others.rlike(US_ANY)
    )
    return (
        F.when(only_canadian, foreign)
        .when(only_ambiguous, foreign)
        .when(loc.rlike(US_ANY), verdict(True, fixed.REASON_US))
        .when(loc.rlike(any_of(fixed.GLOBAL_LOCATION)), verdict(True, fixed.REASON_GLOBAL))
        .when(loc.rlike(FOREIGN), foreign)
        .when(desc.rlike(any_of(fixed.US_DESCRIPTION)), verdict(True, fixed.REASON_US))
        .when(desc.rlike(any_of(fixed.FOREIGN_DESCRIPTION)), foreign)
        .when(desc.rlike(any_of(fixed.GLOBAL_DESCRIPTION)), verdict(True, fixed.REASON_GLOBAL))
        .when(loc.rlike(any_of(fixed.US_INCLUSIVE_REGION)), verdict(True, fixed.REASON_REGION))
        .otherwise(verdict(True, fixed.REASON_UNKNOWN))
    )


def is_us_eligible(location: Column, description: Column,
                   joined: Column | None = None) -> Column:
    return location_verdict(location, description, joined).getField("eligible")


def _folded(text: Column) -> Column:
    """Lower case, with the four letters that match an ASCII one only by case folding."""
    return F.lower(F.translate(text, "ſKıİ", "skii"))


def auth_class(description: Column, title: Column, joined: Column | None = None) -> Column:
    """``struct(status, reason)`` of the posting's work-authorization language.

    Every pattern needs a certain literal somewhere ("sponsor", "citizen", ...).
    A byte search for it comes before the pattern, so whole texts without the
    literal, nearly all of them, never reach the regex engine.
    """
    title = text_or_empty(title)
    text = F.concat(title, F.lit("\n"), text_or_empty(description))
    both = let(F.struct(title.alias("title"), text.alias("text")), lambda t: F.struct(
        t["title"].alias("title"), t["text"].alias("text"), _folded(t["text"]).alias("low")))
    return let(both, lambda t: _auth_class(t["title"], t["text"], t["low"]), joined)


def _auth_class(title: Column, text: Column, low: Column) -> Column:
    def has(*literals: str) -> Column:
        hit = F.contains(low, F.lit(literals[0]))
        for literal in literals[1:]:
            hit = hit | F.contains(low, F.lit(literal))
        return hit

    def outcome(status: str, reason: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))

    def excluded_by(pattern: str) -> Column:
        return text.rlike(any_of(pattern, FLAGS_DOTALL))

    return (
        F.when(title.rlike(any_of(fixed.TITLE_CLEARANCE)),
               outcome("excluded", fixed.REASON_TITLE_CLEARANCE))
        .when(has("sponsor") & excluded_by(fixed.NO_SPONSORSHIP),
              outcome("excluded", fixed.REASON_NO_SPONSORSHIP))
        .when(has("citizen") & excluded_by(fixed.CITIZENSHIP),
              outcome("excluded", fixed.REASON_CITIZENSHIP))
        .when(has("green card", "permanent resident", "citizen", "national", "person",
                  "protected", "lawful") & excluded_by(fixed.PERMANENT_RESIDENT),
              outcome("excluded", fixed.REASON_PERMANENT_RESIDENT))
        .when(has("clearance") & excluded_by(fixed.CLEARANCE),
              outcome("excluded", fixed.REASON_CLEARANCE))
        .when(has("opt") & excluded_by(fixed.OPT_EXCLUDED),
              outcome("excluded", fixed.REASON_OPT_EXCLUDED))
        .when(has("sponsor", "h1b", "h-1b") & text.rlike(any_of(fixed.EXPLICIT_SPONSORSHIP)),
              outcome("explicit_sponsorship", fixed.REASON_SPONSORS))
        .otherwise(outcome("not_specified", fixed.REASON_NOT_SPECIFIED))
    )


def is_auth_eligible(description: Column, title: Column) -> Column:
    return auth_class(description, title).getField("status") != "excluded"
