"""Posting dates and federal fiscal periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.text import let, strip

EPOCH_MILLIS_FROM = 10_000_000_000
WEEKDAY = r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+"

#: Posting ages above this are taken for unknown.
MOST_DAYS = 36_500


def from_epoch(c: Column) -> Column:
    """Timestamp of a number of seconds, or of milliseconds when it is too large for those."""
    millis = F.when(c > EPOCH_MILLIS_FROM, c.cast("double")).otherwise(c.cast("double") * 1000)
    return F.timestamp_millis(millis.cast("long"))


def parse_posted(c: Column) -> Column:
    """Timestamp of ISO 8601 text, epoch numbers or one of the listed formats, else null.

    Text without a zone is UTC, which is the session zone. Commas count as blanks.
    """
    formats = [f if "H" in f else f + fixed.TIME_OF_DAY for f in fixed.DATE_FORMATS]

    def parsed(text: Column) -> Column:
        iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
        epoch = F.when(text.rlike(r"^\d{10}(\d{3})?$"), from_epoch(text.try_cast("long")))
        plain = F.regexp_replace(F.regexp_replace(text, WEEKDAY, ""), r"[,\s]+", " ")
        others = let(plain, lambda p: F.coalesce(*[F.try_to_timestamp(p, F.lit(f)) for f in formats]))
        return F.coalesce(iso, epoch, F.when(text.rlike(r"\d{4}|/\d\d\b"), others))

    return let(strip(c), parsed)


def relative_date(c: Column, asof: Column) -> Column:
    """Timestamp of "posted 3 days ago" style text, seen from ``asof``."""
    texts = F.struct(F.lower(strip(F.coalesce(c, F.lit("")))).alias("low"), c.alias("raw"))
    return let(texts, lambda t: _relative_date(t["low"], t["raw"], asof))


def _relative_date(text: Column, raw: Column, asof: Column) -> Column:
    days = F.regexp_extract(text, r"(?U)posted\s+(\d+)\s+days?\s+ago", 1).try_cast("int")
    days = F.when(days <= MOST_DAYS, days)  # more is no date, but unknown

    def back(n: Column) -> Column:
        return asof - F.make_dt_interval(n)

    return (
        F.when(text.isin("posted today", "today"), asof)
        .when(text.isin("posted yesterday", "yesterday"), back(F.lit(1)))
        .when(days.isNotNull(), back(days))
        .when(F.contains(text, F.lit("30+ days")), back(F.lit(31)))
        .otherwise(parse_posted(raw))
    )


def fiscal_year(day: Column) -> Column:
    """US federal fiscal year: it starts in October."""
    return F.year(day) + F.when(F.month(day) >= 10, 1).otherwise(0)


def candidate_releases(day: Column) -> Column:
    """Array of (fy, quarter) to try, newest first, over two fiscal years."""
    fy = fiscal_year(day)
    return F.flatten(F.transform(F.array(F.lit(0), F.lit(1)), lambda back: F.transform(
        F.sequence(F.lit(4), F.lit(1)),
        lambda q: F.struct((fy - back).alias("fy"), q.alias("quarter")),
    )))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
