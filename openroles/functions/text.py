"""Text and URL expressions. Everything here is Column -> Column and stays in the JVM."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from openroles import fixed_values as fixed


def let(value: Column, body: Callable[[Column], Column],
        joined: Column | None = None) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used several times inside ``when`` chains is otherwise copied
    into each use, by the optimizer too, and copies inside conditions are not
    shared. A lambda argument is bound once and stays one expression.

    ``joined`` names a column of the other side of a join the rows come from.
    It does not change the value, but a filter on the result then refers to
    both sides and cannot be pushed below the join, where a costly rule would
    run on every row of a large table instead of on the few that joined.
    """
    if joined is None:
        return F.get(F.transform(F.array(value), body), F.lit(0))
    pair = F.array(F.struct(value.alias("value"), joined.alias("joined")))
    return F.get(F.transform(pair, lambda p: body(p["value"])), F.lit(0))


def strip(c: Column) -> Column:
    """Trim every Unicode white-space character (``trim`` alone takes only spaces)."""
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def non_empty(c: Column) -> Column:
    """``c`` with the empty string turned into null, for use in ``coalesce`` chains."""
    return F.when(c != "", c)


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*[non_empty(c) for c in columns], F.lit(""))


def missing_to_null(c: Column) -> Column:
    """Null for the field texts a CSV reader takes for a missing value."""
    return F.when(~c.isin(*fixed.NULL_TOKENS), c)


def norm_employer(c: Column) -> Column:
    return text_or_empty(F.upper(strip(c)))


def join_non_empty(parts: Column, separator: str) -> Column:
    """Join the non-empty entries of an array of strings."""
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), separator)


# A URL's scheme and authority, as RFC 3986 delimits them.
URL_ORIGIN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?"


def url_parts(url: Column) -> Column:
    """``struct(origin, path, query)`` of a URL.

    The origin is as written; the path is without the parameters of its last
    segment. Only the anchored origin is matched by pattern, the rest are byte
    searches.
    """
    bare = F.translate(strip(text_or_empty(url)), "\t\r\n", "")

    def split(u: Column) -> Column:
        before = F.substring_index(u, "#", 1)
        base = F.substring_index(before, "?", 1)
        return let(F.struct(base.alias("base"), F.regexp_extract(base, URL_ORIGIN, 0)
                            .alias("origin"), before.alias("before")), cut)

    def cut(t: Column) -> Column:
        path = F.substr(t["base"], F.length(t["origin"]) + 1)
        return F.struct(
            t["origin"].alias("origin"),
            F.when(F.contains(path, F.lit(";")), F.regexp_replace(path, r";[^/]*$", ""))
            .otherwise(path).alias("path"),
            F.substr(t["before"], F.length(t["base"]) + 2).alias("query"))

    return let(bare, split)


def origin_host(origin: Column) -> Column:
    """Host in lower case; empty for an origin without an authority."""
    return F.when(F.contains(origin, F.lit("//")), F.lower(F.substring_index(origin, "//", -1))) \
        .otherwise("")


def url_host(url: Column) -> Column:
    return let(url_parts(url), lambda p: origin_host(p["origin"]))


def without_apply(path: Column) -> Column:
    """Path without one closing "apply" or "application" segment."""
    return F.when(F.contains(F.lower(path), F.lit("/appl")), F.regexp_replace(
        path, r"(?i)/(?:apply|application)/?$", "")).otherwise(path)


def canonical_url(url: Column) -> Column:
    """Job URL without tracking parameters, fragment or an application suffix."""
    return let(url_parts(url), lambda p: F.concat(
        F.lower(p["origin"]), F.rtrim(without_apply(p["path"]), F.lit("/"))))


def url_hash(canonical: Column) -> Column:
    return F.md5(canonical)


def path_parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def brand_key(name: Column) -> Column:
    """Employer name or board slug reduced to a comparable brand."""
    words = F.regexp_extract_all(F.lower(text_or_empty(name)), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_join(F.filter(words, lambda w: ~w.isin(*fixed.LEGAL_SUFFIX_WORDS)), "")


def slug_company(slug: Column) -> Column:
    """Display name of a slug: each run of letters starts with a capital."""
    runs = F.regexp_extract_all(
        F.lower(F.replace(slug, F.lit("-"), F.lit(" "))), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)
    )
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.upper(F.substring(r, 1, 1)), F.substr(r, F.lit(2)))), "")


def clean_layout(text: Column) -> Column:
    """Collapse blanks and runs of empty lines left by document layout."""
    one_blank = F.regexp_replace(text, "[ \t]+", " ")
    return strip(F.regexp_replace(one_blank, "\n{3,}", "\n\n"))


def extract_skills(text: Column, whole_word: bool = False) -> Column:
    """Known skills found in the text, in list order.

    The default is the plain substring rule ("Go" is found in "google");
    ``whole_word`` asks for a boundary on both sides.
    """
    return let(F.lower(text_or_empty(text)), lambda low: _skills_in(low, whole_word))


def _skills_in(lowered: Column, whole_word: bool) -> Column:
    found = []
    for skill in fixed.KNOWN_SKILLS:
        hit = F.contains(lowered, F.lit(skill.lower()))
        if whole_word:
            literal = "".join("\\" + ch if ch in "+./-" else ch for ch in skill.lower())
            hit = hit & lowered.rlike(rf"(?U)(?<!\w){literal}(?!\w)")
        found.append(F.when(hit, F.lit(skill)))
    return F.array_compact(F.array(*found))


def escape_html(c: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"),
                         ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def one_decimal(c: Column) -> Column:
    """A rate with one decimal, rounded on its binary value (half to even)."""
    return F.call_function("format_number", c.cast("double"), F.lit("0.0"))


def embed_text(title: Column, description: Column) -> Column:
    return F.concat(text_or_empty(title), F.lit(" "), text_or_empty(description))


def contains_any(c: Column, markers: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.contains(c, F.lit(marker))
    return F.coalesce(hit, F.lit(False))


def is_ats_url(url: Column, markers: tuple[str, ...] = fixed.ATS_URL_MARKERS) -> Column:
    return contains_any(url, markers)


def search_query(role: Column, level: Column, sites: tuple[str, ...] = fixed.SEARCH_SITES) -> Column:
    site_part = " OR ".join(f"site:{site}" for site in sites)
    return F.concat(F.lit(f"({site_part}) "), role, F.lit(" "), level)


def parse_vector(c: Column) -> Column:
    """Vector from its text form ``[0.1,0.2]``; null when it does not parse."""
    return F.from_json(c, "array<float>")
