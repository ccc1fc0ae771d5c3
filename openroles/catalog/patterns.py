"""The fixed patterns as SQL for an engine without look-ahead (RE2)."""

from __future__ import annotations

from openroles import fixed_values as fixed
from openroles.catalog.views import quoted

CANADA = fixed.CANADIAN_CODE_SEGMENT.replace(r"(?=$|[;/])", r"($|[;/])")
NO_SPONSORSHIP_AHEAD = r"\bno\s+(?:visa\s+)?sponsorship\b"


def matches(column: str, *patterns: str, flags: str = "i") -> str:
    joined = "|".join(f"(?:{p})" for p in patterns).replace("(?=", "(?:")
    return f"regexp_matches({column}, {quoted(f'(?{flags})' + joined)})"


def us(column: str) -> str:
    return matches(column, *fixed.US_NAMED_LOCATION, fixed.US_STATE_CODE)


def location_verdict(loc: str, desc: str) -> str:
    """'true|reason' or 'false|reason' for trimmed, non-null text columns."""
    cut = f"regexp_replace({loc}, {quoted('(?i)' + CANADA)}, ' \\1', 'g')"
    cut = f"regexp_replace({cut}, {quoted('(?i)' + CANADA)}, ' \\1', 'g')"
    segments = f"list_filter(list_transform(regexp_split_to_array({loc}, '[;/|]'), lambda s: trim(s)), lambda s: s <> '')"
    ambiguous = (f"({matches('s', *fixed.FOREIGN_LOCATION)} AND {matches('s', fixed.US_STATE_CODE)}"
                 f" AND NOT {matches('s', *fixed.US_NAMED_LOCATION)})")
    bad = f"len(list_filter({segments}, lambda s: {ambiguous})) > 0"
    rest = f"coalesce(array_to_string(list_filter({segments}, lambda s: NOT {ambiguous}), ' ; '), '')"
    no = quoted("false|" + fixed.REASON_FOREIGN)

    def yes(reason: str) -> str:
        return quoted("true|" + reason)

    return f"""CASE
        WHEN {matches(loc, CANADA)} AND NOT {us(cut)} THEN {no}
        WHEN {bad} AND NOT {us(rest)} THEN {no}
        WHEN {us(loc)} THEN {yes(fixed.REASON_US)}
        WHEN {matches(loc, *fixed.GLOBAL_LOCATION)} THEN {yes(fixed.REASON_GLOBAL)}
        WHEN {matches(loc, *fixed.FOREIGN_LOCATION)} THEN {no}
        WHEN {matches(desc, *fixed.US_DESCRIPTION)} THEN {yes(fixed.REASON_US)}
        WHEN {matches(desc, *fixed.FOREIGN_DESCRIPTION)} THEN {no}
        WHEN {matches(desc, *fixed.GLOBAL_DESCRIPTION)} THEN {yes(fixed.REASON_GLOBAL)}
        WHEN {matches(loc, fixed.US_INCLUSIVE_REGION)} THEN {yes(fixed.REASON_REGION)}
        ELSE {yes(fixed.REASON_UNKNOWN)} END"""


def auth_class(desc: str, title: str) -> str:
    """'status|reason' for non-null text columns."""
    text = f"({title} || chr(10) || {desc})"
    rest = fixed.NO_SPONSORSHIP.replace(NO_SPONSORSHIP_AHEAD + r"(?!\s+required)|", "")
    blanked = f"regexp_replace({text}, '(?i)sponsorship\\s+required', '#', 'g')"

    def out(pattern: str, reason: str) -> str:
        return f"WHEN {matches(text, pattern, flags='is')} THEN {quoted('excluded|' + reason)}"

    return f"""CASE
        WHEN {matches(title, fixed.TITLE_CLEARANCE)}
             THEN {quoted('excluded|' + fixed.REASON_TITLE_CLEARANCE)}
        WHEN {matches(text, rest, flags='is')} OR {matches(blanked, NO_SPONSORSHIP_AHEAD)}
             THEN {quoted('excluded|' + fixed.REASON_NO_SPONSORSHIP)}
        {out(fixed.CITIZENSHIP, fixed.REASON_CITIZENSHIP)}
        {out(fixed.PERMANENT_RESIDENT, fixed.REASON_PERMANENT_RESIDENT)}
        {out(fixed.CLEARANCE, fixed.REASON_CLEARANCE)}
        {out(fixed.OPT_EXCLUDED, fixed.REASON_OPT_EXCLUDED)}
        WHEN {matches(text, *fixed.EXPLICIT_SPONSORSHIP)}
             THEN {quoted('explicit_sponsorship|' + fixed.REASON_SPONSORS)}
        ELSE {quoted('not_specified|' + fixed.REASON_NOT_SPECIFIED)} END"""


def title_level(title: str, level: str = "all") -> str:
    last = (matches(title, fixed.EARLY_CAREER_TITLE) if level == "newgrad"
            else f"NOT {matches(title, fixed.INTERN_TITLE)}")
    return (f"({matches(title, fixed.ENGINEERING_TITLE)} AND NOT "
            f"{matches(title, fixed.UPPER_LEVEL_TITLE)} AND {last})")


def contains_any(column: str, markers: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(m)})" for m in markers) + ")"
