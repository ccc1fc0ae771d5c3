"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one ``failed`` number whose bits say which rules failed. A policy is a
versioned mask of rules: a document is kept if ``failed & mask`` is 0. Policies
and ablations read the ledger only; ablations count documents per distinct
``failed`` value first, with partial sums, so what they compare is at most one
row per combination of rules.

Defined cases: a null text is an empty text (no words, rejected by
``few_words``). Repeated rows are judged each on their own. Columns of any name
may be carried; the ledger's own columns are made from the text column alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles.functions.text import let
from openroles.llm.common import SPACE_CHARS, SPACE_CLASS, WORD_CLASS, only

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_marks", "n_upper", "n_letters")


@dataclass(frozen=True)
class Rule:
    """Bit ``bit`` is set where ``fails`` holds of the measurements, given by name."""

    bit: int
    name: str
    fails: Callable[[Mapping[str, Column]], Column]


RULES = (
    Rule(0, "few_words", lambda m: m["n_words"] < 50),
    Rule(1, "repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule(2, "symbols", lambda m: 20 * m["n_symbols"] > m["word_chars"]),
    Rule(3, "repeated_lines", lambda m: (m["n_lines"] >= 4) & (2 * m["n_dup_lines"] > m["n_lines"])),
    Rule(4, "shouting", lambda m: (m["n_letters"] >= 20) & (100 * m["n_upper"] > 40 * m["n_letters"])),
    Rule(5, "exclamations", lambda m: 100 * m["n_marks"] > 30 * m["n_words"]),
    Rule(6, "long_words", lambda m: m["word_chars"] > 25 * m["n_words"]),
    Rule(7, "short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
)
BASE = ("few_words", "repeated_words")
#: Policies by version; the last is the one in force.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines"),
    "v3": tuple(r.name for r in RULES),
}
CURRENT = "v3"


def mask_of(names: tuple[str, ...]) -> int:
    return sum(1 << r.bit for r in RULES if r.name in names)


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def _repeats(words: Column) -> Column:
    """Words in windows of three words that occur twice or more.

    Windows are compared as text. Hashes come first: a text whose windows all
    hash apart has none that repeats, and only others sort their windows.
    """
    spots = F.sequence(F.lit(0), F.size(words) - 3)

    def covered(ordered: Column) -> Column:
        same = F.filter(ordered, lambda x, i: (
            (F.get(ordered, i - 1)["w"] == x["w"]) | (F.get(ordered, i + 1)["w"] == x["w"])) )
        return F.size(F.array_distinct(F.flatten(F.transform(
            same, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))))

    hashes = F.transform(spots, lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.transform(spots, lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"),
        i.alias("at")))
    exact = let(F.array_sort(windows), covered)
    return (F.when(F.size(words) < 4, F.lit(0))
            .when(F.size(F.array_distinct(hashes)) == F.size(words) - 2, F.lit(0))
            .otherwise(exact))


def measured(text: Column) -> Column:
    """All measurements of a text as a struct of longs."""
    def of_words(t: Column) -> Column:
        words = F.filter(F.split(t, SPACE_CLASS), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(WORD_CLASS))
        return let(F.struct(words.alias("w"), lines.alias("l")), lambda p: F.struct(*[
            c.cast("long").alias(name) for name, c in {
                "n_words": F.size(p["w"]),
                "word_chars": _without(t, SPACE_CHARS),
                "n_symbols": F.char_length(t) - _without(t, SYMBOLS),
                "n_dup_lines": F.size(p["l"]) - F.size(F.array_distinct(p["l"])),
                "n_repeat_words": _repeats(p["w"]),
                "n_lines": F.size(p["l"]),
                "n_marks": F.char_length(t) - _without(t, "!"),
                "n_upper": F.char_length(F.regexp_replace(t, r"\P{Lu}+", "")),
                "n_letters": F.char_length(F.regexp_replace(t, r"\P{L}+", "")),
            }.items()]))
    return let(F.coalesce(text, F.lit("")), of_words)


def ledger(df: DataFrame, *keys: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keys``, the measurements, and ``failed``, whose bits are the rules that failed."""
    named = [F.col(f"`{k}`") for k in keys]
    rows = only(df, *keys, text).select(*named, measured(F.col(f"`{text}`")).alias("_m"))
    rows = rows.select(*named, *[F.col(f"_m.{m}").alias(m) for m in MEASURES])
    failed = _failed({m: F.col(m) for m in MEASURES}, rules)
    return rows.withColumn("failed", failed)


def _failed(m: Mapping[str, Column], rules: tuple[Rule, ...]) -> Column:
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.fails(m), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def fails(mask: int) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask).cast("long")) != 0


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with ``policy`` and ``kept``."""
    return rows.withColumns({"policy": F.lit(version), "kept": ~fails(mask_of(POLICIES[version]))})


def ablations(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents failing it, failing it alone, and kept without it."""
    mask = mask_of(POLICIES[version])
    counted = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("failed")).count()
    used = [r for r in RULES if r.name in POLICIES[version]]
    rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                               for r in used]))
    has = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("failed") == F.col("r.bit")
    return (counted.select("failed", "count", rule.alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(has, F.col("count")).otherwise(0)).alias("fail"),
                 F.sum(F.when(alone, F.col("count")).otherwise(0)).alias("fail_alone"),
                 F.sum(F.when((F.col("failed") == 0) | alone, F.col("count")).otherwise(0)).alias("kept_without")))


def keep(df: DataFrame, text: str = "text", version: str = CURRENT) -> DataFrame:
    """The rows of ``df`` that a policy keeps, with their own columns only."""
    rules = tuple(r for r in RULES if r.name in POLICIES[version])
    return df.where(let(measured(F.col(f"`{text}`")), lambda m: _failed(m, rules)) == 0)
