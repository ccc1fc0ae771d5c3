"""Prompts for the relevance model and the parsing of what it answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.functions.text import let, one_decimal, strip, text_or_empty

INTEGER_TEXT = r"^[+\-]?\d+(?:_\d+)*$"


def score_prompt(title: Column, company: Column, description: Column, resume: Column,
                 description_chars: int = fixed.PROMPT_CHARS,
                 resume_chars: int = fixed.PROMPT_CHARS) -> Column:
    """User prompt. Cutting both texts is part of the prompt's contract."""
    return F.format_string(
        fixed.SCORE_PROMPT_TEMPLATE, text_or_empty(title), text_or_empty(company),
        F.substring(text_or_empty(description), 1, description_chars),
        F.substring(text_or_empty(resume), 1, resume_chars),
    )


def score_messages(prompt: Column) -> Column:
    """What a chat provider is sent: the system prompt, then the user prompt."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(fixed.SCORE_SYSTEM_PROMPT)), message("user", prompt))


def score_lines_prompt(title: Column, company: Column, description: Column, resume: Column) -> Column:
    """The prompt for a local model; its answer is read by :func:`parse_score_lines`. It cuts both texts."""
    return F.format_string(
        fixed.SCORE_LINES_TEMPLATE, F.substring(text_or_empty(resume), 1, fixed.PROMPT_CHARS), text_or_empty(title),
        text_or_empty(company), F.substring(text_or_empty(description), 1, fixed.PROMPT_LINES_DESCRIPTION_CHARS))


def _integer(text: Column) -> Column:
    """Integer of a text such as `` 85``, ``+85`` or ``8_5``; null for anything else."""
    text = strip(text)
    return F.when(text.rlike(INTEGER_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("long"))


def parse_score_json(response: Column, provider_error: Column | None = None,
                     joined: Column | None = None) -> Column:
    """``struct(success, score, reasoning, key_matches, error, out_of_range)``.

    A response that does not parse is a failure with a null score, never a zero.
    ``joined``: see :func:`openroles.functions.text.let`.
    """
    error = provider_error if provider_error is not None else F.lit(None).cast("string")
    found = F.regexp_extract(response, "(?s)" + fixed.SCORE_OBJECT, 0)
    fields = [found.alias("found"), response.alias("response"), error.alias("error")]

    def parse(t: Column) -> Column:
        doc = F.try_parse_json(F.when(t["found"] != "", t["found"]).otherwise(strip(t["response"])))
        return let(doc, lambda d: let(_score_fields(d), lambda f: let(
            f["is_object"] & f["score"].isNotNull() & t["error"].isNull(),
            lambda ok: _score_result(f, F.coalesce(ok, F.lit(False)), t["error"]))))

    return let(F.struct(*fields), parse, joined)


def _score_fields(doc: Column) -> Column:
    raw = F.try_variant_get(doc, "$.score", "variant")
    # A document that is no object has no "$.score", so its raw score is null.
    return let(F.struct(F.schema_of_variant(doc).alias("kind"), raw.alias("raw"),
                        F.schema_of_variant(raw).alias("score_kind")), lambda t: F.struct(
        t["kind"].startswith("OBJECT").alias("is_object"),
        _score_value(doc, t["raw"], t["score_kind"]).alias("score"),
        text_or_empty(F.try_variant_get(doc, "$.reasoning", "string")).alias("reasoning"),
        F.try_variant_get(doc, "$.key_matches", "array<string>").alias("key_matches")))


def _score_value(doc: Column, raw: Column, kind: Column) -> Column:
    as_text = F.try_variant_get(doc, "$.score", "string")
    return (
        F.when(raw.isNull(), F.lit(0).cast("long"))
        .when(kind == "BIGINT", F.try_variant_get(doc, "$.score", "long"))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"),
              F.try_variant_get(doc, "$.score", "double").try_cast("long"))
        .when(kind == "BOOLEAN", F.when(as_text == "true", 1).otherwise(0).cast("long"))
        .when(kind == "STRING", _integer(as_text)))


def _score_result(fields: Column, success: Column, error: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.struct(
        success.alias("success"),
        F.when(success, fields["score"]).alias("score"),
        F.when(success, fields["reasoning"]).otherwise("").alias("reasoning"),
        F.when(success, F.coalesce(fields["key_matches"], none)).otherwise(none)
        .alias("key_matches"),
        F.when(~success, F.coalesce(error, F.lit("response is not a score object")))
        .alias("error"),
        F.coalesce(success & ~fields["score"].between(0, 100), F.lit(False))
        .alias("out_of_range"))


def parse_score_lines(output: Column) -> Column:
    """``struct(score, reasoning)`` of ``SCORE:`` / ``REASONING:`` lines, score in 0..100.

    Lines are taken in order; a score that is no integer ends the reading and
    the first 200 characters of the output become the reasoning.
    """
    text = strip(text_or_empty(output))
    start = F.struct(F.lit(0).cast("long").alias("score"), F.lit("").alias("reasoning"),
                     F.lit(False).alias("failed"))

    def after(line: Column, tag: str) -> Column:
        return strip(F.replace(line, F.lit(tag), F.lit("")))

    def step(state: Column, line: Column) -> Column:
        number = _integer(after(line, "SCORE:"))
        is_score = line.startswith("SCORE:")
        is_reason = ~is_score & line.startswith("REASONING:")
        bad = is_score & number.isNull()
        return F.when(state["failed"], state).otherwise(F.struct(
            F.when(is_score & ~bad, number).otherwise(state["score"]).alias("score"),
            F.when(is_reason, after(line, "REASONING:")).otherwise(state["reasoning"])
            .alias("reasoning"),
            bad.alias("failed"),
        ))

    state = F.aggregate(F.split(text, "\n"), start, step)
    return F.struct(
        F.least(F.greatest(state["score"], F.lit(0)), F.lit(100)).cast("long").alias("score"),
        F.when(state["failed"], F.substring(text, 1, 200)).otherwise(state["reasoning"])
        .alias("reasoning"),
    )


def retry_wait(error: Column, retry_after: Column, attempt: Column,
               retry_delay: float = 1.0) -> Column:
    """Seconds to wait before the next attempt; a provider's hint may lengthen it."""
    backoff = F.lit(retry_delay) * (attempt + 1)

    def hinted(seconds: Column) -> Column:
        return F.least(F.lit(60.0), F.greatest(backoff, seconds + 0.5))

    header = F.when(strip(retry_after).rlike(r"^[+\-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+\-]?\d+)?$"),
                    strip(retry_after).try_cast("double"))
    pattern = "(?iuU)" + fixed.RETRY_HINT
    amount = F.regexp_extract(error, pattern, 1).try_cast("double")
    seconds = F.when(F.lower(F.regexp_extract(error, pattern, 2)) == "ms",
                     amount / 1000).otherwise(amount)
    return (
        F.when(header.isNotNull(), hinted(header))
        .when(seconds.isNotNull(), hinted(seconds))
        .otherwise(backoff)
    )


def sponsorship_signal(status: Column, approvals: Column, rate: Column) -> Column:
    """What the posting says first, what the filing history says second."""
    approvals = F.coalesce(approvals, F.lit(0)).cast("long")
    shown = one_decimal(F.coalesce(rate.cast("double"), F.lit(0.0)))
    explicit = status == "explicit_sponsorship"
    return (
        F.when(explicit & (approvals != 0),
               F.format_string(fixed.SIGNAL_EXPLICIT_HISTORY, approvals, shown))
        .when(explicit, F.lit(fixed.SIGNAL_EXPLICIT_ONLY))
        .when(approvals != 0, F.format_string(fixed.SIGNAL_HISTORY, approvals, shown))
        .otherwise(F.lit(fixed.SIGNAL_NONE))
    )
