"""Posting company -> filing employer, and what of a posting is already stored.

Prefixes are found by one sorted sweep over asked and stored names
(``prefixes``), containment by automata (``containment``). The work grows with
the text, not with pairs of names or with pieces of them, and what a prefix or
string shared by a third of all employers finds is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openroles.functions.text import (
    let, norm_employer, origin_host, path_parts, strip, text_or_empty, url_host, url_parts,
    without_apply,
)
from openroles.operators.containment import first_containing
from openroles.operators.dedup import first_n
from openroles.operators.prefixes import best_with_prefix
from openroles.session import left_join_known, written_once


def best_by_prefix(employers: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Employer with most approvals, equal ones by name, whose name starts with each of ``names`` (upper case, ``prefix``)."""
    texts = employers.select(F.upper("employer_name").alias("text"), (-F.col("total_approvals")).alias("rank"),
                             F.col("employer_name").alias("name"), "company_id", "approval_rate")
    found = best_with_prefix(texts, names.select(F.col(column).alias("prefix")))
    return found.select("prefix", F.col("name").alias("employer_name"), "company_id",
                        (-F.col("rank")).alias("total_approvals"), "approval_rate")


def best_containing(employers: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Employer with most approvals, equal ones by name, whose name contains each of ``names`` (upper case, ``piece``)."""
    texts = employers.select(F.lit(0).alias("group"), F.upper("employer_name").alias("text"), "employer_name",
                             "company_id", "total_approvals", "approval_rate")
    found = first_containing(texts, names.select(F.lit(0).alias("group"), F.col(column).alias("asked")), [
        ("total_approvals", "descending"), ("employer_name", "ascending"), ("company_id", "ascending")])
    return found.drop("group").withColumnRenamed("asked", "piece")


def resolve_employers(names: DataFrame, companies: DataFrame) -> DataFrame:
    """Employer of each distinct posting company name (``company``).

    Tiers: exact on the upper-case name, exact as spelled, best employer with
    approvals whose name starts with it, else a new company. Blank names have
    no employer. Names that are new and differ only by case share the
    upper-case spelling when it occurs among them.
    """
    asked = names.select("company").distinct().withColumn("name", norm_employer(F.col("company")))
    asked = asked.filter(F.col("name") != "")
    known = companies.select("employer_name", "company_id", "total_approvals", "approval_rate")

    def tier(prefix: str) -> DataFrame:
        return known.select(*[F.col(c).alias(f"{prefix}_{c}") for c in known.columns])

    exact, spelled = tier("x"), tier("s")
    rows = asked.join(exact, F.col("name") == F.col("x_employer_name"), "left").join(
        spelled, F.col("company") == F.col("s_employer_name"), "left")

    sponsors = known.filter(F.col("total_approvals") > 0)
    prefix = best_by_prefix(sponsors, asked).select("prefix", *[F.col(c).alias(f"p_{c}") for c in known.columns])
    rows = rows.join(prefix, F.col("name") == F.col("prefix"), "left")

    tiers = {"exact": "x", "spelled": "s", "prefix": "p"}
    chosen = {c: F.lit(None) for c in (*known.columns, "tier")}
    for label, p in reversed(tiers.items()):
        hit = F.col(f"{p}_employer_name").isNotNull()
        for c in known.columns:
            chosen[c] = F.when(hit, F.col(f"{p}_{c}")).otherwise(chosen[c])
        chosen["tier"] = F.when(hit, F.lit(label)).otherwise(chosen["tier"])

    # New names: the upper-case spelling stands for its other spellings when
    # one of the new names has it.
    spellings = Window.partitionBy("name")
    rows = rows.select("company", "name", *[v.alias(c) for c, v in chosen.items()],
                       F.max(F.col("company") == F.col("name")).over(spellings).alias("has_upper"))
    created = F.when(F.col("has_upper"), F.col("name")).otherwise(F.col("company"))
    is_new = F.col("tier").isNull()
    return rows.select(
        "company",
        F.coalesce("employer_name", created).alias("employer_name"),
        F.when(is_new, F.xxhash64(created)).otherwise(F.col("company_id")).alias("company_id"),
        F.coalesce("total_approvals", F.lit(0)).alias("total_approvals"),
        F.coalesce(F.col("approval_rate"), F.lit(0).cast("decimal(5,2)")).alias("approval_rate"),
        F.coalesce("tier", F.lit("new")).alias("tier"))


def new_companies(resolved: DataFrame) -> DataFrame:
    """Company rows to add for names no tier resolved."""
    return resolved.filter(F.col("tier") == "new").select(
        "company_id", "employer_name", F.lit(0).cast("bigint").alias("total_approvals"),
        F.lit(0).cast("bigint").alias("total_denials")).distinct()


def filter_by_sponsorship(postings: DataFrame, companies: DataFrame,
                          min_rate: float = 70.0) -> DataFrame:
    """Postings whose company name occurs in an employer's with a sufficient rate.

    Of several employers containing the name the one with most approvals
    counts. The rate is a percentage.
    """
    named = postings.withColumn("_name", F.upper(strip(text_or_empty(F.col("company"))))).filter("_name != ''")
    asked = named.select(F.col("_name").alias("name")).distinct()
    best = best_containing(companies, asked).filter(F.col("approval_rate") >= min_rate)
    # The digest in the key gives the small side an exchange of its own behind its
    # aggregate, without which a hot name could not be split when the job runs.
    same = (F.col("_name") == F.col("piece")) & (F.xxhash64("_name") == F.xxhash64("piece"))
    return named.join(best, same).drop("_name", "piece")


def sponsored_only(postings: DataFrame, companies: DataFrame) -> DataFrame:
    """Postings whose company is an employer by exact name."""
    known = companies.select(F.col("employer_name").alias("company"), "company_id",
                             "approval_rate")
    return postings.join(known, "company")


def url_key(url: Column) -> Column:
    """``struct(host, platform, board, id)`` of a job URL.

    The posting id by its platform's rule. ``platform`` is null for hosts
    without a rule.
    """
    return let(url_parts(url), _key_of)


def _key_of(p: Column) -> Column:
    parts = F.struct(
        origin_host(p["origin"]).alias("host"),
        path_parts(without_apply(p["path"])).alias("parts"),
        F.regexp_extract(p["query"], r"(?:^|&)gh_jid=([^&]+)", 1).alias("query_id"),
        F.regexp_extract(p["query"], r"(?:^|&)for=([^&]+)", 1).alias("for"))
    return let(parts, lambda k: let(_platform(k["host"]), lambda platform: _url_key(k, platform)))


def _platform(host: Column) -> Column:
    return (
        F.when(_within(host, "greenhouse.io"), "greenhouse")
        .when(_within(host, "lever.co"), "lever")
        .when(_within(host, "ashbyhq.com"), "ashby")
        .when(_within(host, "smartrecruiters.com"), "smartrecruiters")
        .when(_within(host, "myworkdayjobs.com"), "workday"))


def _within(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith("." + domain)


def _url_key(p: Column, platform: Column) -> Column:
    first, last = F.get(p["parts"], F.lit(0)), F.get(p["parts"], F.size(p["parts"]) - 1)
    job_id = (
        F.when(platform == "smartrecruiters", F.substring_index(last, "-", 1))
        .when(platform == "workday", F.substring_index(last, "_", -1))
        .when((platform == "greenhouse") & (p["query_id"] != ""), p["query_id"])
        .otherwise(last))
    board = (F.when(platform == "workday", F.substring_index(p["host"], ".", 1))
             .when((platform == "greenhouse") & (first == "embed") & (p["for"] != ""), p["for"]).otherwise(first))
    return F.struct(p["host"].alias("host"), platform.alias("platform"),
                    F.lower(board).alias("board"), job_id.alias("id"))


def _rule_key(key: Column, job_id: Column) -> Column:
    """Platform, board and id: ids are unique within a board, not within a platform."""
    return F.when(key["platform"].isNotNull() & (text_or_empty(job_id) != ""),
                  F.concat_ws(":", F.lit("id"), key["platform"], text_or_empty(key["board"]), job_id))


def jobs_to_insert(incoming: DataFrame, stored: DataFrame, order: list) -> DataFrame:
    """Incoming postings not stored yet, one per URL hash, by anti-joins.

    First on the hash of the canonical URL, then on the posting id: equality on
    platform, board and id where the stored URL's host has a rule, and for other hosts
    the id as part of a stored URL of the same host.

    Rows a join cannot match (no id, or a host of the other kind) get a key of
    their own there, so they spread evenly instead of meeting under one key.
    URLs are taken apart once per stored row and once per fresh one, and kept so.
    """
    url, job_id = F.col("job_url"), text_or_empty(F.col("source_job_id"))

    # Of hosts without a rule, what stands behind the host is searched for the
    # incoming ids of the same host; other hosts' URLs are not sent at all.
    def known_by(p: Column) -> Column:
        return let(_key_of(p), lambda k: F.struct(
            _rule_key(k, k["id"]).alias("rule"), F.when(k["platform"].isNull(), k["host"]).alias("host"),
            F.when(k["platform"].isNull(), F.substr(strip(url), F.length(p["origin"]) + 1)).alias("rest")))

    known = written_once(stored.select("url_hash", let(url_parts(url), known_by).alias("keys")), "stored-keys")
    keys = let(url_key(url), lambda k: F.struct(
        _rule_key(k, job_id).alias("rule"), k["host"].alias("host"),
        F.when(k["platform"].isNull() & (job_id != ""), job_id).alias("piece")))
    fresh = first_n(incoming, ["url_hash"], order).join(known.select("url_hash"), "url_hash", "left_anti")
    fresh = written_once(fresh.withColumn("_keys", keys), "fresh-postings")

    by_rule = known.select(F.col("keys.rule").alias("_rule_key")).where("_rule_key is not null").distinct()
    asked = fresh.select(F.col("_keys.host").alias("group"), F.col("_keys.piece").alias("asked"))
    others = known.select(F.col("keys.host").alias("group"), F.col("keys.rest").alias("text"))
    held = first_containing(others.where("group is not null"), asked.where("asked is not null")).select(
        F.col("group").alias("_host"), F.col("asked").alias("_piece"))

    own = F.concat(F.lit("none:"), "url_hash")
    fresh = fresh.withColumns({
        "_rule_key": F.coalesce(F.col("_keys.rule"), own), "_host": F.col("_keys.host"),
        "_piece": F.coalesce(F.col("_keys.piece"), own)}).drop("_keys")
    return fresh.join(by_rule, "_rule_key", "left_anti").join(
        held, ["_host", "_piece"], "left_anti").drop("_rule_key", "_host", "_piece")


def job_rows(postings: DataFrame, resolved: DataFrame) -> DataFrame:
    """Rows of the stored job table (``schemas.JOBS``) for new postings, linked to their resolved employer.

    Postings name no salary. Those without a company name have no employer and
    stay out of the join.
    """
    company = F.col("company")
    links = resolved.select(company.alias("_company"), "company_id")
    named = postings.withColumn("_company", F.when(strip(company) != "", company))
    return left_join_known(named, links, "_company").select(
        F.xxhash64("job_url").alias("id"), "company_id", "title",
        text_or_empty(F.col("description")).alias("description"),
        text_or_empty(F.col("location")).alias("location"),
        F.lit(None).cast("int").alias("salary_min"), F.lit(None).cast("int").alias("salary_max"),
        "job_url", "url_hash", F.coalesce("source", F.lit("google_search")).alias("source"), "posted_date",
        "scraped_at", F.lit(True).alias("is_active"))
