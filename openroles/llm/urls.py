"""URL filter: domain rules first, else logistic regression on hashed character n-grams.

Host and path of a URL are cut into character n-grams of three to five
characters (with marks at both ends), each side with its own hash seed, and
hashed into a fixed number of weights. The regression is fitted on the driver
from a labelled URL table of at most ``MOST_LABELLED`` rows, scored on all rows.

Rules are (host, path) pairs. A rule fits its host and all subdomains if the
path of the URL starts with the rule's path; the longest fitting rule wins.

Defined cases: a null URL or one without ``://`` has an empty host and path and
is scored on these. Repeated rows stay repeated.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles.functions.text import let
from openroles.llm.common import only

#: Labelled rows that a fit reads at most, and weights of a model.
MOST_LABELLED = 20_000
WEIGHTS = 1 << 15
ROUNDS, RATE, DECAY = 300, 2.0, 1e-4

#: The small labelled table that a fit uses if none is given: parts of host names and paths.
BLOCKED_HOSTS = ("cheap-pills", "pills-online", "discount-pharmacy", "free-bets", "best-casino",
                 "casino-bonus", "online-slots", "poker-win", "spam-farm", "link-farm", "seo-links",
                 "ads-track", "adserver", "click-track", "banner-ads", "track-pixel", "adult-cams",
                 "xxx-videos", "porn-tube", "free-porn", "crack-keygen", "warez-download",
                 "payday-loans", "fast-cash-loan", "fake-watches", "replica-bags", "miracle-diet")
ALLOWED_HOSTS = ("blog.garden", "www.museum", "news.harbor", "library", "m.weather", "therapy",
                 "docs.python", "www.city-hall", "university", "recipes.kitchen", "history",
                 "blog.travel", "science", "m.theater", "www.orchestra", "thesis", "nature",
                 "support.printer", "www.hospital", "maps", "journal", "mountain", "blog.author",
                 "education", "water", "m.station", "www.other")
#: Frequent pairs of letters, from which neutral host names are made.
PAIRS = ("th", "he", "in", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is", "it",
         "al", "ar", "st", "to", "nt", "ng", "se", "ha", "as", "ou", "io", "le", "ve", "co", "me", "de", "hi", "ri")
NEUTRAL_HOSTS = 150
BLOCKED_PATHS = ("/buy-now/cheap", "/casino/bonus", "/click?aff=1", "/ads/banner", "/xxx/free")
ALLOWED_PATHS = ("/en/120/", "/de/archive/12", "/article/2021/05", "/fr/88.html", "/es/410", "/about")
ZONES = ("example.com", "example.org", "example.net")


def small_labelled_table() -> list[tuple[str, int]]:
    """(url, 1 for block) rows made from the lists above."""
    rows = []
    for blocked, hosts, paths in ((1, BLOCKED_HOSTS, BLOCKED_PATHS), (0, ALLOWED_HOSTS, ALLOWED_PATHS)):
        for i, host in enumerate(hosts):
            for k, zone in enumerate(ZONES):
                front = ("", "www.", "m.")[(i + k) % 3] if blocked else ""
                neutral = ALLOWED_PATHS[(i + k) % len(ALLOWED_PATHS)]
                rows.append((f"https://{front}{host}.{zone}{neutral}", blocked))
            rows.append((f"http://{host}.org{paths[i % len(paths)]}", blocked))
    for i in range(NEUTRAL_HOSTS):
        name = "".join(PAIRS[(i * step + i // 36) % len(PAIRS)] for step in (1, 5, 7, 11)[:2 + i % 3])
        front = ("", "www.", "m.", "blog.")[i % 4]
        rows.append((f"https://{front}{name}.{ZONES[i % 3]}{ALLOWED_PATHS[i % len(ALLOWED_PATHS)]}", 0))
    return rows


def with_parts(df: DataFrame, url: Column, host: str, path: str) -> DataFrame:
    """``df`` with the host, in which A-Z is lower-cased, and the path of ``url``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    lower = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                        "abcdefghijklmnopqrstuvwxyz")
    return df.withColumns({host: lower, path: F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)})


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule of (host, path, verdict) as a struct, or null."""
    chain = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        chain = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(chain)
    return chain


def features(host: str, path: str) -> np.ndarray:
    """Places of the distinct n-grams of both sides among the weights."""
    from zlib import crc32

    found = set()
    for seed, part in ((1, f"^{host}$".encode()), (2, f"^{path}$".encode())):
        for n in (3, 4, 5):
            found.update(crc32(part[i:i + n], seed) % WEIGHTS for i in range(len(part) - n + 1))
    return np.fromiter(found, np.int64, len(found))


def fit(labelled: DataFrame, url: str = "url", blocked: str = "blocked") -> np.ndarray:
    """Weights, the last of them the intercept, from at most MOST_LABELLED labelled rows.

    Rows without a label are left out. With no rows, or rows of one kind only,
    the model says allow, or that kind, everywhere.
    """
    parts = with_parts(only(labelled, url, blocked).toDF("u", "y"), F.col("u"), "h", "p")
    rows = (parts.where("y is not null").select("h", "p", F.col("y").cast("int").alias("y"))
            .orderBy(F.xxhash64("h", "p"), "h", "p", "y").limit(MOST_LABELLED).collect())
    weights = np.zeros(WEIGHTS + 1)
    y = np.array([r.y for r in rows], float)
    if len(rows) == 0 or y.min() == y.max():
        weights[-1] = -1.0 if len(rows) == 0 or y[0] == 0 else 1.0
        return weights
    grams = [features(r.h, r.p) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
    column = np.concatenate(grams)
    value = 1 / np.sqrt(np.array([max(1, len(g)) for g in grams]))[row]
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(ROUNDS):
        z = np.bincount(row, weights[column] * value, len(rows)) + weights[-1]
        slope = share * (1 / (1 + np.exp(-z)) - y)
        weights[:-1] -= RATE * (np.bincount(column, slope[row] * value, WEIGHTS) * 10 + DECAY * weights[:-1])
        weights[-1] -= RATE * slope.sum()
    return weights


def score(host: Column, path: Column, weights: np.ndarray) -> Column:
    """Probability that a URL is to be blocked."""
    shared = weights.astype(np.float32)

    @F.pandas_udf("double")
    def probability(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(hosts, paths):
            if pair not in known:
                f = features(*pair)
                z = shared[f].sum() / max(1, len(f)) ** 0.5 + shared[-1]
                known[pair] = float(1 / (1 + np.exp(-z)))
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return probability(host, path)


def judge(df: DataFrame, rules: Sequence[tuple[str, str, str]], weights: np.ndarray, url: str = "url",
          keys: Sequence[str] = ("page_id",), threshold: float = 0.5) -> DataFrame:
    """``keys``, host, path, the rule that decided (else null), score and verdict of every URL."""
    parts = with_parts(df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{url}`").alias("_url")),
                       F.col("_url"), "host", "path")
    ruled = parts.withColumns({"_rule": let(F.col("host"), lambda h: rule_for(h, F.col("path"), rules)),
                               "score": score(F.col("host"), F.col("path"), weights)})
    by_score = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return ruled.select(*[F.col(f"`{k}`") for k in keys], "host", "path",
                        F.col("_rule.rule").alias("rule"),
                        F.coalesce("_rule.verdict", by_score).alias("verdict"), "score")
