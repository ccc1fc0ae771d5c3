"""The sorted prefix sweep against brute force, in one range and in many."""

import random

import pytest
from pyspark.sql import functions as F

from openroles.operators.prefixes import best_with_prefix

TEXTS = "text string, rank long, name string, id long"


def brute(texts, asked):
    out = {}
    for p in {a for a in asked if a}:
        hits = [(rank, name, i) for t, rank, name, i in texts if t and t.startswith(p)]
        if hits:
            out[p] = min(hits)
    return out


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_sweep_equals_brute_force(spark, ranges):
    rng = random.Random(ranges)
    made = ["".join(rng.choice("AB é") for _ in range(rng.randint(0, 7))) for _ in range(400)]
    texts = [(t, rng.randint(-5, 5), f"{t}-{i}", i) for i, t in enumerate(made)] + [(None, 1, "x", 1)]
    # A third of all texts share one prefix, many of them a whole name.
    texts += [("HOT" + rng.choice(["", "", "EL", "EL A"]), rng.randint(0, 9), f"h{i}", 1000 + i) for i in range(200)]
    asked = made[:150] + ["".join(rng.choice("AB é") for _ in range(rng.randint(0, 3))) for _ in range(60)]
    asked += ["H", "HOT", "HOTEL", "HOTEL A", "HOTELS", "Z", "", None, "日本"]
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = best_with_prefix(spark.createDataFrame(texts, TEXTS), spark.createDataFrame([(a,) for a in asked], "prefix string"))
        assert {r.prefix: (r["rank"], r.name, r.id) for r in got.collect()} == brute(texts, asked)
        assert got.count() == len(brute(texts, asked))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_shared_prefix_is_one_row_per_range(spark):
    """No text is expanded to its prefixes, and ranges of a hot prefix are read by several tasks."""
    texts = spark.range(5000).select(F.concat(F.lit("HOT "), "id").alias("text"), F.col("id").alias("rank"),
                                     F.col("id").cast("string").alias("name"), "id")
    asked = spark.createDataFrame([("HOT",), ("HOT 49",), ("NONE",)], "prefix string")
    got = best_with_prefix(texts, asked)
    assert {r.prefix: r.id for r in got.collect()} == {"HOT": 0, "HOT 49": 49}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "RepartitionByExpression" in plan


def test_empty_sides(spark):
    none = spark.createDataFrame([], TEXTS)
    one = spark.createDataFrame([("a",)], "prefix string")
    assert best_with_prefix(none, one).isEmpty()
    assert best_with_prefix(spark.createDataFrame([("ab", 1, "n", 1)], TEXTS), one.limit(0)).isEmpty()
