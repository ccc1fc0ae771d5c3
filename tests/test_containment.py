"""Containment by automata against brute force, in one cell and in many."""

import random

import pytest
from pyspark.sql import functions as F

from openroles.operators import containment, employers


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    texts = [(rng.choice(["a.com", "b.org", "hot.net", "hot.net", None, "unasked.io"]),
              "".join(rng.choice("ab-/1é") for _ in range(rng.randint(0, 14))), rng.randint(0, 9)) for _ in range(300)]
    asked = [(rng.choice(["a.com", "b.org", "hot.net", "none.com", None]),
              "".join(rng.choice("ab-/1é") for _ in range(rng.randint(0, 4)))) for _ in range(120)]
    return list(dict.fromkeys(texts)), asked + asked[:40] + [("hot.net", None)]


@pytest.mark.parametrize("limits", [(1 << 20, 16 << 20), (40, 200)])
def test_first_containing_equals_brute_force(spark, rows, monkeypatch, limits):
    monkeypatch.setattr(containment, "STRING_BYTES", limits[0])
    monkeypatch.setattr(containment, "TEXT_BYTES", limits[1])
    texts, asked = rows
    got = containment.first_containing(
        spark.createDataFrame([(g, t, t, n) for g, t, n in texts], "group string, text string, name string, n int"),
        spark.createDataFrame(asked, "group string, asked string"), [("n", "descending"), ("name", "ascending")])
    want = {}
    for g, a in asked:
        hits = [(-n, t) for h, t, n in texts if g is not None and g == h and a and a in t]
        if hits:
            want[g, a] = (min(hits)[1], -min(hits)[0])
    assert {(r.group, r.asked): (r.name, r.n) for r in got.collect()} == want and len(want) > 30
    assert got.count() == len(want)


def test_without_payload_each_string_comes_once(spark, rows, monkeypatch):
    monkeypatch.setattr(containment, "TEXT_BYTES", 100)
    texts, asked = rows
    got = containment.first_containing(spark.createDataFrame([t[:2] for t in texts], "group string, text string"),
                                       spark.createDataFrame(asked, "group string, asked string"))
    want = {(g, a) for g, a in asked for h, t, _ in texts if g is not None and g == h and a and a in t}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty_sides(spark):
    none = spark.createDataFrame([], "group string, text string")
    some = spark.createDataFrame([("g", "x")], "group string, asked string")
    assert containment.first_containing(none, some).isEmpty()
    assert containment.first_containing(some.toDF("group", "text"), some.limit(0)).isEmpty()


def test_ids_with_separators_are_found_in_urls_of_their_host(spark):
    """No substrings are made of the stored URLs; ids may begin and end inside a word of one."""
    stored = spark.createDataFrame([(f"s{i}", u) for i, u in enumerate([
        "https://careers.x.com/o?ref=job-12/3_b&y", "https://careers.x.com/req/AB-77-Z9", "https://other.y.com/AB-77"])],
        "url_hash string, job_url string")
    ids = ["job-12/3_b", "12/3", "B-77-Z", "AB-77-Z9", "77-z", "ref=job", "3_bb", "x.com", "req/AB-77-Z99"]
    frame = spark.createDataFrame([(f"h{i}", f"https://careers.x.com/new/{i}", x, i) for i, x in enumerate(ids)],
                                  "url_hash string, job_url string, source_job_id string, ord int")
    left = employers.jobs_to_insert(frame, stored, [F.col("ord")])
    assert sorted(r.source_job_id for r in left.collect()) == sorted(["77-z", "3_bb", "x.com", "req/AB-77-Z99"])
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(1, (length" not in plan and "FlatMapCoGroups" in plan


def test_texts_of_a_large_group_meet_few_of_its_strings(spark, monkeypatch):
    """Twenty times the strings are twenty times the buckets, but a text goes to those it may find something in."""
    monkeypatch.setattr(containment, "STRING_BYTES", 500)
    texts = spark.range(200).selectExpr("'h' as group", "concat('/o?ref=', 1000000 + id * 7, '&x=1') as text")
    copies = {}
    for n in (300, 6000):
        asked = spark.range(n).selectExpr("'h' as group", "cast(1000000 + id as string) as asked")
        dealt, strings = containment._dealt(texts, asked)
        copies[n] = dealt.count()
        assert strings.count() == n and strings.select("bucket").distinct().count() > n // 100
        found = {r.asked for r in containment.first_containing(texts, asked).collect()}
        assert found == {str(1000000 + i * 7) for i in range(200) if i * 7 < n}
    # 18 characters at most, thus 15 runs of four.
    assert copies[300] <= copies[6000] <= 200 * 15
