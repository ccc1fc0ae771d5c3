"""The data source of landed files: broken lines, ranges, folders."""

import json
import os

import pytest

from openroles.sources import landed


def put(folder, platform, name, lines):
    os.makedirs(f"{folder}/platform={platform}", exist_ok=True)
    with open(f"{folder}/platform={platform}/{name}", "wb") as f:
        f.write(b"\n".join(lines) + b"\n")


def page(n, **more):
    return json.dumps({"identifier": f"b{n}", "page_no": n, "scraped_at": "2026-08-01T02:00:00+02:00", "payload": "x" * (n % 40),
                       **more}).encode()


def test_broken_lines_are_rows_and_cost_nothing_else(spark, tmp_path):
    put(tmp_path, "lever", "a.json", [page(1), b"{\"identifier\": \"cut", b"", b"[1]", b"\xff\xfe", page(2, scraped_at="soon"),
                                      page(3, page_no="many"), page(4, other=1, payload=None)])
    put(tmp_path, "lever", "_SUCCESS", [b"no data"])
    rows = landed.read_files(spark, str(tmp_path))
    assert [(r.platform, r.identifier, r.payload) for r in landed.documents(rows).orderBy("identifier").collect()] == [
        ("lever", "b1", "x"), ("lever", "b4", None)]
    assert landed.documents(rows).filter("scraped_at = timestamp'2026-08-01 00:00:00'").count() == 2
    bad = landed.file_errors(rows).collect()
    assert len(bad) == 5 and all(r.platform == "lever" and r.file.endswith("a.json") and "line at byte" in r.error for r in bad)


@pytest.mark.parametrize("size", [1, 50, 97, 1000, 1 << 20])
def test_ranges_own_each_line_once(spark, tmp_path, size):
    lines = [page(n) for n in range(60)]
    put(tmp_path, "ashby", "a.json", lines[:59])
    put(tmp_path, "ashby", "b.json", lines[59:])
    landed.register(spark)
    reader = landed.LandedReader(str(tmp_path), [("identifier", "string")], size, None)
    got = [r["identifier"] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(got) == sorted(f"b{n}" for n in range(60))


def test_only_folders_of_asked_platforms_are_opened(spark, tmp_path):
    put(tmp_path, "lever", "a.json", [page(1)])
    put(tmp_path, "ashby", "a.json", [page(2)])
    put(tmp_path, "workday", "a.json", [page(3)])
    fields = [("platform", "string"), ("identifier", "string")]
    reader = landed.LandedReader(str(tmp_path), fields, 100, {"ashby", "workday"})
    assert sorted(p.value[0] for p in reader.partitions()) == ["ashby", "workday"]
    both = landed.read_files(spark, str(tmp_path), platforms=["ashby", "workday"])
    assert sorted(r.identifier for r in both.collect()) == ["b2", "b3"]
    every = landed.read_files(spark, str(tmp_path))
    # One relation under different filters: each has its own rows.
    two = every.filter("platform = 'lever'").unionByName(every.filter("platform = 'ashby'"))
    assert sorted(r.identifier for r in two.collect()) == ["b1", "b2"]
    assert landed.read_files(spark, str(tmp_path), "details", ["none"]).isEmpty()


def test_details_have_their_own_fields(spark, tmp_path):
    put(tmp_path, "workday", "a.json", [json.dumps({"identifier": "b", "detail_key": "/job/1", "payload": "{}"}).encode()])
    row, = landed.documents(landed.read_files(spark, str(tmp_path), "details")).collect()
    assert (row.platform, row.identifier, row.detail_key, row.payload) == ("workday", "b", "/job/1", "{}")


def test_totals_observed_while_writing(spark):
    from openroles.operators import matching, observed, rollup

    companies = spark.createDataFrame([("A", 3), ("B", 2), ("C", None)], "employer_name string, total_approvals bigint")
    stored, totals = observed.write_companies(companies)
    assert stored.count() == 3 and totals == {"companies": 3, "quality_companies": 1}
    assert rollup.etl_summary(companies).first().asDict() == totals
    assert observed.write_companies(companies.limit(0))[1] == {"companies": 0, "quality_companies": 0}
    jobs = spark.createDataFrame([(1, "Engineer", "Berlin", "", True), (2, "Engineer", "Austin, TX", "", True),
                                  (3, "Engineer", "Austin, TX", "We do not sponsor visas.", True)],
                                 "job_id long, title string, location string, description string, is_active boolean")
    hits = spark.createDataFrame([(7, i, 0.5, i) for i in (1, 2, 3)] + [(8, 2, 0.4, 1)],
                                 "resume_id long, job_id long, similarity double, rank int")
    checked = matching.hit_jobs(hits, jobs)
    kept, counts = observed.write_kept(checked)
    assert {tuple(r) for r in matching.hit_funnel(checked).collect()} == set(counts) and len(counts) >= 2
    assert kept.count() == dict((s, n) for s, _, n in counts)["kept"]
