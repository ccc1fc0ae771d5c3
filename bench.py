"""Times the headline queries; prints one JSON line.

The given tables are single files that make one to four tasks. Before the timing
they are written once in as many files as there are cores, as tables of a cluster
are; ``queries`` are the times over that layout, ``given`` those over the tables
as given. Each query runs once to warm up and then three times; its figure is the
median. ``given`` is one run. Results go to Spark's no-op sink, so whole results
are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from openroles import build_session  # noqa: E402
from openroles.catalog.registry import spark_queries  # noqa: E402
from openroles.catalog.views import TABLES  # noqa: E402

HEADLINE = (
    "company_rollup", "sponsorship_companies", "companies_upsert", "cosine_topk", "similar_jobs",
    "diverse_jobs", "dedup_postings", "resolve_employer", "filter_by_sponsorship", "jobs_insert_new",
    "location_verdict", "auth_class_documents", "normalize_posting", "feed_greenhouse",
    "page_postings", "targets_discovered", "parse_score_json", "digest_html",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    queries = spark_queries()

    laid_out = tempfile.mkdtemp(prefix="bench-")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{laid_out}/{table}.parquet")

    def run(name: str, folder: str = laid_out) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times, given = {}, {}
    for name in HEADLINE:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(3)), 3)
        given[name] = round(run(name, sf_dir), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "given": given, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
