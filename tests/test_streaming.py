from datetime import datetime

from pyspark.sql import functions as F

from openroles.streaming import incremental as inc

POSTING = ("source string, source_board string, source_job_id string, job_url string, "
           "scraped_at timestamp")


def land(spark, path, schema, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{i}")


def stream(spark, path, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{path}/*"))


def test_dedup_across_batches(spark, tmp_path):
    at = datetime(2026, 8, 1)
    first = ("lever_feed", "acme", "1", "https://jobs.lever.co/acme/1", at)
    again = ("lever_feed", "ACME", "1", "https://jobs.lever.co/acme/1/apply", datetime(2026, 8, 5))
    searched = ("google_search", "", "", "https://jobs.lever.co/acme/2?x=1", at)
    copy = ("google_search", "", "", "https://jobs.lever.co/acme/2", datetime(2026, 8, 6))
    land(spark, tmp_path / "in", POSTING, [first, searched], [again, copy])
    inc.run_to_parquet(inc.dedup_stream(stream(spark, tmp_path / "in", POSTING)),
                       str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_late_rows_of_a_backfill_are_kept_and_marked(spark, tmp_path):
    old, new = datetime(2026, 6, 1), datetime(2026, 8, 1)
    written = inc.Snapshots(spark, str(tmp_path / "out"))
    batches = [[("lever_feed", "acme", "1", "https://jobs.lever.co/acme/1", new)],
               [("lever_feed", "acme", "2", "https://jobs.lever.co/acme/2", new), ("lever_feed", "ACME", "1", "u", old)],
               [("lever_feed", "acme", "3", "https://jobs.lever.co/acme/3", old)] * 2
               + [("lever_feed", "acme", "4", "https://jobs.lever.co/acme/4", None)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, POSTING).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        for _ in range(2):  # the second run finds nothing new
            inc.dedup_with_late_rows(stream(spark, tmp_path / "in", POSTING), written,
                                     str(tmp_path / "state")).awaitTermination()
    got = sorted((r.source_job_id, r.late) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("1", False), ("2", False), ("3", True), ("4", False)]


def test_a_batch_does_not_read_what_earlier_ones_wrote(spark, tmp_path):
    """The state store alone knows the identities: the output may have been moved away."""
    at = datetime(2026, 8, 1)
    written = inc.Snapshots(spark, str(tmp_path / "out"))

    def run(number, *ids):
        spark.createDataFrame([("lever_feed", "acme", i, f"https://jobs.lever.co/acme/{i}", at) for i in ids],
                              POSTING).coalesce(1).write.parquet(f"{tmp_path}/in/{number}")
        inc.dedup_with_late_rows(stream(spark, tmp_path / "in", POSTING), written, str(tmp_path / "state")).awaitTermination()
        return sorted(r.source_job_id for r in written.read(written.latest()).collect())

    assert run(0, "1", "2", "2") == ["1", "2"]
    (tmp_path / "out" / "v=0").rename(tmp_path / "archived")
    assert run(1, "2", "3") == ["3"]
    assert run(2, "3", "1") == [] and written.latest() == 2


def test_a_repeated_batch_takes_the_same_rows(spark, tmp_path):
    """The batch's commit is lost, as after a failure; copies of an identity differ in all but the key."""
    rows = [("lever_feed", "acme", str(i % 20), f"u{i}", datetime(2026, 8, 1 + i % 3)) for i in range(200)]
    for part in range(4):
        spark.createDataFrame(rows[part::4], POSTING).repartition(3).write.parquet(f"{tmp_path}/in/{part}")
    source = spark.readStream.schema(POSTING).parquet(f"{tmp_path}/in/*")
    written = inc.Snapshots(spark, str(tmp_path / "out"))
    found = []
    for _ in range(2):
        inc.dedup_with_late_rows(source, written, str(tmp_path / "state")).awaitTermination()
        found.append(sorted(tuple(r) for r in written.read(0).collect()))
        for name in ("0", ".0.crc"):
            (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    assert found[0] == found[1] and len(found[0]) == 20
    best = {}
    for r in rows:
        best[r[2]] = min(best.get(r[2], (r[4], r[3])), (r[4], r[3]))
    assert {r[2]: (r[4], r[3]) for r in found[0]} == best


def test_company_stream_is_incremental_and_repeatable(spark, tmp_path):
    schema = "ord bigint, employer_name string, total_approvals bigint, total_denials bigint"
    land(spark, tmp_path / "in", schema, [(1, "A", 1, 1), (2, "A", 3, 1)], [(3, "B", 5, 0)])
    stored = inc.KeyedTable(spark, str(tmp_path / "table"), "employer_name", 4)
    table = spark.createDataFrame([("A", 9, 9, None, "keep"), ("C", 1, 0, None, "keep")],
                                  "employer_name string, total_approvals bigint, total_denials bigint, "
                                  "approval_rate decimal(5,2), note string")
    stored.start(table)
    for _ in range(2):  # the second run finds nothing new
        inc.upsert_companies_stream(stream(spark, tmp_path / "in", schema), stored,
                                    str(tmp_path / "state")).awaitTermination()
    rows = {r.employer_name: r for r in stored.read(stored.latest()).collect()}
    assert set(rows) == {"A", "B", "C"} and rows["C"].total_approvals == 1
    # Files may arrive in either order; within a batch the last row wins.
    assert (rows["A"].total_approvals, float(rows["A"].approval_rate), rows["A"].note) == (3, 75.0, "keep")
    assert stored.latest() == 1


def test_an_older_row_in_another_batch_changes_nothing(spark, tmp_path):
    """Files are taken in either order; the row with the larger ``ord`` stays."""
    schema = "ord bigint, employer_name string, total_approvals bigint, total_denials bigint"
    land(spark, tmp_path / "in", schema, [(5, "A", 3, 1), (2, "B", 1, 1)], [(2, "A", 9, 9), (5, "B", 4, 0)])
    stored = inc.KeyedTable(spark, str(tmp_path / "table"), "employer_name", 4)
    stored.start(spark.createDataFrame([("A", 0, 0, None), ("B", 0, 0, None)], (
        "employer_name string, total_approvals bigint, total_denials bigint, approval_rate decimal(5,2)")))
    inc.upsert_companies_stream(stream(spark, tmp_path / "in", schema), stored,
                                str(tmp_path / "state")).awaitTermination()
    rows = {r.employer_name: (r.total_approvals, r.ord) for r in stored.read(stored.latest()).collect()}
    assert rows == {"A": (3, 5), "B": (4, 5)} and stored.latest() == 1


def test_each_match_is_sent_once(spark, tmp_path):
    land(spark, tmp_path / "in", "id bigint", [(1,), (2,)], [(2,), (3,)])
    stored = inc.KeyedTable(spark, str(tmp_path / "matches"), "id", 4)
    stored.start(spark.createDataFrame(
        [(i, i == 3) for i in range(1, 5)], "id bigint, is_notified boolean"))

    def render(due):
        return due.select(F.col("id").alias("seq"), "id", F.lit("x").alias("html"))

    inc.notify_stream(stream(spark, tmp_path / "in", "id bigint"), stored, str(tmp_path / "sent"),
                      str(tmp_path / "state"), render).awaitTermination()
    sent = [r.id for r in spark.read.parquet(*[str(p) for p in (tmp_path / "sent").glob("batch=*")]).collect()]
    assert sorted(sent) == [1, 2]
    state = {r.id: r.is_notified for r in stored.read(stored.latest()).collect()}
    assert state == {1: True, 2: True, 3: True, 4: False}


COUNTS = "k string, n int"


def add(stored, incoming):
    had = stored.select("k", F.col("n").alias("had"))
    new = incoming.groupBy("k").agg(F.sum("n").cast("int").alias("n"))
    return had.join(new, "k", "full").select("k", (F.coalesce("had", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n"))


def test_a_merge_writes_only_the_buckets_it_touches(spark, tmp_path):
    table = inc.KeyedTable(spark, str(tmp_path / "t"), "k", 8)
    table.start(spark.createDataFrame([(f"k{i}", i) for i in range(200)] + [(None, 7)], COUNTS))
    want = {f"k{i}": i for i in range(200)} | {None: 7}
    for version, rows in enumerate([[("k1", 10)], [("k1", 1), ("new", 2)], [("k9", 5)], []]):
        for _ in range(2):  # a repeated merge gives the same version
            table.merge(version, spark.createDataFrame(rows, COUNTS), add)
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        assert {r.k: r.n for r in table.read(version).collect()} == want
        touched = table.buckets_of(spark.createDataFrame(rows, COUNTS))
        folder = tmp_path / "t" / "data" / f"v={version}"
        assert sorted(p.name for p in folder.glob("bucket=*")) == sorted(f"bucket={b}" for b in touched)
    assert {r.k: r.n for r in table.read(0).collect()}["k1"] == 11  # older versions stay as they were
    assert table.read(3, table.buckets_of(spark.createDataFrame([("k1", 0)], COUNTS))).count() < 60


def test_old_versions_are_cleaned_up(spark, tmp_path):
    table = inc.KeyedTable(spark, str(tmp_path / "t"), "k", 4)
    table.start(spark.createDataFrame([(f"k{i}", i) for i in range(40)], COUNTS))
    for version in range(5):
        table.merge(version, spark.createDataFrame([(f"k{version}", 100)], COUNTS), add)
    before = sorted(map(tuple, table.read(4).collect()))
    table.clean_up(keep=2)
    table.clean_up(keep=2)
    assert sorted(map(tuple, table.read(4).collect())) == before and table.manifests.versions() == [3, 4]
    assert table.read(3).where("k = 'k4'").first().n == 4
    files, _ = table._manifest(4)
    older, _ = table._manifest(3)
    held = {(int(p.parent.name[2:]), int(p.name[7:])) for p in (tmp_path / "t" / "data").glob("v=*/bucket=*")}
    assert held == {(v, b) for m in (files, older) for b, v in m.items()}


def test_a_table_may_be_empty(spark, tmp_path):
    table = inc.KeyedTable(spark, str(tmp_path / "t"), "k", 4)
    table.start(spark.createDataFrame([], COUNTS))
    assert table.read(-1).isEmpty() and table.read(-1).columns == ["k", "n"]
    table.merge(0, spark.createDataFrame([("a", 1)], COUNTS), add)
    table.merge(1, spark.createDataFrame([("a", 1)], COUNTS), lambda stored, incoming: stored.where("false"))
    assert table.read(0).count() == 1 and table.read(1).isEmpty()


def test_listings_wait_for_their_details_and_expire(spark, tmp_path):
    import json

    from openroles import schemas
    from openroles.streaming import details as late

    def pages(day, *ids):
        body = json.dumps({"content": [{"id": i, "name": "Software Engineer"} for i in ids]})
        return [("smartrecruiters", "acme", "Acme", "", "", 0, datetime(2026, 8, day), body)]

    def docs(day, *rows):
        return [("smartrecruiters", "acme", i, body, datetime(2026, 8, day)) for i, body in rows]

    good = json.dumps({"name": "Software Engineer", "ref": "https://x.example/1"})
    # In time; a day later; never; broken; of a listing nobody has; and two that make time pass.
    rounds = [(pages(1, "now", "later", "never", "broken"), docs(1, ("now", good), ("broken", good[:-3]), ("other", good))),
              (pages(2, "more"), docs(2, ("later", good), ("more", good))),
              (pages(20, "last"), docs(20, ("last", good), ("never", good))),
              (pages(21, "open"), docs(21, ("none", good)))]
    for n, (left, right) in enumerate(rounds):
        spark.createDataFrame(left, schemas.PAYLOADS).coalesce(1).write.parquet(f"{tmp_path}/pages/{n}")
        spark.createDataFrame(right, schemas.DETAILS + ", landed_at timestamp").coalesce(1).write.parquet(f"{tmp_path}/docs/{n}")
        query = inc.run_to_parquet(late.await_details(
            stream(spark, tmp_path / "pages", schemas.PAYLOADS),
            stream(spark, tmp_path / "docs", schemas.DETAILS + ", landed_at timestamp"), "smartrecruiters"),
            str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        assert late.late_rows(query) == 0
    joined = spark.read.parquet(str(tmp_path / "out"))
    got = {r.source_job_id for r in late.postings(joined, "smartrecruiters", F.current_timestamp()).collect()}
    assert got == {"now", "later", "more", "last"} and joined.count() == 6
    assert sorted(r.detail_key for r in joined.filter("detail is null").collect()) == ["broken", "never"]
    assert [(r.identifier, r.broken_details) for r in late.errors(joined, "smartrecruiters").collect()] == [("acme", 2)]


def test_waiting_listings_share_one_store_and_odd_rows_expire(spark, tmp_path):
    import json
    import os

    from openroles import schemas, session
    from openroles.streaming import details as late

    session.prepare(spark)
    body = json.dumps({"content": [{"id": i, "name": "Software Engineer"} for i in ("twice", "twice", None, "null", "cut", "own")]})
    left = [("smartrecruiters", b, "Acme", "", "", 0, datetime(2026, 8, 1), p)
            for b, p in (("acme", body), (None, body), ("acme", None), ("acme", ""), ("acme", "{}"))]
    good = json.dumps({"name": "Software Engineer"})
    right = [("smartrecruiters", b, k, p, datetime(2026, 8, 1)) for b, k, p in (
        ("acme", "twice", good), ("acme", "twice", good), ("acme", None, good), ("acme", "null", None), ("acme", "cut", good[:-2]),
        (None, "own", good), ("acme", "own", "{}"))]
    # Neither a page without listings nor a broken detail makes time pass.
    later = [datetime(2026, 8, d) for d in (19, 20, 21)]
    empty, listed = ([("smartrecruiters", "zeta", "Z", "", "", 0, t, p)] for t, p in ((later[0], "{}"), (later[2], body)))
    broken, parsed = ([("smartrecruiters", "zeta", "other", p, t)] for t, p in ((later[1], good[:-2]), (later[1], good)))
    lost = []
    for n, (pages, docs) in enumerate(((left, right), (empty, parsed), (listed, broken), (listed, parsed))):
        spark.createDataFrame(pages, schemas.PAYLOADS).coalesce(1).write.parquet(f"{tmp_path}/pages/{n}")
        spark.createDataFrame(docs, schemas.DETAILS + ", landed_at timestamp").coalesce(1).write.parquet(f"{tmp_path}/docs/{n}")
        inc.run_to_parquet(late.await_details(
            stream(spark, tmp_path / "pages", schemas.PAYLOADS),
            stream(spark, tmp_path / "docs", schemas.DETAILS + ", landed_at timestamp"), "smartrecruiters"),
            str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        lost.append(sum(r.detail is None for r in rows))
    assert lost == [0, 0, 0, 9]
    assert sorted((r.detail_key, r.identifier) for r in rows if r.detail is not None) == [("own", "acme")] + [("twice", "acme")] * 4
    # A listing without an id asks for the empty key; one of no board matches nothing.
    assert sorted((r.identifier or "", r.detail_key) for r in rows if r.detail is None) == sorted(
        [("acme", k) for k in ("", "null", "cut")] + [("", k) for k in ("", "null", "cut", "own", "twice", "twice")])
    # Four stores would have a folder each.
    assert not [d for d in os.listdir(tmp_path / "state" / "state" / "0" / "0") if d.startswith(("left-", "right-"))]


def test_cascade_of_deletions_equals_pruning_step_by_step(spark, tmp_path):
    rows = [(i % 23, i) for i in range(200)] + [(None, 900)]
    table = inc.KeyedTable(spark, str(tmp_path / "t"), "job_id", 8)
    table.start(spark.createDataFrame(rows, "job_id long, id long"))
    batches = [[(1, 1, "delete"), (2, 1, "delete"), (2, 2, "insert"), (99, 1, "delete")],
               [(1, 5, "insert"), (3, 9, "delete"), (3, 9, "insert"), (None, 1, "delete")],
               [(4, 2, "insert"), (4, 3, "delete"), (4, 3, "delete")]]
    want = set(rows)
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, "job_id long, ord long, change string").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        inc.cascade_stream(stream(spark, tmp_path / "in", "job_id long, ord long, change string"), [table],
                           str(tmp_path / "state")).awaitTermination()
        gone = {k for k in {b[0] for b in batch} if k is not None
                and not max((o, c == "insert") for j, o, c in batch if j == k)[1]}
        want = {r for r in want if r[0] not in gone}
    got = table.read(table.latest())
    assert got.count() == len(want) and {tuple(r) for r in got.collect()} == want
    # The last batch wrote one bucket at most.
    assert len(table.data.names(table.data.path(table.latest()))) <= 2
