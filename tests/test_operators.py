import random
from datetime import datetime
from decimal import Decimal
from hashlib import md5

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from openroles import schemas
from openroles.operators import dedup, employers, matching, merge, rollup
from openroles.operators.digest import digest_fragments, eligible_pending, write_digest
from openroles.operators.ranking import with_global_rank
from openroles.operators import vectors as vectors_module
from openroles.operators.vectors import cosine_topk, embedder, hashed_vectors, register_functions
from openroles.plans import ingest, matching as match_plan, sponsorship

H1B = ("`Employer` string, `Initial Approval` string, `Initial Denial` string, "
       "`Continuing Approval` string, `Continuing Denial` string, `NAICS` string, ord bigint")
COMPANY = ("company_id bigint, employer_name string, total_approvals bigint, "
           "approval_rate decimal(5,2)")


def filings(spark):
    h1b = spark.createDataFrame([
        (" Acme", "3", "1", "2", "0", None, 0), ("ACME ", "1,234", "x", None, "1", "0541", 1),
        ("acme", "1", "0", "0", "0", "999", 2), ("N/A", "9", "9", "9", "9", "1", 3),
        ("Zero", "0", "0", "0", "0", "7", 4)], H1B)
    perm = spark.createDataFrame([
        ("acme", "Certified"), ("Acme", "Certified - Withdrawn"), ("Beta", "denied"), ("", "Certified"),
        ("Beta", None)], "EMP_BUSINESS_NAME string, CASE_STATUS string")
    lca = spark.createDataFrame([("Beta", "Certified"), ("Gamma", "Withdrawn")],
                                "EMPLOYER_NAME string, CASE_STATUS string")
    return h1b, perm, lca


def test_company_table(spark):
    rows = {r.employer_name: r for r in sponsorship.company_table(*filings(spark)).collect()}
    acme = rows["ACME"]
    assert (acme.h1b_approvals, acme.h1b_denials, acme.perm_approvals, acme.perm_denials) == (6, 2, 2, 1)
    assert acme.naics_code == "541" and acme.approval_rate == Decimal("72.73")
    assert rows["BETA"].total_approvals == 1 and rows["BETA"].approval_rate == Decimal("50.00")
    assert rows["ZERO"].approval_rate == 0 and rows["GAMMA"].total_denials == 1
    assert set(rows) == {"ACME", "BETA", "GAMMA", "ZERO"}


def test_preserving_stored_h1b(spark):
    _, perm, lca = filings(spark)
    stored = spark.createDataFrame([("Acme", "12", 50, 5), ("Old", None, 7, None)],
                                   "employer_name string, naics_code string, h1b_approvals bigint, "
                                   "h1b_denials bigint")
    rows = {r.employer_name: r for r in sponsorship.company_table(
        None, perm, lca, stored, keep_stored_h1b=True).collect()}
    assert (rows["ACME"].h1b_approvals, rows["ACME"].naics_code) == (50, "12")
    assert (rows["OLD"].h1b_approvals, rows["OLD"].h1b_denials, rows["OLD"].perm_approvals) == (7, 0, 0)
    assert rows["BETA"].h1b_approvals == 0


def test_upsert_keeps_rows_below_the_cut(spark):
    companies = sponsorship.company_table(*filings(spark))
    stored = spark.createDataFrame(
        [("BETA", 9, 1, Decimal("90.00"), "n"), ("ACME", 1, 1, Decimal("50.00"), "m")],
        "employer_name string, total_approvals bigint, total_denials bigint, "
        "approval_rate decimal(5,2), extra string")
    rows = {r.employer_name: r for r in sponsorship.next_snapshot(
        stored, companies.select("employer_name", "total_approvals", "total_denials")).collect()}
    assert rows["BETA"].total_approvals == 9 and rows["ACME"].total_approvals == 8
    assert rows["ACME"].approval_rate == Decimal("72.73") and rows["ACME"].extra == "m"
    assert set(rows) == {"BETA", "ACME"}
    assert merge.duplicate_keys(stored, ["employer_name"]).count() == 0


def test_dedup_of_odd_identities_shuffles_plain_columns(spark):
    rows = [  # source, board, id, url; a row is kept if nothing before it has its identity
        ("lever_feed", "acme", "1", "https://x/1", True), ("lever", "ACME", "1", "https://x/2", False),
        ("google_search", "", "", "https://x/1", True), (None, "acme", "1", "https://x/1?a=b", False),
        ("lever_feed", None, "1", "https://x/1#top", False), ("lever_feed", "acme", None, "https://x/9", True),
        ("lever_feed", "acme", "https://x/1", "https://x/1", True), ("", "", "", "", True), (None, None, None, None, False),
        ("_feed", "acme", "1", "", False), ("lever_feed", "acme", "1", "https://x/1", False), ("lever", "acme1", "", "1", True),
        ("ashby", "acme", "1", "https://x/1", True), ("ashby_feed", "a", "cme1", "https://x/1", True)]
    frame = spark.createDataFrame([(*r[:4], i) for i, r in enumerate(rows)], "source string, source_board string, "
                                  "source_job_id string, job_url string, ord int")
    first = dedup.dedup_postings(frame, [F.col("ord")])
    assert sorted(r.ord for r in first.collect()) == [i for i, r in enumerate(rows) if r[4]]
    assert first.columns == frame.columns and dedup.dedup_postings(frame.limit(0), [F.col("ord")]).isEmpty()
    shuffles = [x for x in first._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in x]
    assert shuffles and all("(_platform#" in x for x in shuffles)


def test_dedup_and_hot_key(spark):
    """A third of all rows share one identity; the first of each is kept."""
    rows = [("lever_feed", "acme", "1" if i % 3 == 0 else str(i), f"https://x/{i}", i) for i in range(300)]
    rows += [("google_search", "", "", f"https://J.lever.co/a/{i % 5}/apply?x={i}", 300 + i) for i in range(20)]
    frame = spark.createDataFrame(rows, "source string, source_board string, source_job_id string, "
                                        "job_url string, ord int").repartition(7)
    got = sorted(r.ord for r in dedup.dedup_postings(frame, [F.col("ord")]).collect())
    seen, want = set(), []
    for source, board, job, url, order in rows:
        key = (source, board, job) if board else url.split("?")[0]
        if key not in seen:
            seen.add(key)
            want.append(order)
    assert got == want


def greedy(rows, limit, cap):
    picked, counts = [], {}
    for company, posted, order in sorted(rows, key=lambda r: (-(r[1] or datetime.min).toordinal(), r[2])):
        if counts.get(company.lower(), 0) < cap and len(picked) < limit:
            counts[company.lower()] = counts.get(company.lower(), 0) + 1
            picked.append(order)
    return picked


def test_diverse_jobs_equals_greedy_picking(spark):
    rng = random.Random(3)
    rows = [("Hot" if i % 3 == 0 else f"c{rng.randrange(9)}",
             None if i % 11 == 0 else datetime(2026, 8, rng.randrange(1, 29)), i) for i in range(400)]
    frame = spark.createDataFrame([(c, "", p, i) for c, p, i in rows],
                                  "company string, source_board string, posted_date timestamp, ord int")
    got = [r.ord for r in dedup.diverse_jobs(frame, 40, [F.col("ord")], 5).collect()]
    assert got == greedy(rows, 40, 5)


def test_newest_matches(spark):
    at = datetime(2026, 1, 1)
    frame = spark.createDataFrame([
        (1, 7, 1, at), (2, 7, 1, at), (3, 7, 1, None), (4, None, 1, at), (5, 8, 1, at)],
        "id int, job_id int, resume_id int, matched_at timestamp")
    assert sorted(r.id for r in dedup.newest_matches(frame).collect()) == [2, 3, 4, 5]


def test_employer_resolution(spark):
    companies = spark.createDataFrame([
        (1, "VISA TECHNOLOGY LLC", 563, Decimal("90.00")), (2, "VISA USA", 563, Decimal("80.00")),
        (3, "VISAGE", 9999, Decimal("10.00")), (4, "acme", 5, Decimal("1.00")),
        (5, "EMPTY CO", 0, Decimal("0.00")), (6, "100% PURE", 3, Decimal("3.00"))], COMPANY)
    asked = ["Visa", " visa usa ", "acme", "Visa T", "Empty", "Nova", "NOVA", "nova", "100%", "1_0", "  ", "",
             None, "solo"]
    rows = {r.company: r for r in employers.resolve_employers(
        spark.createDataFrame([(a,) for a in asked], "company string"), companies).collect()}
    assert (rows["Visa"].employer_name, rows["Visa"].tier) == ("VISAGE", "prefix")
    assert (rows["Visa T"].employer_name, rows["Visa T"].tier) == ("VISA TECHNOLOGY LLC", "prefix")
    assert (rows[" visa usa "].company_id, rows[" visa usa "].tier) == (2, "exact")
    assert (rows["acme"].company_id, rows["acme"].tier) == (4, "spelled")
    assert rows["100%"].company_id == 6 and rows["1_0"].tier == "new" and rows["Empty"].tier == "new"
    assert {rows[n].employer_name for n in ("Nova", "NOVA", "nova")} == {"NOVA"}
    assert rows["solo"].employer_name == "solo" and not {"", "  ", None} & set(rows)
    added = employers.new_companies(employers.resolve_employers(
        spark.createDataFrame([("Nova",), ("NOVA",)], "company string"), companies)).collect()
    assert [r.employer_name for r in added] == ["NOVA"]


def test_sponsor_filter_equals_brute_force(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("AB C") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    stored = [(i, n, rng.randrange(20), Decimal(rng.randrange(100))) for i, n in
              enumerate(dict.fromkeys(n.strip() or "X" for n in names))]
    asked = ["".join(rng.choice("ab c") for _ in range(rng.randrange(0, 4))) for _ in range(80)]
    frame = spark.createDataFrame(list(enumerate(asked)), "job_id int, company string")
    got = {r.job_id: r.company_id for r in employers.filter_by_sponsorship(
        frame, spark.createDataFrame(stored, COMPANY), 40.0).collect()}
    want = {}
    for i, name in enumerate(asked):
        hits = [c for c in stored if name.strip() and name.strip().upper() in c[1]]
        if hits:
            best = min(hits, key=lambda c: (-c[2], c[1]))
            if best[3] >= 40:
                want[i] = best[0]
    assert got == want and want


def test_new_jobs(spark):
    stored = spark.createDataFrame([
        ("h0", "https://jobs.lever.co/a/known"), ("s1", "https://boards.greenhouse.io/b/jobs/77?x=1"),
        ("s2", "https://careers.x.com/o?ref=ID-5&y"), ("s3", "https://acme.wd1.myworkdayjobs.com/S/job/c/T_R7")],
        "url_hash string, job_url string")
    rows = [("h0", "https://jobs.lever.co/a/known", "", "same hash"),
            ("h1", "https://boards.greenhouse.io/b/jobs/77", "77", "same id"),
            ("h2", "https://boards.greenhouse.io/b/jobs/7", "7", "new"),
            ("h3", "https://careers.x.com/jobs/ID-5", "ID-5", "part of a stored URL"),
            ("h4", "https://careers.y.com/jobs/ID-5", "ID-5", "new"),
            ("h5", "https://acme.wd1.myworkdayjobs.com/job/z_R7", "R7", "same id"),
            ("h6", "https://jobs.lever.co/a/other", "", "new"),
            ("h6", "https://jobs.lever.co/a/other", "q", "twice")]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                                  "url_hash string, job_url string, source_job_id string, why string, ord int")
    got = employers.jobs_to_insert(frame, stored, [F.col("ord")]).collect()
    assert sorted(r.url_hash for r in got) == ["h2", "h4", "h6"]
    assert {r.why for r in got} == {"new"}


def brute_force(queries, vectors, k, threshold):
    out = {}
    for q, a in queries:
        sims = []
        for j, b in vectors:
            if b is None or not np.any(b):
                continue
            s = round(float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)), 9)
            if s > threshold:
                sims.append((-s, j))
        for rank, (_, j) in enumerate(sorted(sims)[:k], 1):
            out[q, j] = rank
    return out


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(300)] + [(900, None)]
    queries = [(i, [float(x) for x in rng.integers(-2, 3, 4) + 0.25]) for i in range(9)]
    q = spark.createDataFrame(queries, "resume_id bigint, embedding array<float>")
    v = spark.createDataFrame(vectors, "job_id bigint, embedding array<float>").repartition(5)
    want = brute_force(queries, vectors, 10, 0.4)
    for block in (2048, 4):  # one block of profiles, and several
        got = cosine_topk(q, v, 10, 0.4, block_rows=block)
        assert {(r.resume_id, r.job_id): r["rank"] for r in got.collect()} == want
    zero = spark.createDataFrame([(1, [0.0] * 4)], "resume_id bigint, embedding array<float>")
    assert cosine_topk(zero, v).count() == 0


def test_ten_thousand_profiles_take_one_scan(spark):
    """Blocks in the shared folder, gone through in the task; the bound leaves nothing out."""
    rng = np.random.default_rng(7)
    centers = rng.standard_normal((6, 8))
    profiles = centers[rng.integers(0, 6, 10_000)] + 0.2 * rng.standard_normal((10_000, 8))
    jobs = np.concatenate([centers[rng.integers(0, 6, 500)] + 0.3 * rng.standard_normal((500, 8)), np.zeros((1, 8))])
    q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(profiles)], "resume_id long, embedding array<double>")
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(jobs)], "job_id long, embedding array<double>").repartition(3)
    got = cosine_topk(q.repartition(4), v, 3, 0.9)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan
    unit, jobs = profiles / np.linalg.norm(profiles, axis=1)[:, None], jobs[:500]
    sims = np.round(unit @ (jobs / np.linalg.norm(jobs, axis=1)[:, None]).T, 9)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :3]
    want = {(i, int(j)): r + 1 for i in range(10_000) for r, j in enumerate(order[i]) if sims[i, j] > 0.9}
    assert {(r.resume_id, r.job_id): r["rank"] for r in got.collect()} == want and len(want) > 20_000


def test_the_bound_leaves_out_only_what_cannot_enter():
    rng = np.random.default_rng(3)
    unit = np.array([[1.0, 0.05, 0], [1.0, -0.05, 0]])
    block = vectors_module._Block(np.arange(2), unit / np.linalg.norm(unit, axis=1)[:, None], 2, 0.5, 9)
    rows = rng.standard_normal((200, 3))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    left = set(range(200)) - set(block.reachable(rows).tolist())
    assert len(left) > 100 and (rows[sorted(left)] @ block.unit.T <= 0.5).all()


def test_match_jobs_from_sql(spark):
    register_functions(spark)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(200)] + [(900, None), (901, [0.0] * 4)]
    spark.createDataFrame(rows, "job_id long, embedding array<float>").repartition(3).createOrReplaceTempView("job_vectors")
    query = [0.5, -1.0, 0.25, 2.0]
    text = "SELECT * FROM match_jobs(TABLE(job_vectors), array({}), {}D, {}) ORDER BY similarity DESC, job_id LIMIT {}"
    for threshold, count in ((0.2, 7), (-1.0, 300), (0.99, 5), (0.0, 0)):
        got = spark.sql(text.format(", ".join(f"{x}D" for x in query), threshold, count, count)).collect()
        want = brute_force([(1, query)], [r for r in rows if r[0] < 900], count, threshold) if count else {}
        assert [(1, r.job_id) for r in got] == sorted(want, key=want.get)
    nothing = spark.sql("SELECT * FROM match_jobs(TABLE(job_vectors), CAST(NULL AS ARRAY<DOUBLE>), 0.1D, 5)")
    assert nothing.count() == 0


def test_profile_vectors_embed_only_the_missing(spark):
    rows = spark.createDataFrame([(1, "text", "[0.5, 1]"), (2, "text", "[broken"), (3, "text", None)],
                                 "id bigint, resume_text string, embedding string")
    got = {r.resume_id: r.embedding for r in match_plan.profile_vectors(rows, embedder()).collect()}
    assert got[1] == [0.5, 1.0] and len(got[2]) == 384 and got[2] == got[3]


JOBS = ("job_id bigint, company_id bigint, title string, location string, description string, "
        "job_url string, is_active boolean, posted_date timestamp")
JOB_ROWS = [
    (1, 31, "Radio Technician", "Tulsa, OK", "US citizenship is required.", "u1", True, None),
    (2, 47, "Weather Analyst", "Boise, ID", "We can sponsor visas.", "u2", True, None),
    (3, None, "SDE", "Berlin", "", "u3", True, None), (4, None, "SDE", "Boston, MA", "", "u4", False, None),
    (5, None, "SDE <x>", "Boston, MA", "", "u5?a=1&b=2", True, None)]


def test_candidates_filter_before_history(spark):
    jobs = spark.createDataFrame(JOB_ROWS, JOBS)
    companies = spark.createDataFrame([(47, "CLOUDBERRY LABS", 12, Decimal("61.50"))], COMPANY)
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(1, 6)],
                                    "job_id bigint, embedding array<float>")
    profiles = spark.createDataFrame([(9, [1.0, 1.0])], "resume_id bigint, embedding array<float>")
    rows = match_plan.candidates(profiles, vectors, jobs, companies).orderBy("rank").collect()
    assert [(r.job_id, r.employer_name) for r in rows] == [(2, "CLOUDBERRY LABS"), (5, None)]
    hits = cosine_topk(profiles, vectors)
    funnel = {r.stage: r.n for r in matching.hit_funnel(matching.hit_jobs(hits, jobs)).collect()}
    assert funnel == {"authorization": 1, "location": 1, "kept": 2}


def test_failed_scores_are_deferred(spark):
    rows = spark.createDataFrame([(1, 1, "good"), (1, 2, "bad"), (1, 3, "text")],
                                 "resume_id bigint, job_id bigint, prompt string")

    def load():
        def ask(prompt):
            if prompt == "bad":
                raise TimeoutError("no answer within a minute")
            return '{"score": 64}' if prompt == "good" else "no json"
        return ask

    parsed = matching.scored(matching.score_with(rows, load))
    assert [r.job_id for r in matching.ranked(parsed.withColumn("rank", F.lit(1))).collect()] == [1]
    outcome = matching.score_outcomes(parsed, ["resume_id"]).collect()[0]
    assert (outcome.succeeded, outcome.deferred) == (1, 2)
    stored = spark.createDataFrame([], "id bigint, job_id bigint, resume_id bigint, "
                                       "cosine_similarity decimal(5,4), score int, reasoning string, "
                                       "is_notified boolean, matched_at timestamp")
    saved = match_plan.save_matches(stored, rows.withColumn("similarity", F.lit(0.5)), parsed,
                                    F.lit(datetime(2026, 1, 1)).cast("timestamp")).collect()
    assert [(r.job_id, r.score, r.is_notified) for r in saved] == [(1, 64, False)]


def test_match_upsert_keeps_notification_state(spark):
    stored = spark.createDataFrame([(1, 5, 6, 70, True, datetime(2025, 1, 1))],
                                   "id bigint, job_id bigint, resume_id bigint, score int, "
                                   "is_notified boolean, matched_at timestamp")
    new = spark.createDataFrame([(5, 6, 90), (5, 7, 80)], "job_id bigint, resume_id bigint, score int")
    rows = {r.resume_id: r for r in merge.upsert_matches(
        stored, new, F.lit(datetime(2026, 1, 1)).cast("timestamp")).collect()}
    assert (rows[6].score, rows[6].is_notified, rows[6].matched_at.year) == (90, True, 2025)
    assert (rows[7].score, rows[7].is_notified, rows[7].matched_at.year) == (80, False, 2026)


def pending(spark, n=1):
    return spark.createDataFrame([
        (i, 80 + (i % 2), Decimal("0.5000"), "Engineer <script>", "New & Co", "Remote - US",
         "We will sponsor.", "", "https://e.com/j?a=1&b=2", "SDE", 0, Decimal("0.00"))
        for i in range(n)],
        "id bigint, score int, cosine_similarity decimal(5,4), title string, employer_name string, "
        "location string, description string, reasoning string, job_url string, resume_profile string, "
        "total_approvals bigint, approval_rate decimal(5,2)")


def test_digest_document(spark, tmp_path):
    fragments = digest_fragments(eligible_pending(pending(spark, 30)))
    rows = fragments.orderBy("seq").collect()
    assert len(rows) == 32 and rows[0].seq == 0 and "Found 30 " in rows[0].html
    assert [r.id for r in rows[1:31]] == [i for i in range(30) if i % 2] + [i for i in range(30) if not i % 2]
    assert "1. Engineer &lt;script&gt;" in rows[1].html and "a=1&amp;b=2" in rows[1].html
    assert "New &amp; Co" in rows[1].html and "No reasoning available" in rows[1].html
    write_digest(fragments, str(tmp_path / "digest"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "digest").glob("part-*")))
    assert text.startswith("<html>") and text.rstrip().endswith("</html>")
    assert digest_fragments(eligible_pending(pending(spark, 30).filter("id < 0"))).count() == 0


def test_global_rank_with_one_hot_value(spark):
    rows = spark.range(0, 5000, 1, 6).withColumn("score", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 90))
    got = with_global_rank(rows, [F.desc("score"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [r.id for r in got] == [r.id for r in sorted(got, key=lambda r: (-r.score, r.id))]


def test_resume_upsert_and_prune(spark):
    stored = spark.createDataFrame([(1, "Sde", "old", None, ["x"]), (2, "ML", "ml", None, ["y"])],
                                   "id bigint, profile_name string, resume_text string, "
                                   "embedding array<float>, skills array<string>")
    new = spark.createDataFrame([(8, "SDE", "Python"), (9, "new", "SQL")],
                                "id bigint, profile_name string, resume_text string")
    rows = {r.id: r for r in merge.upsert_resumes(stored, new, embedder(), [F.col("id")]).collect()}
    assert (rows[1].profile_name, rows[1].resume_text, rows[1].skills) == ("Sde", "Python", ["Python"])
    assert rows[2].skills == ["y"] and rows[9].skills == ["SQL"] and len(rows[9].embedding) == 384
    jobs = spark.createDataFrame([(1,)], "job_id bigint")
    both = spark.createDataFrame([(1,), (2,)], "job_id bigint")
    assert [f.count() for f in merge.prune_orphans(jobs, both, both)] == [1, 1]


def test_ingest_end_to_end(spark):
    posting = ("title string, company string, location string, description string, job_url string, "
               "url_hash string, source string, posted_date timestamp, source_job_id string, "
               "source_board string, scraped_at timestamp, page_no bigint, pos int")
    now = datetime(2026, 8, 31)
    direct = spark.createDataFrame([
        ("Software Engineer", "Acme", "Boston, MA", "x", "https://jobs.lever.co/acme/1", "a", "lever_feed",
         now, "1", "acme", now, 0, 0),
        ("Software Engineer", "Acme", "Berlin", "x", "https://jobs.lever.co/acme/2", "b", "lever_feed",
         now, "2", "acme", now, 0, 1),
        ("Software Engineer", "Acme", "Boston, MA", "x", "https://jobs.lever.co/acme/3", "c", "lever_feed",
         datetime(2026, 1, 1), "3", "acme", now, 0, 2)], posting)
    pages = spark.createDataFrame([(1, "SDE", "Nova", "", "", "2026-08-30", "lever",
                                    "https://jobs.lever.co/nova/9/apply?x=1", "raw")],
                                  "page_id bigint, title string, company string, location string, "
                                  "description string, posted_date string, source string, job_url string, "
                                  "url_hash string")
    picked = ingest.select_candidates(direct, ingest.searched_postings(pages), "all",
                                      F.lit(now).cast("timestamp"), 10)
    stored = spark.createDataFrame([("zz", "https://x.com")], "url_hash string, job_url string")
    companies = spark.createDataFrame([(1, "ACME LLC", 5, Decimal("9.00"))], COMPANY)
    result = ingest.ingest(picked, stored, companies, embedder())
    rows = {r.job_url: r for r in result.jobs.collect()}
    assert set(rows) == {"https://jobs.lever.co/acme/1", "https://jobs.lever.co/nova/9"}
    assert rows["https://jobs.lever.co/acme/1"].company_id == 1
    assert [r.employer_name for r in result.new_companies.collect()] == ["Nova"]
    assert result.embeddings.count() == 2
    kinds = {f.name: f.dataType for f in _parse_datatype_string(schemas.JOBS).fields}
    assert {f.name: f.dataType for f in result.jobs.schema.fields} == kinds
    assert rows["https://jobs.lever.co/acme/1"].scraped_at == now


def test_postings_without_a_company_keep_their_row(spark):
    rows = spark.createDataFrame([(c, f"u{i}") for i, c in enumerate((None, "", " ", "Acme", "Acme"))],
                                 "company string, job_url string").withColumns({
        **{n: F.lit("x") for n in ("title", "description", "location", "url_hash", "source")},
        **{n: F.lit(None).cast("timestamp") for n in ("posted_date", "scraped_at")}})
    links = spark.createDataFrame([("Acme", 4)], "company string, company_id bigint")
    got = {r.job_url: r.company_id for r in employers.job_rows(rows, links).collect()}
    assert got == {"u0": None, "u1": None, "u2": None, "u3": 4, "u4": 4}


def test_a_company_with_a_third_of_all_postings_is_split(spark):
    """Both sides of the last join have exchanges of their own, which is what run-time splitting needs."""
    names = spark.range(300).select(F.when(F.col("id") % 3 == 0, "Hot").when(F.col("id") % 3 == 1, "")
                                    .otherwise(F.concat(F.lit("c"), "id")).alias("company"), "id")
    stored = spark.createDataFrame([(1, "HOT ROLES INC", 5, Decimal("90.00"))], COMPANY)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = employers.filter_by_sponsorship(names, stored)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in got.collect()) == list(range(0, 300, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    inputs = plan.split("SortMergeJoin")[1].splitlines()
    sides = [n for n, line in enumerate(inputs) if line.strip(" :+-").startswith("Exchange hashpartitioning(_name")
             or line.strip(" :+-").startswith("Exchange hashpartitioning(piece") and "xxhash64" in line]
    assert len(sides) == 2


def test_upsert_takes_the_first_row_of_a_key(spark):
    stored = spark.createDataFrame([("A", 1)], "k string, v int")
    new = spark.createDataFrame([("A", 2), ("A", 3), ("B", 4), ("B", 5)], "k string, v int")
    got = merge.upsert(stored, new, ["k"], order=[F.desc("v")])
    assert sorted((r.k, r.v) for r in got.collect()) == [("A", 3), ("B", 5)]


def test_encoder_equals_word_by_word(spark):
    texts = ["", "a b A", "x\ty z " * 40, "\u00c9t\u00e9 \u00a0 x"]

    def one(text):
        v = np.zeros(384)
        for w in text.encode().lower().split():
            code = int(md5(w).hexdigest()[:8], 16)
            v[code % 384] += 1 if code >= 1 << 31 else -1
        n = np.sqrt((v * v).sum())
        return (v / n if n else v).astype(np.float32).tolist()

    assert [v.tolist() for v in hashed_vectors(texts, 384)] == [one(t) for t in texts]
    assert hashed_vectors([], 384) == [] and not hashed_vectors([""], 4)[0].any()


def test_rate_rule_overwrites_a_supplied_rate(spark):
    frame = spark.createDataFrame([(2, 1, Decimal("88.70")), (0, 0, Decimal("5.00")), (3, 0, None)],
                                  "total_approvals bigint, total_denials bigint, approval_rate decimal(5,2)")
    assert [r.approval_rate for r in rollup.with_approval_rate(frame).collect()] == [
        Decimal("66.67"), Decimal("0.00"), Decimal("100.00")]


def test_ids_are_compared_within_their_board(spark):
    """One requisition id on two tenants is two postings; hosts are compared by suffix."""
    def rows(*urls):
        return spark.createDataFrame(
            [(i, u, u, u.rsplit("_", 1)[-1].rsplit("/", 1)[-1]) for i, u in enumerate(urls)],
            "ord int, job_url string, url_hash string, source_job_id string")

    stored = rows("https://north.wd5.myworkdayjobs.com/Ext/job/Oslo/Other_R100", "https://careers.clever.com/jobs/9")
    incoming = rows("https://south.wd1.myworkdayjobs.com/Ext/job/Rome/Role_R100",
                    "https://north.wd5.myworkdayjobs.com/Int/job/Oslo/Again_R100", "https://jobs.lever.co/jobs/9")
    kept = employers.jobs_to_insert(incoming, stored, [F.col("ord")])
    assert {r.ord for r in kept.collect()} == {0, 2}


def test_vectors_without_a_finite_length_take_no_part(spark):
    sound = [(i, [1.0, i / 100]) for i in range(20)]
    odd = [(100, [float("inf"), 1.0]), (101, [float("nan"), 1.0]), (102, [0.0, 0.0])]
    hits = cosine_topk(
        spark.createDataFrame([(1, [1.0, 0.0])], "resume_id long, embedding array<float>"),
        spark.createDataFrame(sound + odd, "job_id long, embedding array<float>"), k=3)
    assert [r.job_id for r in hits.orderBy("rank").collect()] == [0, 1, 2]
