"""The Jaccard join and the pipeline against brute force, and queries against SQL."""

import os
import random
import re

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from openroles.llm import jaccard, language, packing, quality_rules, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(number of shingles, smallest id reachable) by id."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    low = {i: i for i in sets}
    changed = True
    near = [(i, j) for i in sets for j in sets if i < j and any(
        a and b and 100 * len(a & b) >= 80 * len(a | b) for a in sets[i] for b in sets[j])]
    while changed:
        changed = False
        for i, j in near:
            m = min(low[i], low[j])
            changed |= low[i] != m or low[j] != m
            low[i] = low[j] = m
    return low


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    passage = rng.choices(words, k=30)
    texts = [None, "", "Short text", "short TEXT", "only four words here"]
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(5, 80))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
        texts.append(" ".join(passage + rng.choices(words, k=10)))
    rng.shuffle(texts)
    return [(3 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,cell", [(1, 1_500_000), (2, 300), (3, 60)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", cell)  # small cells are searched block by block
    if cell < 100:
        monkeypatch.setattr(jaccard, "SHAPED_SHINGLES", 100)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "h", "rep", "cell", "s")})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(docs.repartition(3)).collect()}
    low = brute(rows)
    assert got == {i: (len(shingles(t)), low[i]) for i, t in rows}


def test_null_ids_repeated_rows_and_ids_of_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(None, a), (1, a), (1, a), (2, a), (2, b), (3, b), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard.classes(docs).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]
    kept = jaccard.keep_first(docs)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "None"]
    assert jaccard.classes(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("cell", [1_500_000, 60])
def test_ids_of_texts_of_different_lengths(spark, monkeypatch, cell):
    """Every text of an id links, whatever lengths its other texts have."""
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", cell)
    short, long = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(200)]
    rows = [(7, " ".join(short)), (7, " ".join(long)), (8, " ".join([*short[:-1], "x"])), (9, " ".join([*long[:-1], "y"])),
            (3, " ".join(["z", *long[:-1]])), (10, "no copy of any other text is here")]
    other = corpus(4)  # ids with two or three texts of any lengths
    rows += [(100 + i % 40, t) for i, t in other]
    got = {r.doc_id: r.component_id for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and {got[i] for i in (3, 7, 8, 9)} == {3} and got[10] == 10


def test_search_equals_brute_force():
    rng = random.Random(6)
    import numpy as np

    for _ in range(20):
        base = [rng.getrandbits(64) for _ in range(60)]
        sets = [np.unique(np.array(rng.sample(base, rng.randint(40, 60)) + [rng.getrandbits(64) for _ in range(rng.randint(0, 8))],
                                   np.uint64)) for _ in range(25)]
        index = jaccard.Index(sets, np.arange(25))
        shapes = jaccard.Shapes(np.array([len(s) for s in sets]), [jaccard.shape_of(s) for s in sets])
        for q, s in enumerate(sets):
            want = [i for i, t in enumerate(sets) if jaccard.links(len(s), len(t), len(np.intersect1d(s, t)))]
            assert index.search(s, np.ones(25, bool)) == want
            assert set(want) <= set(shapes.search(q, np.ones(25, bool)))


def family(rng, docs, words=300):
    """Near copies of one text with one to 40 words of it replaced, so that some link with no other."""
    base, sets = [f"w{i}" for i in range(words)], []
    for _ in range(docs):
        copy = list(base)
        for at in rng.sample(range(words), rng.randint(1, words // 8)):
            copy[at] = f"x{rng.randrange(40)}"
        sets.append(jaccard.shingle_set(" ".join(copy)))
    return sets


def test_near_copies_are_searched_without_a_step_for_each_shingle():
    """A cell of near copies grows with the corpus; before, the search took a Python step for each shingle in a list."""
    import sys

    import numpy as np

    sets, calls = family(random.Random(8), 200), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        pairs = jaccard.search_block(sets)
    finally:
        sys.setprofile(None)
    assert calls < 200 * len(sets)
    near = {(a, b) for a in range(200) for b in range(a) if jaccard.links(len(sets[a]), len(sets[b]), len(np.intersect1d(sets[a], sets[b])))}

    def lowest(links):
        low, changed = list(range(200)), True
        while changed:
            before = list(low)
            for a, b in links:
                low[a] = low[b] = min(low[a], low[b])
            changed = low != before
        return low

    assert {(max(p), min(p)) for p in pairs} <= near and lowest(pairs) == lowest(near)
    assert 20 < len({a for p in near for a in p}) < 200


def test_sets_left_out_before_a_search_link_with_none():
    import numpy as np

    rng = random.Random(9)
    for _ in range(30):
        base = [rng.getrandbits(64) for _ in range(50)]
        sets = [np.unique(np.array(rng.sample(base, rng.randint(1, 50)) + [rng.getrandbits(64) for _ in range(rng.randint(0, 9))],
                                   np.uint64)) for _ in range(20)]
        near = {a for a in range(20) for b in range(20) if a != b and jaccard.links(
            len(sets[a]), len(sets[b]), len(np.intersect1d(sets[a], sets[b])))}
        assert near <= set(np.flatnonzero(jaccard._linkable(sets)).tolist())
    assert jaccard.search_block([]) == [] and len(jaccard._linkable([])) == 0


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)], "u long, v long")
    got = {r.node: r.component for r in jaccard.connected(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[150] == got[200] == 100
    assert jaccard.connected(edges.limit(0)).isEmpty()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_pipeline_equals_its_steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality_rules.apply_policy(quality_rules.ledger(docs, "doc_id")).where("kept").collect()}
    left = docs.where(F.col("doc_id").isin(list(good)))
    known = {r.doc_id for r in language.identify(left, language.learn(left)).where("lang_pred != 'und' and score >= 0.05").collect()}
    low = brute([(i, rows[i].text) for i in sorted(known)])
    first = {i for i in known if low[i] == i}
    tokens = packing.ByteTokenizer(queries.tokenizer_file("byte_bpe_50k.json"))
    want = {(i, sum(1 for _ in range(0, len(tokens.encode([rows[i].text])[0]) + 1, 2048))) for i in first}
    got = {}
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert set(got.items()) == want and len(first) < len(good) < len(rows)


def test_pipeline_on_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, text.upper().lower(), None, None, None), (3, None, None, None, None),
            (None, text + " more", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("n", "rep", "kept", "length", "piece", "_part", "ids")})
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stage(spark, docs, FOLDER)
        assert name == "best_fit_packing" or docs.columns == columns
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.isEmpty()


def test_keep_first_with_columns_of_its_own_names(spark):
    """Documents may have columns named as the operator names its own."""
    from openroles.llm import jaccard

    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (3, "other words", "c")], "doc_id long, text string, _id string")
    df = df.withColumns({"id": df._id, "n": df._id, "c": df._id})
    assert sorted(r.doc_id for r in jaccard.keep_first(df).collect()) == [1, 3]


def test_copies_that_are_too_many_for_a_broadcast(spark, monkeypatch):
    """Only rows that a bitmap tells may be gone are shuffled with their texts."""
    monkeypatch.setattr(jaccard, "LISTED", 0)
    monkeypatch.setattr(jaccard, "GONE_BITS", 1 << 8)  # so that some that stay look gone
    texts = ["the same five words again"] * 60 + [f"text {i} on its own" for i in range(200)]
    rows = [(3 * i - 90, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (-90, "what the first says besides this"), (0, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_word": F.lit(1), "_bits": F.lit("b"), "_id": F.lit(0)})
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    low = brute([r for r in rows if r[0] is not None])
    want = sorted([i for i in low if low[i] == i] + [10 ** 6] * 2)
    assert sorted(10 ** 6 if r.doc_id is None else r.doc_id for r in kept.collect()) == want and len(want) == 203
    joins = re.findall(r"Join LeftAnti.*\n(?:.*\n){0,3}?.*Filter.*getbit", jaccard._without(
        docs, "doc_id", spark.range(5).toDF("gone"))._jdf.queryExecution().optimizedPlan().toString())
    assert joins
