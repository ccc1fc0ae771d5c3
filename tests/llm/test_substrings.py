"""Substring removal by FM-indexes: the index, the hashes and whole results against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from openroles.llm import substrings


def brute(rows):
    split = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t in rows]
    low = {}
    for i, words in split:
        for k in range(len(words) - 12):
            key = tuple(words[k:k + 13])
            if i is not None:
                low[key] = min(i, low.get(key, i))
    out = []
    for i, words in split:
        gone = {k + d for k in range(len(words) - 12) if i is not None and low[tuple(words[k:k + 13])] < i for d in range(13)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(40)] + ["é", "日本", "a", "\x1c"]
    passage = [[rng.choice(vocab) for _ in range(n)] for n in (13, 14, 30, 55)]
    hot = [rng.choice(vocab) for _ in range(40)]
    found = [(i, t) for i, t in enumerate([None, "", " \n\t ", "one", "a " * 13, "a " * 40, "b\n" * 12, "x" * 5000])]
    for i in range(8, 160):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice([[rng.choice(vocab) for _ in range(rng.randint(0, 30))], rng.choice(passage), hot])
        gaps = [rng.choice([" ", " ", "\n", " \t"]) for _ in words]
        found.append((rng.choice([i, i, i, None, 50]), "".join(w + g for w, g in zip(words, gaps))))
    found += found[20:30] + [(i, " ".join(hot)) for i in range(300, 340)] + [(500, " ".join(vocab * 60)), (-3, " ".join(hot[5:25]))]
    rng.shuffle(found)
    return found


@pytest.mark.parametrize("most", [substrings.MOST_OF_ANCHOR, 2])
def test_result_equals_brute_force(spark, rows, monkeypatch, most):
    monkeypatch.setattr(substrings, "MOST_OF_ANCHOR", most)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("doc", "h", "at", "flags", "anchor", "n_words")}).repartition(5)
    got = sorted((tuple(r) for r in substrings.deduplicate(df).collect()), key=str)
    assert got == brute(rows)


def test_empty_table_and_table_without_repeats(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    assert substrings.deduplicate(df.limit(0)).isEmpty()
    assert [tuple(r)[:3] for r in substrings.deduplicate(df).collect()] == [(1, 3, 0)]


def test_a_full_filter_changes_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(substrings, "FILTER_BITS", 64)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in substrings.deduplicate(df).collect()), key=str) == brute(rows)


def test_word_hashes_do_not_depend_on_the_place(monkeypatch):
    monkeypatch.setattr(substrings, "WORD_BLOCK", 7)
    texts = ["ab cd\tab é", None, "", "cd", " é é ab" * 9]
    data, begins = substrings.text_bytes(pa.array(["skipped", *texts]).slice(1))
    first, past, before = substrings.word_spans(data, begins)
    words = [bytes(data[f:p]).decode() for f, p in zip(first, past)]
    assert words == [w for t in texts for w in (t or "").split()]
    assert np.diff(before).tolist() == [len((t or "").split()) for t in texts]
    hashes = substrings.word_hashes(data, first, past).tolist()
    assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))


def test_passages_hold_every_window_once_and_equal_windows_share_anchors():
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 80))) for _ in range(40)] + ["a " * 30]
    row, word, windows, anchor = substrings.anchors(*substrings.text_bytes(pa.array(texts)))
    seen, of = [], {}
    for r, at, n, a in zip(row.tolist(), word.tolist(), windows.tolist(), anchor.tolist()):
        assert 1 <= n <= substrings.SPAN
        for i in range(at, at + n):
            seen.append((r, i))
            of.setdefault(tuple(texts[r].split()[i:i + 13]), set()).add(a)
    assert seen == [(r, i) for r, t in enumerate(texts) for i in range(max(0, len(t.split()) - 12))]
    assert all(len(x) == 1 for x in of.values())


def test_matching_statistics_equal_brute_force():
    rng = random.Random(5)
    held = [[rng.randint(2, 6) for _ in range(rng.randint(1, 25))] for _ in range(60)]
    index = substrings.FMIndex(np.array([x for h in held for x in h]), np.array([len(h) for h in held]))
    asked = np.array([rng.randint(2, 6) for _ in range(400)])
    ends = np.arange(len(asked))
    for least in (1, 2, 4):
        length, low, high = index.matching_statistics(asked, ends, np.minimum(ends + 1, 13), least)
        for e in ends.tolist():
            run, n = [], 0
            for k in range(1, min(e + 1, 13) + 1):
                tried = asked[e - k + 1:e + 1].tolist()
                found = sorted((p, i) for p, h in enumerate(held) for i in range(len(h)) if h[i:i + k] == tried)
                if len(found) < least:
                    break
                run, n = found, k
            assert length[e] == n
            if n:
                rows = index.suffixes[low[e]:high[e]]
                owner = index.owner[low[e]:high[e]]
                assert sorted(zip(owner.tolist(), (rows - index.begins[owner]).tolist())) == run
