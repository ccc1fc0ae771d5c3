"""Cross-tokenizer alignment and the audit of filters against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from openroles.llm import alignment, audit, packing

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [None, "", " ", "\n\n", "a", "a  b", " lead", "trail ", "▁mark ▁▁", "x\n\ny \n z", "é日本😀\x00\x1c", "!" * 70,
       "word " * 300 + "end", "w" * 3000, "<s>a</s> <|endoftext|>", "A\tB\r\nC D", "it's we'll 's", "one\ntwo three",
       " x", "a 　 b", "1234 5,6", "the cat the dog the end"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute_alignment(libraries, texts):
    a_lib, b_lib = libraries
    byte_of = packing.byte_characters()
    found = []
    for text in texts:
        told = (" " + text).encode() if text else b""
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        ta = [bytes(byte_of[c] for c in a_lib.id_to_token(i)) if i != 50256 else b"?" for i in a]
        tb = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
        if not text or b"".join(ta) != told or b"".join(tb) != told:
            found.append(None)
            continue
        spans = [[], []]
        for side, tokens in zip(spans, (ta, tb)):
            at = 0
            for t in tokens:
                side.append((at, at + len(t)))
                at += len(t)
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append(",".join(str(x) for x, (s, _) in zip(a, spans[0]) if low <= s < cut) + "|"
                          + ",".join(str(x) for x, (s, _) in zip(b, spans[1]) if low <= s < cut))
            low = cut
        found.append((len(a), len(b), links, groups))
    held = Counter(p for f in found if f for p in set(f[2]))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[3]), len(f[2]), sum(held[p] == best[p[0]] for p in f[2]), sum(held[p] for p in f[2]),
             hashlib.sha256(";".join(f[3]).encode()).hexdigest()) for f in found]


def test_alignment_equals_brute_force(spark, libraries, monkeypatch):
    rng = random.Random(4)
    pool = list("aeiounrst ,.") * 4 + ["  ", "\n", " the ", "é", "ß", "日", "'s", "10", "\t"]
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    rows = [(i, t, 1, "x", 5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pair int, block string, place int").repartition(3)
    want = brute_alignment(libraries, texts)
    got = {r.doc_id: tuple(r[1:]) for r in alignment.align(df, BYTES, PIECES).collect()}
    assert got == dict(enumerate(want))
    assert alignment.align(df.limit(0), BYTES, PIECES).isEmpty()


def test_alignment_counts_repeated_rows_each(spark, libraries):
    texts = ["the same text"] * 3 + ["another text", None]
    df = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")
    got = sorted(tuple(r[1:]) for r in alignment.align(df, BYTES, PIECES).collect())
    assert got == sorted(brute_alignment(libraries, texts))


def test_containers_and_planes_give_back_their_entries():
    rng = random.Random(8)
    block, want = alignment.Block(), {}
    for start in range(0, 900, 300):
        entries = [(d, p, rng.choice([1, 1, 1, 2, 3, 9])) for d in range(300) for p in range(20) if rng.random() < (p + 1) / 21]
        rng.shuffle(entries)
        want |= {(p, start + d): n for d, p, n in entries}
        block.add(*(np.array(x) for x in zip(*entries)), 300)
    got = {}
    for pair, docs, planes in block.postings():
        assert alignment.popcount(docs) == len(alignment.members(docs))
        for d in alignment.members(docs).tolist():
            got[pair, d] = 1 + sum((d in set(alignment.members(p).tolist())) << j for j, p in enumerate(planes))
    assert got == want


def brute_audit(docs, labels):
    told = {}
    for i, q, t in labels:
        if i is None:
            continue
        g = told.setdefault(i, [False, False])
        g[0] |= q == 1
        g[1] |= t == 1
    facts = []
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        same = any(j is not None and i is not None and j < i and (u or "") == text for j, u, _ in docs)
        facts.append((lang or "", {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                                   "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                                   "D": any(c in "#$%&*|" for c in text), "E": same}, *told.get(i, (False, False))))
    out = {}
    for part in {f[0] for f in facts}:
        mine = [f for f in facts if f[0] == part]
        total = Counter()
        for order in permutations("ABCDE"):
            for step, name in enumerate(order):
                row = [0] * 6
                for _, fails, good, toxic in mine:
                    gone = any(fails[x] for x in order[:step])
                    removed = fails[name] and not gone
                    row[0] += not gone and not fails[name]
                    row[1] += removed
                    row[2] += fails[name] and gone
                    row[3] += fails[name] and sum(fails.values()) == 1
                    row[4] += removed and good
                    row[5] += removed and toxic
                total[name] += row[1]
                out[part, "".join(order), step + 1] = row
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def test_audit_equals_brute_force(spark):
    rng = random.Random(6)
    docs = [(rng.choice([None, *range(40)]),
             rng.choice([None, "", "$", "AB cd", "same " * 120, " ".join(map(str, range(130))), "x y#",
                         " ".join(f"é{i}" for i in range(99 + rng.randint(0, 2))), f"own {rng.random()}"]),
             rng.choice([None, "", "de", "en", "en"])) for _ in range(150)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns(
        {c: F.lit("x") for c in ("key", "part", "mask", "n", "digest", "good")}).repartition(4)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("key", F.lit(1))
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in audit.interactions(df, told).collect()}
    assert got == {k: [int(x) for x in v] for k, v in brute_audit(docs, labels).items()}
    assert audit.interactions(df.limit(0), told).isEmpty()


def test_fields_of_sums_do_not_carry(spark):
    many = 1 << 61
    rows = spark.createDataFrame([("p", 127, many), ("p", 127, many), ("p", 0, 3)] + [(f"q{i}", 1, i) for i in range(700)],
                                 "part string, mask int, n long")
    found = audit.unpacked(audit.packed_sums(rows))
    first = {r.part: r for r in found.where("filter_order = 'ABCDE' AND step = 1").collect()}
    assert (first["p"].removed, first["p"].kept, first["p"].good_lost) == (2 * many, 3, 2 * many)
    assert all(first[f"q{i}"].unique_fails == i for i in range(700))
