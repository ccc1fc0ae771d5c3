"""The operators on single rows: brute force, round trips, edge rows, clashing names."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from openroles.llm import chat, cotraining, fingerprints, language, packing, quality_rules, sentencepieces, urls, wrappers

PIECES, BYTES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json"))
ODD_TEXTS = [None, "", " ", "\n\n", "a", "a  b", " lead", "trail ", "▁mark ▁▁", "x\n\ny \n z", "é日本😀\x00\x1c", "!" * 70,
             "word " * 3000, "w" * 5000, "<s>a</s> <|endoftext|>", "A\tB\r\nC\u00a0D"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(ODD_TEXTS)] + [(1, "", None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def clashing(df):
    """Columns named as operators name theirs."""
    return df.withColumns({c: F.lit("x") for c in ("ids", "k", "n", "h", "length", "sequence_id", "score", "failed", "a", "t", "rep")})


def test_pieces_equal_the_library(spark, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in sentencepieces.encode(clashing(odd), PIECES).collect():
        text = ODD_TEXTS[r.doc_id] or ""
        assert list(r.ids) == library.encode(text) and r.decoded == library.decode(library.encode(text))
    empty = sentencepieces.encode(odd.limit(0), PIECES, digest=sentencepieces.digests, digest_schema=sentencepieces.DIGEST)
    assert empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and empty.isEmpty()


def test_both_agendas_give_the_same_ids():
    voc = sentencepieces.Vocabulary(PIECES)
    rng = random.Random(3)
    for _ in range(300):
        word = "▁" + "".join(rng.choice("abcdehnorst▁é") for _ in range(rng.randint(0, 30)))
        assert voc._by_scan(word) == voc._by_heap(word)


def test_agendas_of_many_words_equal_those_of_each():
    voc = sentencepieces.Vocabulary(PIECES)
    rng = random.Random(4)
    words = ["▁" + "".join(rng.choice("abcdehnorst▁é日😀\u0301\x00") for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    words += ["\n", "\nthe", "▁", "▁▁▁", "▁" + "日" * 100, "▁the"]
    ids, lengths = voc.agendas(words)
    each = [voc.agenda(w) for w in words]
    assert lengths.tolist() == list(map(len, each)) and ids.tolist() == [i for x in each for i in x]


def test_new_words_take_little_longer_than_in_the_library():
    voc = sentencepieces.Vocabulary(PIECES)
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("aaeehhinnorstt", k=rng.randint(4, 14))) for _ in range(20_000)) for _ in range(4)]
    ratios = []
    for text in texts:
        start = time.process_time()
        sentencepieces.encode_batch(voc, [text])
        ours = time.process_time() - start
        voc.library.encode(text.split(" "), num_threads=1)
        ratios.append(ours / (time.process_time() - start - ours))
    assert min(ratios) < 4.5, ratios


def test_words_that_are_forgotten_are_learnt_again(monkeypatch):
    voc = sentencepieces.Vocabulary(PIECES)
    monkeypatch.setattr(sentencepieces, "REMEMBERED_WORDS", 50)
    rng = random.Random(8)
    for _ in range(40):
        texts = [" ".join(rng.choice("abc") * rng.randint(1, 90) for _ in range(20)) for _ in range(3)]
        ids, decoded = sentencepieces.encode_batch(voc, texts)
        assert [x.tolist() for x in ids] == voc.library.encode(texts) and decoded == texts
        assert len(voc.known) == voc.coded.n and max(map(len, voc.known)) <= sentencepieces.LONGEST_REMEMBERED
    assert len(voc.known) < 50 + 60
    monkeypatch.setattr(voc.pairs, "of_code", np.full(99, voc.pairs.other, np.int32))
    with pytest.raises(ValueError, match="ids differ from the library's"):
        voc.encode(["a there"])
    monkeypatch.undo()
    assert [x.tolist() for x in voc.encode(["a there"])] == voc.library.encode(["a there"])


def test_byte_ids_equal_the_library():
    ours = packing.ByteTokenizer(BYTES)
    rng = random.Random(5)
    pool = [chr(i) for i in range(0x250)] + list(" \n\t'sdt.!") * 30 + ["日", "€"]
    texts = [t or "" for t in ODD_TEXTS] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(2000)]
    assert [x.tolist() for x in ours.encode(texts)] == [e.ids for e in ours.library.encode_batch(texts, add_special_tokens=False)]


def test_packing_places_every_piece_without_gaps(spark, odd):
    pieces = packing.pieces(clashing(odd), BYTES, keys=("doc_id", "length", "sequence_id"), capacity=64)
    assert pieces.columns == ["doc_id", "length", "sequence_id", "piece", "start", "_length", "ids"]
    own = {c: F.lit("x") for c in ("_part", "_l", "_p", "n", "offset")}
    placed = packing.place(pieces.withColumns(own), 64, "_length")
    assert placed.columns[-2:] == ["_sequence_id", "_offset"]
    rows = placed.drop("length", "sequence_id", "offset").withColumnsRenamed(
        {"_length": "length", "_sequence_id": "sequence_id", "_offset": "offset"}).collect()
    bins = {}
    for r in rows:
        assert 1 <= r.length <= 64 and len(r.ids) == 4 * r.length and (r.piece == 0 or r.length == 64)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= 64
    assert len(bins) <= -(-sum(r.length for r in rows) // 64) + 1
    assert packing.place(packing.pieces(odd.limit(0), BYTES)).isEmpty()


def test_lengths_that_fit_no_sequence_get_no_place(spark):
    rows = packing.place(spark.createDataFrame([(0, None), (1, 0), (2, 9), (3, 5), (4, 3)], "i int, length long"), 8)
    assert {r.i: r.sequence_id is None for r in rows.collect()} == {0: True, 1: True, 2: True, 3: False, 4: False}


def test_fullest_finds_the_largest_sum():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(1, 30)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        used = packing.fullest(counts, room)
        assert all(n <= counts[k] for k, n in used.items())
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_rules_measure_and_keep(spark, odd):
    texts = ["a b c a b c\na b c a b c", "# | <x> b\nb\nb", " ".join(f"word{i}" for i in range(60))]
    more = odd.union(spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(texts)], odd.schema))
    judged = quality_rules.apply_policy(quality_rules.ledger(clashing(more), "doc_id")).collect()
    for r in judged:
        text = texts[r.doc_id - 100] if r.doc_id >= 100 else ODD_TEXTS[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(text), r.doc_id
    kept = quality_rules.keep(clashing(more))
    assert kept.columns == clashing(more).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged if r.kept) == [102]
    table = {r.rule: r for r in quality_rules.ablations(quality_rules.ledger(more, "doc_id")).collect()}
    for rule in quality_rules.RULES:
        bit = 1 << rule.bit
        assert table[rule.name].fail == sum(bool(r.failed & bit) for r in judged)
        assert table[rule.name].fail_alone == sum(r.failed == bit for r in judged)
        assert table[rule.name].kept_without == sum(r.failed & ~bit == 0 for r in judged)


def test_host_path_and_rules(spark):
    rules = (("net", "/", "block"), ("example.net", "/en/", "allow"))
    rows = [(None,), ("no scheme",), ("http://A.Example.NET/en/x?y#z",), ("http://example.net",), ("x://b.net?/",), ("a://b://c/d",)]
    got = urls.judge(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id int, url string"), rules,
                     np.zeros(urls.WEIGHTS + 1)).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in got] == [
        ("", "", None), ("", "", None), ("a.example.net", "/en/x", "example.net/en/"), ("example.net", "", None),
        ("b.net", "", None), ("b:", "//c/d", None)]
    assert got[2].verdict == "allow"


def test_url_model_on_hosts_it_has_not_seen(spark):
    weights = urls.fit(spark.createDataFrame(urls.small_labelled_table(), "url string, blocked int"))
    bad = [f"https://{h}.example.com/en/7" for h in ("best-casino-bets", "cheap-pills-shop", "spam-links", "ads-tracker")]
    good = [f"https://{h}.example.com/en/7" for h in ("thenation", "www.erinhost", "blog.station", "oranger")]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id int, url string")
    assert [r.verdict for r in urls.judge(frame, (), weights).orderBy("page_id").collect()] == ["block"] * 4 + ["allow"] * 4
    assert urls.fit(spark.createDataFrame([], "url string, blocked int"))[-1] < 0


def test_languages_on_held_out_rows(spark, odd):
    rng = random.Random(9)
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["str", "ung", "cht", "ei"], "cc": ["ção", "nho", "lha", "eu"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(30)), lang)
            for i, lang in enumerate(list(syllables) * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language.held_out(F.col("doc_id"))
    assert {r.doc_id for r in docs.where(held).collect()} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    found = {r.doc_id: r for r in language.identify(clashing(docs), language.learn(docs.where(~held))).collect()}
    assert all(found[i].lang_pred == lang and 0 < found[i].score <= 1 for i, _, lang in rows)
    prototypes = language.learn(docs)
    assert {r.doc_id for r in language.identify(odd, prototypes).collect() if r.lang_pred == "und"} >= {0, 1, 2, 3, 11}
    assert all(r.lang_pred == "und" for r in language.identify(odd, language.learn(docs.limit(0))).collect())
    assert language.keep(clashing(odd), prototypes).columns == clashing(odd).columns


def test_quality_classifier_on_held_out_rows(spark, odd):
    rng = random.Random(4)
    def text(good):
        return (" ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(60)) + ".") if good else "BUY!! " * rng.randint(20, 80)
    rows = [(i, text(i % 3 > 0), "en", f"s{i % 5}", 100) for i in range(300)]
    docs = spark.createDataFrame(rows, odd.schema)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 150)] + [(9999, 1), (3, None), (None, 1)], "doc_id long, quality int")
    scored = cotraining.score(clashing(docs).drop("score"), cotraining.fit(docs, labels)).collect()
    right = [r.kept == (r.doc_id % 3 > 0) for r in scored if r.doc_id >= 150]
    assert np.mean(right) > 0.97
    none = cotraining.fit(docs, labels.limit(0))
    assert {r.score for r in cotraining.score(odd, none).collect()} == {0.5}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_of_edited_and_next_texts(spark):
    rng = random.Random(8)
    texts = [None, "", "one", "a b c d e", *[" ".join(rng.choices("abcdefgh", k=rng.randint(1, 60))) for _ in range(20)]]
    docs = spark.createDataFrame([(3 * i - 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in fingerprints.with_neighbours(clashing(docs).drop("t").withColumn("t", F.lit(1))).select(
        "*", fingerprints.resemblance(F.col("fingerprint"), F.col("next_fingerprint")).alias("near"),
        fingerprints.containment(F.col("fingerprint"), F.col("next_fingerprint")).alias("inside"),
        fingerprints.distinct_shingles(F.col("fingerprint")).alias("n")).collect()}
    for i, t in enumerate(texts):
        own, following, r = t or "", texts[(i + 1) % len(texts)] or "", rows[3 * i - 7]
        q = len(own) // 4
        a, b = shingles(own), shingles(following)
        assert r.edited == own[:len(own) - q] + following[:q] and r.n == len(a)
        assert r.near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert r.inside == pytest.approx(len(a & b) / len(a) if a else 1.0)
    assert fingerprints.with_neighbours(docs.limit(0)).isEmpty()
    twice = fingerprints.with_neighbours(docs.union(docs.limit(3)).union(spark.createDataFrame([(None, "x")], docs.schema)))
    assert twice.count() == len(texts) + 1


def test_sketches_of_parts_merge(spark):
    parts = spark.createDataFrame([("g", " ".join(f"w{i}" for i in range(k, k + 400))) for k in (0, 300, 600)], "g string, text string")
    merged = fingerprints.merge_all(fingerprints.fingerprint(parts, "g"), "g").select("fingerprint").first()[0]
    whole = spark.createDataFrame([(" ".join(f"w{i}" for i in range(1000)),)], "text string")
    sketch = whole.select(fingerprints.sketch(F.col("text"))).first()[0]
    assert len(merged) == fingerprints.K and len(set(merged) & set(sketch)) == fingerprints.K


PAGE = ("<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li>m</li><li>n</li></ul></nav>"
        "<div class='ad'>buy</div><article><h1>Head &amp; top</h1>{}</article><aside>side</aside><div class='comments'><p>me</p></div>"
        "<footer>f</footer></body></html>")


def test_wrappers_find_the_article(spark):
    bodies = ["<p>one</p>", "<p>one <b>two<br><p>three\n four</p>", "<ul><li>x<li>y</ul><p>z</p>", "<p>cut &am"]
    want = ["one", "one two\n\nthree four", "x\n\ny\n\nz", "cut &am"]
    pages = [PAGE.format(b) for b in bodies[:3]] + [PAGE.format(bodies[3]).split("&am<")[0] + "&am"]
    rows = [(i, "http://h.example/" + str(i), p) for i, p in enumerate(pages)] + [
        (10, None, None), (11, "x", ""), (12, "http://o/", "<div>plain <i>text</i></div><form>no</form>"), (13, "http://o/", "<p")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "page": F.lit(2)})
    got = {r.page_id: r.text for r in wrappers.main_text(frame).collect()}
    assert got == {**{i: "Head & top\n\n" + w for i, w in enumerate(want)}, 10: "", 11: "", 12: "plain text", 13: ""}
    assert wrappers.main_text(frame.limit(0)).isEmpty()


def test_alignment_makes_optional_and_repeated_groups():
    a, b = (wrappers.stream(p) for p in ("<div>x</div><p>y</p>", "<div>x</div><h2>t</h2><p>y</p><p>z</p>"))
    assert wrappers.align(a, b) == [["e", "div", [["#", "1"]], "1"], ["e", "h2", [["#", "1"]], "?"], ["e", "p", [["#", "1"]], "+"]]
    pairs = wrappers.stream("<section>" + "<h2>a</h2><p>b</p>" * 3 + "</section>")
    assert pairs == [["e", "section", [["g", [["e", "h2", [["#", "1"]], "1"], ["e", "p", [["#", "1"]], "1"]], "+"]], "1"]]


def test_what_a_host_repeats_is_no_main_text(spark):
    """No telling names: only the host's other pages show what is its own; a host of one page keeps all."""
    page = ("<div class='box'><p>Home</p><p>About</p></div><div class='col'><h1>t{0}</h1>{1}<p>All rights reserved.</p></div>"
            "<div class='box'>We store data. {2}</div>")
    bodies = ["<p>a0</p>", "<p>a1</p><p>b1</p>", "<ul><li>x2</li></ul><p>a2</p>", "<p>a3</p><p>b3</p><p>c3</p>"]
    rows = [(i, "http://h.example/" + str(i), page.format(i, b, "")) for i, b in enumerate(bodies)]
    rows += [(9, "http://one.example/", page.format(9, "<p>a9</p>", ""))]
    rows += [(20 + i, "http://copy.example/" + str(i), page.format(5, "<p>same</p>", "")) for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text.split("\n\n") for r in wrappers.main_text(frame).collect()}
    whole = ["Home", "About", "t9", "a9", "All rights reserved.", "We store data."]
    copy = ["Home", "About", "t5", "same", "All rights reserved.", "We store data."]
    assert got == {0: ["t0", "a0"], 1: ["t1", "a1", "b1"], 2: ["t2", "x2", "a2"], 3: ["t3", "a3", "b3", "c3"], 9: whole,
                   **{20 + i: copy for i in range(4)}}


def test_a_post_beside_teasers_in_articles_is_kept(spark):
    rows = [(i, f"http://p.example/{i}", f"<div class='post'><p>{'word ' * 20}{i}</p></div><article>teaser {i}</article>")
            for i in range(3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(frame).collect()}
    assert got == {i: f"{'word ' * 20}{i}\n\nteaser {i}" for i in range(3)}


def test_names_count_as_a_whole_and_not_on_the_page_itself(spark):
    pages = ["<body class='single-post no-sidebar search'><div class='has-header-image'>kept</div></body>",
             "<article class='sidebar'><div class='entry-header'><h1>Title</h1></div><p>body</p></article>",
             "<div class='w-1/2 sidebar'>gone</div><p data-id='menu' data-role='nav'>kept</p>",
             "<div id='site-footer'>gone</div><div class='ad-17'>gone</div><div role=\"search\">gone</div><p>kept</p>"]
    frame = spark.createDataFrame([(i, f"http://h{i}.example/", p) for i, p in enumerate(pages)],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(frame).collect()}
    assert got == {0: "kept", 1: "Title\n\nbody", 2: "kept", 3: "kept"}


def test_what_an_article_holds_stays_and_comments_go(spark):
    """Each page's own texts are numbered, so that the pages of a host differ."""
    cases = {
        "repeated": ("<article><h1>t{0}</h1><p>b{0}</p><p>All prices are in euros.</p></article>",
                     ["t{0}", "b{0}", "All prices are in euros."]),
        "comments": ("<article><p>b{0}</p><div class='comments-open'>c{0}</div></article><ol class='comment-list'><li>x{0}</li></ol>"
                     "<div class='post-comment'>y</div><article class='comment-body'>z{0}</article><section id='comments'>w</section>",
                     ["b{0}", "c{0}"]),
        "within": ("<article><p>b{0}</p><div id='comment-{0}'><p>x{0}</p></div><div class='no-comments'>k{0}</div></article>",
                   ["b{0}", "k{0}"]),
        "header": ("<header><h1>Site</h1></header><article><header class='entry-header header'><nav>n</nav><h1>Title {0}</h1>"
                   "</header><p>b{0}</p><footer>f</footer></article>", ["Title {0}", "b{0}"]),
        "math": ("<article><p>so <math><mi>x{0}</mi><annotation>tex</annotation></math> holds</p>"
                 "<object data='a'>o{0}</object></article>", ["so x{0} holds o{0}"]),
        "lead": ("<p>Site name</p><p>lead {0}</p><article><p>{1} {0}</p></article><p>after {0}</p>", ["lead {0}", "{1} {0}"]),
    }
    long = "word " * 20 + "end"
    rows = [(10 * k + i, f"http://{name}.example/{i}", page.format(i, long))
            for k, (name, (page, _)) in enumerate(cases.items()) for i in range(5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in wrappers.main_text(frame).collect()}
    want = {10 * k + i: "\n\n".join(blocks).format(i, long) for k, (_, blocks) in enumerate(cases.values()) for i in range(5)}
    want.update({40 + i: f"so x{i} holds\n\no{i}" for i in range(5)})
    assert got == want


def test_a_host_of_many_streams_is_read_alike_however_it_is_dealt(spark):
    """Pages of one host with different runs of blocks, planted main text and the host's own lines around it."""
    pages, want = [], {}
    for i in range(60):
        blocks = [f"p{i} {j}" for j in range(i % 7 + 1)]
        body = "".join(f"<{t}>{b}</{t}>" for b, t in zip(blocks, ("h2", "p", "blockquote", "p", "pre", "p", "h3")))
        pages.append((i, f"http://many.example/{i}", f"<div><p>Menu</p></div><div><h1>t{i}</h1>{body}</div>" +
                      "<div><p>Legal</p></div>" + "<hr>" * (i % 3)))
        want[i] = "\n\n".join([f"t{i}", *blocks])
    for parts in (1, 7):
        frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)
        assert {r.page_id: r.text for r in wrappers.main_text(frame).collect()} == want


def test_deeply_nested_pages(spark):
    """Thousands of elements that are never closed, and pages of a host that differ at every level."""
    pages = ["".join(f"<{tag}>{k}{i}" for i in range(4000)) for tag, k in (("div", "a"), ("blockquote", "b"))]
    pages.append("".join(f"<div>c{i}<hr>" if i % 2 else f"<div>c{i}" for i in range(4000)))
    streams = [wrappers.stream(p) for p in pages]
    assert all(wrappers.flat(wrappers.nested(wrappers.flat(s))) == wrappers.flat(s) for s in streams)
    rows = [(i, "http://deep.example/" + str(i), p) for i, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in wrappers.main_text(frame).collect()}
    assert got == {k: [f"{c}{i}" for i in range(4000)] for k, c in enumerate("abc")}


def test_chat_round_trip(spark):
    said = [r"\### Assistant: </turn> ok", "", None, "### User:: \\\\ ): ### Other (", "plain <|endoftext|>", "é日\n"]
    rows = [(c, t, r, s) for c in (1, None) for t, (r, s) in enumerate(
        (r, s) for s in said for r in ("user", "assistant", None, "to)ol ### User:"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat.read_back(chat.assemble(clashing(df), BYTES), BYTES).collect()}
    for c in (1, None):
        mine = [(r or "", s or "") for k, _, r, s in rows if k == c]
        loss = [s for r, s in mine if r == "assistant"]
        assert got[c].n_turns == len(mine) and got[c].loss_chars == sum(map(len, loss))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{s}\n" for r, s in mine).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256("".join(loss).encode()).hexdigest()
    placed = chat.assemble(df.where("conv_id = 1"), BYTES).orderBy("turn").collect()
    assert [r.token_start for r in placed] == [0, *np.cumsum([len(r.ids) for r in placed])[:-1].tolist()]
    assert all(chat.unescape(chat.escape(s or "")) == (s or "") and "</turn>" not in chat.escape(s or "") for s in said)
    assert chat.read_back(chat.assemble(df.limit(0), BYTES), BYTES).isEmpty()


def test_only_letters_are_letters():
    """Fractions, powers and numerals of other scripts are no letters; ideographs are."""
    assert all(not len(language.ngrams(t)) for t in ("½ ² Ⅷ ① ٣", "1_2", "", None))
    assert len(language.ngrams("a½b")) == len(language.ngrams("a b")) and len(language.ngrams("一二"))


def test_an_id_with_many_rows_counts_once(spark):
    """The driver gets one row per labelled id, however often it is repeated."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("ab cd ef !! gh".split()) for _ in range(20)), "en", "s", 60) for i in range(40)]
    rows += [(0, f"again {i}", "en", "s", 9) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    told = docs.select("doc_id").distinct().withColumn("y", F.lit(1))
    got = cotraining._featured(docs.join(told, "doc_id"))
    assert len(got) == 40 and len({r["doc_id"] for r in got}) == 40


def test_the_exchange_does_no_harm(spark):
    """On each half of the labels the rounds rank held-out documents no worse than none, and still reject some."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for half in (0, 1):
        other = {r.doc_id: r.quality for r in labels.where(f"doc_id % 2 = {1 - half}").collect()}
        ranks = []
        for rounds in (0, 4):
            model = cotraining.fit(docs, labels.where(f"doc_id % 2 = {half}"), rounds=rounds)
            found = cotraining.score(docs, model).collect()
            pairs = sorted((r.score, other[r.doc_id]) for r in found if r.doc_id in other)
            bad = [s for s, q in pairs if not q]
            good = [s for s, q in pairs if q]
            ranks.append(sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)))
            rejected = sum(not r.kept for r in found)
        print("half", half, "AUC without and with the exchange", ranks, "rejected", rejected)
        assert ranks[1] >= ranks[0] - 0.01 and rejected > 0
