"""The registered queries of this subpackage, on whole tables, and their SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openroles.llm import (alignment, audit, chat, cotraining, fingerprints, jaccard, language, packing,
                           quality_rules, sentencepieces, substrings, urls, wrappers)
from openroles.llm.common import table

#: Host, path and verdict of the URL rules.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), digest=sentencepieces.digests,
                                 digest_schema=sentencepieces.DIGEST)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = spark.createDataFrame(urls.small_labelled_table(), "url string, blocked int")
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, urls.fit(labelled))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents"), "doc_id"))
    base = quality_rules.fails(quality_rules.mask_of(quality_rules.BASE))
    return judged.withColumn("base_failed", base).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed", "policy")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language.held_out(F.col("doc_id"))
    prototypes = language.learn(docs.where(~held))
    found = language.identify(docs, prototypes)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.score(docs, cotraining.fit(docs, table(spark, sf_dir, "labels")))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_neighbours(table(spark, sf_dir, "documents"))
    own = F.col("fingerprint")
    near = rows.withColumns({"near_edited": fingerprints.resemblance(own, F.col("edited_fingerprint")),
                             "near_next": fingerprints.resemblance(own, F.col("next_fingerprint")),
                             "n_chars": F.char_length("text").cast("long"),
                             "edited_sha256": F.sha2("edited", 256)})
    return near.select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next",
                       *[fingerprints.as_text(F.col(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")])


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.place(digest)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    rows = told.select("conv_id", "turn", "role", "text").union(extra)
    path = tokenizer_file("byte_bpe_50k.json")
    return chat.read_back(chat.assemble(rows, path), path)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                           tokenizer_file("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece, op2_url_filter, op3_quality_rules, op4_language, op5_quality_classifier,
                            op6_fingerprints, op7_packing, op8_html_extraction, op9_chat_format, op10_jaccard_join,
                            op11_substring_dedup, op12_token_alignment, op13_filter_audit)}
_WORDS = r"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

SQL: dict[str, str] = {
    "op3_quality_rules": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, """ + _WORDS.format(text="text") + r""" AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda s: regexp_matches(s, '[^ 	-
]')) AS l
           FROM documents),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
            FROM t, unnest(range(1, len(w) - 1)) AS u(i)),
again AS (SELECT doc_id, k FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + d) AS n
            FROM windows JOIN again USING (doc_id, k), unnest([0, 1, 2]) AS v(d) GROUP BY doc_id),
m AS (SELECT t.doc_id, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[ 	-
]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
             length(regexp_replace(text, '[^!]+', '', 'g')) AS n_marks,
             length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS n_upper,
             length(regexp_replace(text, '\P{L}+', '', 'g')) AS n_letters
      FROM t LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
                 + 4 * (20 * n_symbols > word_chars)::INT
                 + 8 * (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT
                 + 16 * (n_letters >= 20 AND 100 * n_upper > 40 * n_letters)::INT
                 + 32 * (100 * n_marks > 30 * n_words)::INT + 64 * (word_chars > 25 * n_words)::INT
                 + 128 * (word_chars < 2 * n_words)::INT)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed = 0 AS kept, failed, 'v3' AS policy FROM f""",
    "op9_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(regexp_replace(text, '(\\|### Assistant:|### System:|### Other \(|### User:|</turn>|\):)', '+\1', 'g')) AS n,
             CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role) + 6
                  ELSE length(regexp_replace(role, '(\\|### Assistant:|### System:|### Other \(|### User:|</turn>|\):)', '+\1', 'g')) + 14 END
             AS front FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(front + n + 9)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op10_jaccard_join": r"""
WITH RECURSIVE t AS (SELECT doc_id, """ + _WORDS.format(
        text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + r""" AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
             FROM t, unnest(range(1, greatest(2, len(w) - 3))) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s)
          WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(node, low) AS (SELECT x, x FROM both_ways
                     UNION SELECT b.y, r.low FROM reach r JOIN both_ways b ON b.x = r.node AND r.low < b.y),
lowest AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, t.doc_id) AS component_id
FROM t LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON node = t.doc_id""",
    "op11_substring_dedup": r"""
WITH t AS (SELECT doc_id, """ + _WORDS.format(text="text") + r""" AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM t, unnest(range(1, len(w) - 11)) AS u(i)),
hit AS (SELECT doc_id, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY k)),
covered AS (SELECT DISTINCT doc_id, i + d AS i, true AS gone FROM hit, unnest(range(0, 13)) AS v(d)),
words AS (SELECT doc_id, i, w[i] AS word FROM t, unnest(range(1, len(w) + 1)) AS u(i)),
kept AS (SELECT doc_id, count(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone IS NULL) AS k
         FROM words LEFT JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)""",
    "op13_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, """ + _WORDS.format(text="text") + r""" AS w FROM t),
facts AS (SELECT w.doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
                 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) AS c,
                 regexp_matches(text, '[#$%&*|]') AS d,
                 coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e FROM w),
told AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, ['A', 'B', 'C', 'D', 'E'] AS names, [a, b, c, d, e] AS fails, coalesce(good, false) AS good,
             coalesce(toxic, false) AS toxic, count(*) AS n
      FROM facts LEFT JOIN told USING (doc_id) GROUP BY ALL),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order
           FROM l p JOIN l q ON q.x <> p.x JOIN l r ON r.x NOT IN (p.x, q.x) JOIN l s ON s.x NOT IN (p.x, q.x, r.x)
           JOIN l u ON u.x NOT IN (p.x, q.x, r.x, s.x)),
steps AS (SELECT filter_order, i::INT AS step, filter_order[i] AS name FROM orders, unnest(range(1, 6)) AS v(i)),
hit AS (SELECT m.*, filter_order, step, name, fails[ascii(name) - 64] AS fail,
               coalesce(list_bool_or(list_transform(range(1, step), lambda i: fails[ascii(filter_order[i]) - 64])), false) AS gone,
               len(list_filter(fails, lambda f: f)) AS n_fails FROM m, steps),
found AS (SELECT part, filter_order, step, name,
                 sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END)::BIGINT AS kept,
                 sum(CASE WHEN NOT gone AND fail THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN gone AND fail THEN n ELSE 0 END)::BIGINT AS redundant,
                 sum(CASE WHEN fail AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN NOT gone AND fail AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
                 sum(CASE WHEN NOT gone AND fail AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
          FROM hit GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, name))::BIGINT AS shapley FROM found""",
}
