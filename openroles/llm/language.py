"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1, made from its code point.
An n-gram vector binds (multiplies) the vectors of its letters, each permuted by
its place, so that order counts. A document's vector bundles (adds) the vectors
of its n-grams, and a language's prototype bundles the vectors of its
documents, each scaled to length 1. A document gets the language whose
prototype is nearest by cosine.

Words are runs of letters, lower-cased, with a blank at both ends; n is 3.
Learning adds up one vector per language and task and sums them by (language,
place) in Spark, so a language that holds any share of the rows costs the same,
and the driver gets one vector per language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0.
Equal cosines go to the language that sorts first. Rows without a language are
not learnt from. With nothing to learn from all are ``und``. Language, source
and ids never enter a prediction.
"""

from __future__ import annotations

import re
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from openroles.llm.common import bound_batches, only, slices, worker_store

PLACES = 1024
UNKNOWN = "und"
#: A document whose best cosine is below this is rejected by :func:`keep`.
LEAST_SCORE = 0.05
#: N-gram vectors that are made at a time, and n-gram codes that a worker remembers.
BLOCK = 2048

_BLANK = 32


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 for each code point, the same in every process."""
    out = np.empty((len(codes), PLACES), np.float32)
    for i, code in enumerate(codes.tolist()):
        bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, PLACES, np.int8)
        out[i] = 2.0 * bits - 1.0
    return out


def ngrams(text: str | None) -> np.ndarray:
    """Codes of the letter trigrams of a text, with repeats; empty without a letter.

    Code points fit in 21 bits, so three of them are one 64-bit number.
    """
    words = re.findall(r"[^\W\d_]+", text.lower()) if text else []
    if not all(map(str.isalpha, words)):  # digits of other kinds, such as fractions, are word characters, too
        words = "".join(c if c.isalpha() else " " for w in words for c in (*w, " ")).split()
    if not words:
        return np.zeros(0, np.int64)
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    return ((a << 42) | (b << 21) | c)[b != _BLANK]


def ngram_vectors(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of n-gram codes: the letters' vectors, rotated by place, multiplied."""
    letters = np.stack([(grams >> 42), (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF])
    codes, at = np.unique(letters, return_inverse=True)
    store = worker_store().setdefault("letters", {})
    for code in codes.tolist():
        if code not in store:
            if len(store) > 8192:
                store.clear()
            store[code] = letter_vectors(np.array([code]))[0]
    table = np.stack([store[c] for c in codes.tolist()])
    at = at.reshape(letters.shape)
    return np.roll(table, 2, 1)[at[0]] * np.roll(table, 1, 1)[at[1]] * table[at[2]]


def document_vectors(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vectors scaled to length 1 (0 without letters), and which texts have letters."""
    grams = [ngrams(t) for t in texts]
    sizes = np.array([len(g) for g in grams])
    out = np.zeros((len(texts), PLACES), np.float32)
    if sizes.sum():
        rows = np.repeat(np.arange(len(texts)), sizes)
        distinct, at = np.unique(np.concatenate(grams), return_inverse=True)
        for start in range(0, len(distinct), BLOCK):
            part = distinct[start:start + BLOCK]
            here = (at >= start) & (at < start + len(part))
            spots = rows[here] * len(part) + (at[here] - start)
            counts = np.bincount(spots, minlength=len(texts) * len(part)).reshape(len(texts), len(part))
            out += counts.astype(np.float32) @ ngram_vectors(part)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1), sizes > 0


def held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows that learning leaves out, by a checksum of the key in decimals."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototype vectors by language, from every row with a language."""
    rows = only(df, text, lang).toDF("text", "lang").where("lang is not null")

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, 1 << 19):
            vectors, _ = document_vectors(batch.column(0).to_pylist())
            langs = np.array(batch.column(1).to_pylist(), object)
            for name in set(langs):
                found = vectors[langs == name].sum(0, dtype=np.float64)
                sums[name] = sums[name] + found if name in sums else found
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([v.tolist()], pa.list_(pa.float64()))],
                                             names=["lang", "v"])

    sums = (rows.mapInArrow(bundle, "lang string, v array<double>")
            .select("lang", F.posexplode("v").alias("place", "x"))
            .groupBy("lang", "place").agg(F.sum("x").alias("x")).collect())
    out: dict[str, np.ndarray] = {}
    for r in sums:
        out.setdefault(r["lang"], np.zeros(PLACES))[r["place"]] = r["x"]
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(out.items()) if v.any()}


def _nearest(prototypes: dict[str, np.ndarray]):
    names = list(prototypes)
    matrix = np.stack([prototypes[n] for n in names]).T if names else np.zeros((PLACES, 0), np.float32)

    def predict(texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        vectors, lettered = document_vectors(texts)
        if not names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosine = np.round(vectors @ matrix, 5)
        best = cosine.argmax(1)
        score = np.where(lettered, cosine.max(1), 0).clip(0, 1).astype(float)
        return [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], score

    return predict


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], keys: Sequence[str] = ("doc_id",),
             text: str = "text") -> DataFrame:
    """``keys``, ``lang_pred`` and ``score`` (cosine, 0 to 1) of every row."""
    rows = only(df, *keys, text)
    out = T.StructType(rows.schema.fields[:-1]).add("lang_pred", "string").add("score", "double")
    predict = _nearest(prototypes)

    def run(batches):
        for batch in slices(batches, 1 << 19):
            langs, score = predict(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(score)], names=out.names)

    return rows.mapInArrow(run, out)


def keep(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text",
         least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``df``, all columns, whose language is known with a score of at least ``least``."""
    bound_batches(df.sparkSession)
    at, predict = df.columns.index(text), _nearest(prototypes)

    def run(batches):
        for batch in slices(batches, 1 << 19):
            langs, score = predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(langs, score)], pa.bool_()))

    return df.mapInArrow(run, df.schema)
