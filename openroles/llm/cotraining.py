"""Quality classifier by co-training of two views.

The text view sees measurements of the text's content; the metadata view sees
source, language and length. Both are logistic regressions. In each round a
view labels the unlabelled rows of the training pool it is surest of, and these
pseudo-labels are added to what the other view learns from. Afterwards each
view is calibrated on labelled rows that took no part in training (Platt
scaling), and the calibrated log-odds are added, each weighted by how well the
view did there, to score all documents.

Fitting reads at most ``MOST_LABELLED`` labelled and ``MOST_POOL`` unlabelled
rows, chosen by a hash of the id, and nothing else is limited: every document
is scored, from its whole text.

Defined cases: a null text counts as empty, null metadata as a value of their
own. Labels for missing documents and null labels are ignored; several labels
of one document are averaged and rounded up. With no labels, or labels of one
kind only, every score is the share of good labels (0.5 without any).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from openroles.llm.common import only, slices

MOST_LABELLED, MOST_POOL = 10_000, 10_000
ROUNDS, TAUGHT_SHARE, SURE = 4, 0.1, 0.9
KEEP_FROM = 0.5
BUCKETS = 64
MARKS = "#*$%&|<>!?.,;:"


def content_features(text: str | None) -> list[float]:
    """Measurements of the content: word shapes, repetition, marks, letter case."""
    t = text or ""
    words = t.split()
    n, chars = len(words), max(1, len(t))
    lines = [x for x in t.split("\n") if x.strip()]
    letters = max(1, sum(map(str.isalpha, t)) if not t.isascii() else len(re.findall(r"[A-Za-z]", t)))
    upper = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", t))
    distinct = len(set(words))
    windows = len(set(zip(words, words[1:], words[2:])))
    ends = sum(w[-1] in ".!?" for w in words)
    return [np.log1p(n), np.log1p(chars / max(1, n)), distinct / max(1, n),
            windows / max(1, n - 2), len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
            upper / letters, letters / chars, ends / max(1, n),
            *[min(1.0, 10 * t.count(m) / chars) for m in MARKS]]


def page_features(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """Metadata of the page: hashed source and language, and its length."""
    out = [0.0] * (2 * BUCKETS + 3)
    out[crc32(f"source={source}".encode()) % BUCKETS] = 1.0
    out[BUCKETS + crc32(f"lang={lang}".encode()) % BUCKETS] = 1.0
    size = np.log1p(max(0, n_chars or 0)) / 10
    out[-3:] = [size, size * size, float(n_chars is None)]
    return out


@dataclass
class Logistic:
    """Logistic regression on scaled features, with balanced kinds."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 0.01) -> "Logistic":
        mean, spread = x.mean(0), x.std(0)
        spread = np.where(spread > 1e-6, spread, 1)
        z = np.c_[(x - mean) / spread, np.ones(len(x))]
        share = weight * np.where(y == 1, 0.5 / max(1e-9, weight[y == 1].sum()),
                                  0.5 / max(1e-9, weight[y == 0].sum()))
        w = np.zeros(z.shape[1])
        ridge = np.full(len(w), decay)
        ridge[-1] = 1e-9
        for _ in range(25):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (share * (p - y)) + ridge * w
            curve = (z * (share * p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
            step = np.linalg.solve(curve, slope)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return Logistic(mean, spread, w)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.c_[(x - self.mean) / self.spread, np.ones(len(x))] @ self.weights, -8, 8)


@dataclass
class Model:
    """The two fitted views, their calibration (slope, offset) and weights; or a constant."""

    constant: float | None
    text: Logistic | None = None
    page: Logistic | None = None
    calibration: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.0

    def scores(self, content: np.ndarray, page: np.ndarray) -> np.ndarray:
        """Columns: the combined score, the text view's and the metadata view's probability."""
        if self.constant is not None:
            return np.full((len(content), 3), self.constant)
        odds = np.c_[self.text.odds(content), self.page.odds(page)]
        odds = np.clip(odds * self.calibration[:, 0] + self.calibration[:, 1], -30, 30)
        both = self.prior + (odds - self.prior) @ self.weights
        return 1 / (1 + np.exp(-np.clip(np.c_[both, odds], -30, 30)))


def _platt(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn odds into calibrated ones, by damped Newton steps."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * odds + b, -30, 30)))
        g, h = p - target, p * (1 - p) + 1e-6
        m = np.array([[(h * odds * odds).sum() + 0.1, (h * odds).sum()], [(h * odds).sum(), h.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(m, [(g * odds).sum(), g.sum()]), -0.5, 0.5)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 0.0), b


def _features(rows) -> tuple[np.ndarray, np.ndarray]:
    return (np.array([content_features(r["text"]) for r in rows], float).reshape(len(rows), -1),
            np.array([page_features(r["source"], r["lang"], r["n_chars"]) for r in rows], float).reshape(len(rows), -1))


FEATURES = "doc_id bigint, y int, content array<double>, page array<double>"


def _featured(rows: DataFrame) -> list:
    """Feature rows of a bounded training table, one per id; the texts stay in the tasks.

    Of repeated rows of an id the one of the smallest hash counts, so an id with
    many rows neither fills the driver nor outweighs the others.
    """
    def run(batches):
        for batch in slices(batches):
            found = batch.to_pylist()
            content, page = _features(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(content.tolist(), pa.list_(pa.float64())),
                 pa.array(page.tolist(), pa.list_(pa.float64()))], names=["doc_id", "y", "content", "page"])

    read = ("text", "source", "lang", "n_chars")
    single = rows.groupBy("doc_id", "y").agg(F.min_by(F.struct(*read), F.xxhash64(*read)).alias("r"))
    got = single.select("doc_id", "y", *[f"r.{c}" for c in read]).mapInArrow(run, FEATURES)
    return sorted(got.collect(), key=lambda r: (r["doc_id"], r["content"]))


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, most_pool: int = MOST_POOL,
        rounds: int = ROUNDS) -> Model:
    """A model from bounded samples; see the module's text."""
    rows = only(docs, "doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id").cast("long"))
    good = (only(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    by_hash = F.xxhash64(F.col("doc_id"), F.lit(17))
    chosen = good.orderBy(by_hash, "doc_id").limit(most_labelled)
    labelled = _featured(rows.join(F.broadcast(chosen), "doc_id"))  # at most most_labelled narrow rows
    ids = only(rows, "doc_id").where("doc_id is not null").distinct().join(good.select("doc_id"), "doc_id", "left_anti")
    pool_ids = ids.orderBy(by_hash, "doc_id").limit(most_pool)
    y = np.array([r["y"] for r in labelled], int)
    if len(y) == 0 or y.min() == y.max():
        return Model(constant=float(y.mean()) if len(y) else 0.5)
    pool = _featured(rows.join(F.broadcast(pool_ids.withColumn("y", F.lit(None).cast("int"))), "doc_id"))
    content, page = (np.array([r[k] for r in labelled]) for k in ("content", "page"))
    aside = np.array([crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in labelled])
    if min(np.bincount(y[aside], minlength=2).min(), np.bincount(y[~aside], minlength=2).min()) < 2:
        aside = np.zeros(len(y), bool)
    train, test = ~aside, aside if aside.any() else ~aside
    free = [np.array([r[k] for r in pool]).reshape(len(pool), -1) for k in ("content", "page")]
    views = [content[train], page[train]]
    learnt = [(y[train].astype(float), np.ones(train.sum())) for _ in views]  # labels and weights by view
    extra: list[dict[int, int]] = [{}, {}]  # pseudo-labels that each view was taught, by pool row

    def fitted(v: int) -> Logistic:
        x, (labels_, w) = views[v], learnt[v]
        if extra[v]:
            at = np.fromiter(extra[v], int)
            x = np.concatenate([x, free[v][at]])
            labels_ = np.r_[labels_, [extra[v][i] for i in at]]
            w = np.r_[w, np.full(len(at), 0.5)]
        return Logistic.fit(x, labels_, w)

    def judged(v: int, m: Logistic) -> tuple[float, tuple[float, float]]:
        """Calibrated loss on the rows put aside, and the calibration."""
        odds = m.odds((content, page)[v][test])
        a, b = _platt(odds, y[test])
        p = np.clip(1 / (1 + np.exp(-np.clip(a * odds + b, -30, 30))), 1e-6, 1 - 1e-6)
        return float(-(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).mean()), (a, b)

    model = [fitted(0), fitted(1)]
    for _ in range(rounds if len(pool) else 0):
        taught: list[dict[int, int]] = [{}, {}]  # anew in each round, so that labels are revised
        for v, other in ((0, 1), (1, 0)):
            p = 1 / (1 + np.exp(-model[v].odds(free[v])))
            for kind, sure in ((1, p), (0, 1 - p)):
                share = (y[train] == kind).mean()
                most = int(TAUGHT_SHARE * share * len(pool)) + 1
                for i in np.argsort(-sure, kind="stable")[:most]:
                    if sure[i] >= SURE:
                        taught[other].setdefault(int(i), kind)
        for v in (0, 1):  # a view takes what it is taught only if the rows put aside say it gains
            before, extra[v] = extra[v], taught[v]
            tried = fitted(v)
            if judged(v, tried)[0] < judged(v, model[v])[0]:
                model[v] = tried
            else:
                extra[v] = before

    calibration, weights, prior = [], [], float(np.log((y[test].sum() + 1) / ((1 - y[test]).sum() + 1)))
    base = np.clip(y[test].mean(), 1e-6, 1 - 1e-6)
    plain = -(base * np.log(base) + (1 - base) * np.log(1 - base))
    for v in (0, 1):
        loss, scale = judged(v, model[v])
        calibration.append(scale)
        weights.append(float(np.clip(1 - loss / plain, 0, 1)))
    return Model(None, model[0], model[1], np.array(calibration), np.array(weights), prior)


def score(docs: DataFrame, model: Model, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys``, ``score``, the calibrated ``text_view`` and ``page_view``, and ``kept`` of every document."""
    rows = docs.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
                       *[F.col(f"`{c}`") for c in ("text", "source", "lang", "n_chars")])
    out = T.StructType([T.StructField(k, f.dataType) for k, f in zip(keys, rows.schema.fields)])
    for name in ("score", "text_view", "page_view"):
        out = out.add(name, "double")
    out = out.add("kept", "boolean")

    def run(batches):
        for batch in slices(batches, 1 << 20):
            found = model.scores(*_features(batch.select(["text", "source", "lang", "n_chars"]).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keys)], *[pa.array(found[:, i].astype(float)) for i in range(3)],
                 pa.array(found[:, 0] >= KEEP_FROM)], names=out.names)

    return rows.mapInArrow(run, out)
