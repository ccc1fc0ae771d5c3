"""How filters interact: what each one removes in every order in which they can run.

Method: wide packed counters. The filters that a document fails, with its two
labels, make a mask of seven bits. Every mask stands for one big integer whose
64-bit fields hold what happens to such a document at each of the 600 pairs of
an order and a step: six fields a pair (kept, removed, redundant, failing this
filter only, removed though good, removed though toxic). The integers of all
documents of a part are added up: in each task, then over salted groups of
tasks, then per part. A field counts documents, so it stays below 2^63 and never
carries into the next one; at the end the sum is cut into its fields again.

A document fails "identical" when a smaller id has its text anywhere in the
table. The smallest id of each text comes from partial minima by digest, and
rows meet it by (id, digest), so a text that a third of the table shares has no
group of its own.

Defined cases: a null text is empty. A null part is the empty string. Rows with
a null id have no labels, fail no "identical" and cause none. Repeated rows are
counted each; equal ids never make each other fail "identical". Of several
label rows of an id, one with the value 1 is enough; null labels are 0. An empty
table gives no row. Other columns of any name are not read.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles.llm.common import only, slices, worker_store

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
STEPS = [(order, step) for order in ORDERS for step in range(len(FILTERS))]
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bits of a mask beyond those of the filters.
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
#: Bytes of a field; it counts documents, of which there are fewer than 2^63.
FIELD = 8
WIDTH = FIELD * len(OUTCOMES) * len(STEPS)
#: Parts that a task holds sums of; with more it sends what it has and begins anew.
HELD_PARTS = 256
#: Partial sums of a part meet in this many groups before they meet in one.
SALTS = 32

FEWEST_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKED = re.compile(rb"[#$%&*|]")
_CONTINUATION = bytes(range(0x80, 0xC0))


def text_mask(text: bytes) -> int:
    """The filters A to D that a text fails; words are parted by space and tab to carriage return."""
    words = text.split()
    n = len(words)
    # Bytes that continue a character are left out of the number of code points.
    points = len(text.translate(None, _CONTINUATION))
    return ((n < FEWEST_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
            | (100 * (len(text) - len(text.translate(None, _UPPER))) > UPPER_PERCENT * points) << 2
            | (_MARKED.search(text) is not None) << 3)


def outcomes(mask: int) -> np.ndarray:
    """The fields of a mask: for each of :data:`STEPS`, one 0 or 1 per outcome."""
    out = np.zeros((len(STEPS), len(OUTCOMES)), "<u8")
    failing = mask & (GOOD - 1)
    for row, (order, step) in zip(out, STEPS):
        fails = [failing >> FILTERS.index(f) & 1 for f in order]
        gone = any(fails[:step])
        removed = fails[step] and not gone
        row[:] = (not any(fails[:step + 1]), removed, fails[step] and gone,
                  failing == 1 << FILTERS.index(order[step]),
                  removed and mask & GOOD != 0, removed and mask & TOXIC != 0)
    return out


def wide_integers() -> list[int]:
    """The big integer of every mask, kept by each worker."""
    held = worker_store()
    if "audit integers" not in held:
        held["audit integers"] = [int.from_bytes(outcomes(m).tobytes(), "little") for m in range(4 * GOOD)]
    return held["audit integers"]


def masks(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``key``, ``part``, ``digest`` of the text and the ``mask`` of filters A to D, for each row."""
    kept = only(df, key, part, text).select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in slices(batches):
            texts = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([text_mask(t) for t in texts], pa.int32())], ["key", "part", "digest", "mask"])

    return kept.mapInArrow(run, f"key {df.schema[key].dataType.simpleString()}, part string, digest binary, mask int")


def labelled_masks(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   part: str = "lang") -> DataFrame:
    """``part``, full ``mask`` and number of rows ``n``, for each id and text."""
    rows = masks(df, key, text, part).groupBy("key", "part", "digest", "mask").agg(F.count("*").alias("n"))
    first = rows.where(F.col("key").isNotNull()).groupBy("digest").agg(F.min("key").alias("key"))
    told = only(labels, key, "quality", "toxic").where(F.col(f"`{key}`").isNotNull()).groupBy(
        F.col(f"`{key}`").alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = (rows.where(F.col("key").isNotNull())
             .join(first.withColumn("first", F.lit(1)), ["key", "digest"], "left").join(told, "key", "left"))
    full = (F.col("mask") + F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
            + GOOD * F.coalesce("good", F.lit(0)) + TOXIC * F.coalesce("toxic", F.lit(0)))
    nameless = rows.where(F.col("key").isNull()).select("part", "mask", "n")
    return known.select("part", full.alias("mask"), "n").union(nameless)


PACKED = "part string, salt int, packed binary"


def _sums(entries):
    """Adds up (part, salt, integer); yields batches of sums whenever many parts are held."""
    held: dict[tuple[str, int], int] = {}

    def batch():
        keys = list(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in keys], pa.string()), pa.array([s for _, s in keys], pa.int32()),
             pa.array([held[k].to_bytes(WIDTH, "little") for k in keys], pa.binary())], ["part", "salt", "packed"])

    for part, salt, value in entries:
        held[part, salt] = held.get((part, salt), 0) + value
        if len(held) > HELD_PARTS:
            yield batch()
            held.clear()
    if held:
        yield batch()


def packed_sums(rows: DataFrame) -> DataFrame:
    """The summed integer of each part, from ``part``, ``mask`` and ``n``."""
    def add(batches):
        from pyspark import TaskContext

        integers, salt = wide_integers(), TaskContext.get().partitionId() % SALTS
        yield from _sums((part, salt, n * integers[mask]) for batch in batches
                         for part, mask, n in zip(*(c.to_pylist() for c in batch.columns)))

    def merge(keep_salt: bool):
        def run(batches):
            yield from _sums((part, salt if keep_salt else 0, int.from_bytes(packed, "little")) for batch in batches
                             for part, salt, packed in zip(*(c.to_pylist() for c in batch.columns)))
        return run

    salted = rows.select("part", "mask", "n").mapInArrow(add, PACKED).repartition("part", "salt").sortWithinPartitions("part", "salt")
    return (salted.mapInArrow(merge(True), PACKED).repartition("part").sortWithinPartitions("part")
            .mapInArrow(merge(False), PACKED))


RESULT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def unpacked(sums: DataFrame) -> DataFrame:
    """One row per part, order and step from the fields of the summed integers.

    A part may come in more than one sum (a task with very many parts sends what it holds); rows are added up.
    """
    def run(batches):
        orders = pa.array([o for o, _ in STEPS], pa.string())
        steps = pa.array([s + 1 for _, s in STEPS], pa.int32())
        applied = np.array([FILTERS.index(o[s]) for o, s in STEPS])
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                fields = np.frombuffer(packed, "<u8").reshape(len(STEPS), len(OUTCOMES)).astype(np.int64)
                removed = np.zeros(len(FILTERS), np.int64)
                np.add.at(removed, applied, fields[:, OUTCOMES.index("removed")])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(STEPS), pa.string()), orders, steps,
                     *[pa.array(fields[:, i]) for i in range(len(OUTCOMES))], pa.array(removed[applied])],
                    ["part", "filter_order", "step", *OUTCOMES, "shapley"])

    rows = sums.mapInArrow(run, RESULT)
    return rows.groupBy("part", "filter_order", "step").agg(*[F.sum(c).alias(c) for c in (*OUTCOMES, "shapley")])


def interactions(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                 part: str = "lang") -> DataFrame:
    """What the five filters do in each of their 120 orders, per part."""
    return unpacked(packed_sums(labelled_masks(df, labels, key, text, part)))
