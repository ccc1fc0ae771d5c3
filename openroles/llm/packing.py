"""Packing pieces into sequences of a fixed length by minimum bin slack.

For each bin the longest remaining length is the seed, and a subset-sum dynamic
programme over the available lengths (a bitset of reachable sums, counts split
into powers of two) finds the fullest feasible combination with it, preferring
long lengths. The combination is removed as often as the counts allow at once.

Pieces of one length can stand for each other, so the programme runs on the
histogram of lengths: at most ``capacity`` rows reach the driver, for any
number of pieces. Its plan says which combination the r-th piece of a length
goes to. Spark gives each piece its rank: tasks number the pieces they write
per length, and sums of the tasks' counts say how many came before.

Defined cases: a null text is an empty one and still a piece of one token, its
end mark. Repeated rows are packed each on their own. A row whose length is
null, below 1 or above the capacity gets no place (nulls).
"""

from __future__ import annotations

import json
import re
from functools import cached_property
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from openroles.llm.common import bound_batches, fresh, only, slices, worker_store, written

CAPACITY = 2048
END_ID = 0
#: How byte-level vocabularies split texts before merging (fixed by the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RANK_BITS = 44


class ByteTokenizer:
    """Ids of whole texts from a byte-level BPE file of the tokenizers library.

    Texts of common characters without an added token's text are encoded by the
    tiktoken library, whose ranks are made from the same file and which gives
    the same ids in a quarter of the time. All others go to tokenizers itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, added = held["model"], {t["content"] for t in held["added_tokens"]}
        byte_of = byte_characters()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("merges are not in the order of their ids")
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile("|".join(["[^\x00-\u024f\u2010-\u2027\u20ac]", *map(re.escape, added)]))

    @cached_property
    def library(self):
        """The tokenizers library with this file, loaded by the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        out = [None if self.other.search(t) else self.fast.encode_to_numpy(t, disallowed_special=()) for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        found = self.library.encode_batch([texts[i] for i in rest], add_special_tokens=False) if rest else []
        for i, e in zip(rest, found):
            out[i] = np.array(e.ids, np.uint32)
        return out


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the others in order for
    the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokenizer(path: str) -> ByteTokenizer:
    loaded = worker_store()
    if ("bytes", path) not in loaded:
        loaded["bytes", path] = ByteTokenizer(path)
    return loaded["bytes", path]


def pieces(df: DataFrame, path: str, keys: Sequence[str] = ("doc_id",), text: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """``keys``, piece, start, length and ``ids`` (little-endian unsigned 32-bit) per piece.

    A text's ids end with id 0. Longer ones are cut so that only the first piece
    is shorter than ``capacity``. Keys that have one of these names keep it; the
    new column then begins with an underscore.
    """
    rows = only(df, *keys, text)
    out, named = T.StructType(rows.schema.fields[:-1]), only(df, *keys)
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids", "binary")):
        out = out.add(fresh(named, name), kind)
    n_keys = len(keys)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = tokenizer(path)
        for batch in slices(batches, 1 << 20):
            at, piece, start, length, ids = [], [], [], [], []
            encoded = words.encode([t or "" for t in batch.column(n_keys).to_pylist()])
            for row, found in enumerate(encoded):
                found = np.append(found, np.uint32(END_ID)).astype("<u4")
                first = len(found) % capacity or capacity
                cuts = [0, *range(first, len(found) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    at.append(row), piece.append(k), start.append(a), length.append(b - a)
                    ids.append(found[a:b].tobytes())
            own = batch.select(range(n_keys)).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=out.names)

    return rows.mapInArrow(run, out)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how often each is used, with the largest sum of at most ``room``."""
    everything, reached, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, chunk = min(counts[length], room // length), 1
        while left > 0:
            chunk = min(chunk, left)
            steps.append((length, chunk, reached))
            reached |= (reached << (chunk * length)) & everything
            left, chunk = left - chunk, chunk * 2
        if reached >> room & 1:
            break
    total, used = reached.bit_length() - 1, {}
    for length, chunk, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + chunk
            total -= chunk * length
    return used


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination, number of bins) pairs that use up the histogram."""
    counts = {k: n for k, n in histogram.items() if n > 0}
    out = []
    while counts:
        seed = max(counts)
        rest = {**counts, seed: counts[seed] - 1}
        used = fullest({k: n for k, n in rest.items() if n}, capacity - seed)
        used[seed] = used.get(seed, 0) + 1
        times = min(counts[k] // n for k, n in used.items())
        for k, n in used.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
        out.append((used, times))
    return out


def _places(combinations: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length and first rank in one number, first rank, uses, first bin, offset), sorted."""
    next_rank: dict[int, int] = {}
    rows, first_bin = [], 0
    for used, times in combinations:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            r = next_rank.get(length, 0)
            rows.append((length << _RANK_BITS | r, r, n, first_bin, offset))
            next_rank[length] = r + n * times
            offset += n * length
        first_bin += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(df: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset`` (fresh names if it has such columns)."""
    bound_batches(df.sparkSession)
    part, nth, before, own_length, own_part = (fresh(df, n) for n in ("_part", "_nth", "_before", "_l", "_p"))
    sequence, offset = fresh(df, "sequence_id"), fresh(df, "offset")
    at = df.columns.index(length)
    numbered_schema = T.StructType([*df.schema.fields, T.StructField(part, T.IntegerType()),
                                    T.StructField(nth, T.LongType())])

    def number(batches):
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            raw = batch.column(at).cast(pa.int64()).to_numpy(zero_copy_only=False)
            known = np.nan_to_num(raw.astype(float), nan=0)
            sizes = np.where((known >= 1) & (known <= capacity), known, 0).astype(np.int64)
            order = np.argsort(sizes, kind="stable")
            ordered = sizes[order]
            starts = np.r_[0, np.flatnonzero(np.diff(ordered)) + 1] if len(ordered) else np.zeros(0, int)
            runs = np.diff(np.r_[starts, len(ordered)])
            rank = np.empty(len(sizes), np.int64)
            rank[order] = np.arange(len(ordered)) - np.repeat(starts, runs) + seen[ordered]
            np.add.at(seen, sizes, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sizes), task, np.int32)),
                                              pa.array(rank)], names=numbered_schema.names)

    numbered = written(df.mapInArrow(number, numbered_schema), "pieces")
    size = F.col(f"`{length}`")
    counts = (numbered.where(size.between(1, capacity))
              .groupBy(size.cast("long").alias(own_length), F.col(part).alias(own_part)).agg(F.count("*").alias("n")))
    counts = written(counts, "counts")
    histogram = {r[0]: r[1] for r in counts.groupBy(own_length).agg(F.sum("n")).collect()}
    table = _places(plan(histogram, capacity))
    earlier = Window.partitionBy(own_length).orderBy(own_part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(own_length, own_part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    joined = numbered.join(offsets, (size == F.col(own_length)) & (F.col(part) == F.col(own_part)), "left").drop(own_length, own_part)
    out = T.StructType([*df.schema.fields, T.StructField(sequence, T.LongType()), T.StructField(offset, T.LongType())])
    n = len(df.columns)

    def locate(batches):
        for batch in batches:
            ready = batch.column(n + 2).is_valid().to_numpy(zero_copy_only=False)
            sizes = np.nan_to_num(batch.column(at).cast(pa.int64()).to_numpy(zero_copy_only=False).astype(float))
            sizes = np.where(ready, sizes, 1).astype(np.int64)
            ranks = batch.column(n + 1).to_numpy() + batch.column(n + 2).fill_null(0).to_numpy()
            found = np.searchsorted(table[:, 0], sizes << _RANK_BITS | ranks, "right") - 1
            row = table[found] if len(table) else np.zeros((len(sizes), 5), np.int64) + [0, 0, 1, 0, 0]
            copy, slot = np.divmod(ranks - row[:, 1], row[:, 2])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(row[:, 3] + copy, mask=~ready),
                 pa.array(row[:, 4] + slot * sizes, mask=~ready)], names=out.names)

    return joined.mapInArrow(locate, out)
