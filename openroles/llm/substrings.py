"""Removing passages that an earlier document has, by FM-indexes.

Method: a compressed FM-index per shard. A shard's passages are written one
after the other as word numbers; their Burrows-Wheeler transform is held as a
wavelet matrix of bit planes with popcount directories. The passages of the
documents are streamed against it: backward search gives the matching statistic
of each word, the longest run ending there that the index has more than once,
up to the window of 13 words, with its interval. Intervals of full windows are
reported, and the smallest document among their occurrences decides.

What is sent to which shard. A window's anchor is the smallest hash of the 9
five-word grams in it, so equal windows have equal anchors. Following windows
with one anchor form a passage. Two rounds keep the passages few:

1. Anchors meet by hash, as packed arrays. Only places of anchors that two
   documents have are candidates.
2. Documents with candidates are cut into passages, which go to the shard of
   their anchor. An anchor with more passages than a shard should hold has them
   cut into single windows, which go by their own hash.

In both rounds a task resolves what it can: if an anchor or passage occurs in
several documents of one batch, only that of the smallest id is sent. So a
passage that a third of all documents share arrives once per batch.

Texts are shuffled only for documents that may be concerned. A Bloom filter of
their ids, of ``FILTER_BITS`` at any table size, tells most others; one that is
full lets more documents through and changes no result.

Defined cases: null and empty texts have no words. Texts shorter than a window
stay as they are. Rows of equal id never remove words of each other, and each
row is treated by its own text. A row with a null id keeps its words and removes
none of others. Equal rows get equal results. Tables may be empty. Columns other
than the key and the text are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles.llm.common import only, slices, worker_store, written

WINDOW = 13
GRAM = 5
SPAN = WINDOW - GRAM + 1
#: Bytes of text whose anchors meet in one bucket, and passages of a shard.
BUCKET_BYTES, SHARD_PASSAGES = 16 << 20, 15_000
#: Passages of an anchor beyond which they are cut into windows.
MOST_OF_ANCHOR = 10_000
#: Bytes of passages that a task compares before it sends them, counted with what Python needs for a row.
HELD_BYTES = 12 << 20
FILTER_BITS, FILTER_HASHES = 1 << 26, 3
#: Words whose hashes are computed at a time.
WORD_BLOCK = 100_000
_DONE = -1 << 31

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_GRAM_WEIGHTS = [pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(GRAM)]


# --- words, anchors ---------------------------------------------------------------------------------------------

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, nulls as empty, and where each row begins and the last ends."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0]:ends[-1]], (ends - ends[0]).astype(np.int64)


def word_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end bytes of all words, and how many words lie before each row (and after the last)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(stops) + 1, np.searchsorted(first, rows)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base, of its inverse modulo 2^64, and a value for each byte."""
    held = worker_store()
    known = held.get("hash powers")
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 19)
        runs = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            runs.append(np.multiply.accumulate(run))
        held["hash powers"] = known = (*runs, _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)))
    return known


def word_hashes(data: np.ndarray, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever it stands."""
    out = np.empty(len(first), np.uint64)
    for start in range(0, len(first), WORD_BLOCK):
        f, p = first[start:start + WORD_BLOCK], past[start:start + WORD_BLOCK]
        part = data[f[0]:p[-1]]
        up, down, value = _powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(value[part] * up[:len(part)], out=sums[1:])
        out[start:start + WORD_BLOCK] = (sums[p - f[0]] - sums[f - f[0]]) * down[f - f[0]]
    return _mix(out)


def anchors(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Passages of all rows: row, first word in it, number of windows, anchor."""
    first, past, before = word_spans(data, rows)
    n = len(first)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none
    hashes = word_hashes(data, first, past)
    grams = np.zeros(n - GRAM + 1, np.uint64)
    for k, weight in enumerate(_GRAM_WEIGHTS):
        grams += hashes[k:n - GRAM + 1 + k] * np.uint64(weight)
    grams = _mix(grams)
    counts = np.diff(before)
    windows = np.maximum(counts - WINDOW + 1, 0)
    row = np.repeat(np.arange(len(counts)), windows)
    word = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    at = word + before[row]
    # All windows of the batch first, also those across rows, then the rows' own.
    least = np.lib.stride_tricks.sliding_window_view(grams, SPAN).argmin(1)[at] + at
    opens = np.ones(len(at), bool)
    opens[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(opens)
    return row[start], word[start], np.diff(start, append=len(at)), grams[least[start]].view(np.int64)


# --- round 1: anchors that two documents have -----------------------------------------------------------------

def _packed(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // 20
    return (np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int64, n, 8 * n),
            np.frombuffer(data, np.int32, n, 16 * n))


def _ends(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.zeros(0, np.int64)


def candidates(rows: DataFrame, buckets: int) -> DataFrame:
    """``doc`` and first words (``at``) of passages whose anchor another document has, written.

    ``rows`` has ``doc``, not null, and ``text``.
    """
    def send(batches):
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        for batch in slices(batches, 2 << 20):
            row, word, _, anchor = anchors(*text_bytes(batch.column(1)))
            doc = batch.column(0).to_numpy(zero_copy_only=False)[row]
            order = np.lexsort((doc, anchor))
            doc, word, anchor = doc[order], word[order].astype(np.int32), anchor[order]
            starts = _ends(anchor)
            if not len(starts):
                continue
            lengths = np.diff(starts, append=len(anchor))
            known = doc[starts] < doc[starts + lengths - 1]  # the batch itself has two documents with it
            every = np.repeat(known, lengths)
            sent = ~every
            sent[starts] = True
            mark = np.where(every, word | np.int32(_DONE), word)[sent]
            turn += 1
            names, data = [turn % buckets], [b"\x01" + _packed(doc[every], word[every])]
            doc, anchor = doc[sent], anchor[sent]
            bucket = (anchor.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((doc, bucket))
            bucket, cut = bucket[order], _ends(bucket[order])
            for start, end in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
                some = order[start:end]
                names.append(int(bucket[start]))
                data.append(b"\x00" + _packed(anchor[some], doc[some], mark[some]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

    def found(doc, word):
        for start in range(0, len(doc), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(doc[start:start + (1 << 16)]), pa.array(word[start:start + (1 << 16)])],
                                             ["doc", "at"])

    def close(held):
        if held:
            anchor, doc, word = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(anchor)
            anchor, doc, word = anchor[order], doc[order], word[order]
            starts = _ends(anchor)
            lengths = np.diff(starts, append=len(anchor))
            shared = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
            chosen = np.repeat(shared, lengths) & (word >= 0)
            yield from found(doc[chosen], word[chosen])

    def meet(batches):
        held, current = [], None
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if data[0]:
                    n = (len(data) - 1) // 12
                    yield from found(np.frombuffer(data, np.int64, n, 1), np.frombuffer(data, np.int32, n, 1 + 8 * n))
                    continue
                if bucket != current:
                    yield from close(held)
                    held, current = [], bucket
                held.append(_unpacked(data[1:]))
        yield from close(held)

    dealt = rows.mapInArrow(send, "bucket int, data binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return written(dealt.mapInArrow(meet, "doc bigint, at int"), "candidates")


# --- who is concerned --------------------------------------------------------------------------------------------

def _places(doc) -> list:
    return [F.pmod(F.xxhash64(doc, F.lit(i)), F.lit(FILTER_BITS)) for i in range(FILTER_HASHES)]


def concerned(docs: DataFrame):
    """A broadcast Bloom filter of the column ``doc``.

    It has at most ``FILTER_BITS / 64`` words, so its size does not follow the table's.
    """
    place = F.explode(F.array(*_places(F.col("doc")))).alias("p")
    words = (docs.select("doc").distinct().select(place).groupBy(F.shiftright("p", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits")).toArrow())
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return docs.sparkSession.sparkContext.broadcast(bits)


def _with_places(df: DataFrame) -> DataFrame:
    return df.select("*", *[p.alias(f"_place{i}") for i, p in enumerate(_places(F.col("doc")))])


def _parted(batches, bits, inside: bool) -> Iterator[pa.RecordBatch]:
    """The rows whose places, the last columns, are all set in the filter, or those for which one is not."""
    for batch in batches:
        told = np.ones(batch.num_rows, bool)
        for column in batch.columns[-FILTER_HASHES:]:
            place = column.to_numpy(zero_copy_only=False)
            told &= bits.value[place >> 6] >> (place & 63) & 1 == 1
        yield batch.filter(pa.array(told if inside else ~told)).select(range(batch.num_columns - FILTER_HASHES))


def maybe_in(df: DataFrame, bits) -> DataFrame:
    """Rows whose ``doc`` may be in the filter."""
    return _with_places(df).mapInArrow(lambda batches: _parted(batches, bits, True), df.schema)


# --- round 2: passages ------------------------------------------------------------------------------------------

PASSAGE = "anchor bigint, words binary, doc bigint, h bigint, at int, flags int"


class _Passages:
    """Passages of a task; of equal ones only those of the smallest document are sent on."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.lowest: dict[bytes, int] = {}
        self.bytes = 0

    def add(self, anchor: int, words: bytes, doc: int, h: int, at: int, windows: int) -> None:
        self.rows.append((anchor, words, doc, h, at, windows))
        low = self.lowest.get(words)
        if low is None:
            self.bytes += len(words)
        if low is None or doc < low:
            self.lowest[words] = doc
        self.bytes += 256

    def batches(self) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.rows), 4096):
            anchor, words, doc, h, at, windows = zip(*self.rows[start:start + 4096])
            later = [self.lowest[w] < d for w, d in zip(words, doc)]
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor, pa.int64()), pa.array([None if x else w for w, x in zip(words, later)], pa.binary()),
                pa.array(doc, pa.int64()), pa.array(h, pa.int64()), pa.array(at, pa.int32()),
                pa.array([(1 << n) - 1 if x else None for n, x in zip(windows, later)], pa.int32())],
                ["anchor", "words", "doc", "h", "at", "flags"])
        self.__init__()


def passages(rows: DataFrame) -> DataFrame:
    """Passages at the candidate places of each row of ``doc``, ``h``, ``text`` and the array ``ats``.

    A row has ``words`` to look up, or ``flags``: which of its windows an earlier document of the same batch has.
    """
    def run(batches):
        held = _Passages()
        for batch in slices(batches, 1 << 20):
            data, begins = text_bytes(batch.column(2))
            row, word, windows, anchor = anchors(data, begins)
            ats = batch.column(3)
            flat = ats.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(ats), 0).to_numpy(zero_copy_only=False))
            chosen = np.flatnonzero(np.isin(row << 32 | word, owner << 32 | flat))
            docs, hs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            last, split = -1, []
            for r, at, n, a in zip(row[chosen].tolist(), word[chosen].tolist(), windows[chosen].tolist(), anchor[chosen].tolist()):
                if r != last:
                    last, split = r, data[begins[r]:begins[r + 1]].tobytes().split()
                held.add(a, b" ".join(split[at:at + n + WINDOW - 1]), docs[r], hs[r], at, n)
            if held.bytes > HELD_BYTES:
                yield from held.batches()
        yield from held.batches()

    return rows.mapInArrow(run, PASSAGE)


def single_windows(rows: DataFrame) -> DataFrame:
    """Passages cut into their windows, anchored by the hash of all their words."""
    def run(batches):
        held = _Passages()
        for batch in batches:
            for _, words, doc, h, at, _ in zip(*(c.to_pylist() for c in batch.columns)):
                split = words.split()
                for i in range(len(split) - WINDOW + 1):
                    window = b" ".join(split[i:i + WINDOW])
                    held.add((xxhash.xxh64_intdigest(window) ^ 1 << 63) - (1 << 63), window, doc, h, at + i, 1)
            if held.bytes > HELD_BYTES:
                yield from held.batches()
        yield from held.batches()

    return rows.mapInArrow(run, PASSAGE)


# --- the index ------------------------------------------------------------------------------------------------------

class WaveletMatrix:
    """Bit planes of a sequence, from the highest bit, with a popcount directory for each 64 bits."""

    def __init__(self, sequence: np.ndarray, bits: int) -> None:
        n = len(sequence)
        self.planes = []
        for level in range(bits - 1, -1, -1):
            bit = sequence >> level & 1 == 1
            packed = np.zeros((n >> 6) + 1, np.uint64)
            packed.view(np.uint8)[:(n + 7) >> 3] = np.packbits(bit, bitorder="little")
            ones = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=ones[1:])
            self.planes.append((level, packed, ones, n - int(bit.sum())))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def follow(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where each place lies after all planes if only ``symbols`` are followed."""
        for level, packed, ones, zeros in self.planes:
            word = places >> 6
            below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            rank = ones[word] + np.bitwise_count(packed[word] & below)
            places = np.where(symbols >> level & 1 == 1, zeros + rank, places - rank)
        return places


class FMIndex:
    """Passages of numbers from 2 on, given one after the other; 1 ends a passage, 0 the whole.

    Suffixes are sorted by their first ``depth`` symbols, which gives the right
    interval for every pattern up to that length.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, depth: int = WINDOW) -> None:
        self.symbols = symbols
        self.begins = np.cumsum(lengths + 1) - lengths - 1
        text = np.ones(int(lengths.sum()) + len(lengths) + 1, np.int64)
        places = np.arange(len(self.symbols)) + np.repeat(np.arange(len(lengths)), lengths)
        text[places] = self.symbols
        text[-1] = 0
        n = len(text)
        rank, known = text, 1
        order = np.argsort(text)
        while known < depth:
            nearby = np.zeros(n, np.int64)
            nearby[:-known] = rank[known:]
            key = rank * (int(rank.max()) + 1) + nearby
            order = np.argsort(key)
            told = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[False], told[1:] != told[:-1]]))
            known *= 2
        self.suffixes = order
        self.owner = np.searchsorted(self.begins, order, "right") - 1
        counts = np.bincount(text)
        self.less = np.concatenate([[0], np.cumsum(counts)])
        self.matrix = WaveletMatrix(text[order - 1], max(1, int(len(counts) - 1).bit_length()))
        every = np.arange(len(counts))
        self.shift = self.less[:-1] - self.matrix.follow(every, np.zeros(len(counts), np.int64))

    def matching_statistics(self, symbols: np.ndarray, ends: np.ndarray, longest: np.ndarray, least: int = 1):
        """Length and interval of the longest run that ends at each of ``ends`` and occurs ``least`` times.

        No run is longer than ``longest``; a length of 0 has the interval of everything.
        """
        n = len(self.suffixes)
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), n, np.int64)
        active = np.flatnonzero(longest > 0)
        while len(active):
            c = symbols[ends[active] - length[active]]
            both = self.matrix.follow(np.concatenate([c, c]), np.concatenate([low[active], high[active]]))
            lo, hi = both[:len(c)] + self.shift[c], both[len(c):] + self.shift[c]
            good = hi - lo >= least
            active = active[good]
            low[active], high[active] = lo[good], hi[good]
            length[active] += 1
            active = active[length[active] < longest[active]]
        return length, low, high


def lowest_bearers(held: list[bytes], low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each distinct passage, the smallest document that has it; and windows per passage."""
    numbers: dict[bytes, int] = {}
    told = [array("i", [numbers.setdefault(w, len(numbers) + 2) for w in p.split()]) for p in held]
    lengths = np.array([len(p) for p in told], np.int64)
    symbols = np.concatenate([np.frombuffer(p, np.int32) for p in told]).astype(np.int64)
    del numbers, told
    windows = lengths - WINDOW + 1
    owner = np.repeat(np.arange(len(held)), windows)
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    ends = (np.cumsum(lengths) - lengths)[owner] + within + WINDOW - 1
    index = FMIndex(symbols, lengths)
    # Each passage is in the index itself: only runs that occur twice say anything.
    length, lo, hi = index.matching_statistics(index.symbols, ends, np.full(len(ends), WINDOW), least=2)
    out = low[owner]
    full = np.flatnonzero(length == WINDOW)
    if len(full):
        starts, first, back = np.unique(lo[full], return_index=True, return_inverse=True)
        bearers = np.append(low[index.owner], 0)
        out[full] = np.minimum.reduceat(bearers, np.stack([starts, hi[full][first]], 1).ravel())[::2][back]
    return out, windows


FLAGS = "doc bigint, h bigint, at int, flags int"


def search(rows: DataFrame, shards: int) -> DataFrame:
    """``flags`` of the windows of each passage that a smaller document has; passages without any are left out."""
    def close(held):
        if not held:
            return
        number: dict[bytes, int] = {}
        of = np.array([number.setdefault(w, len(number)) for w, *_ in held], np.int64)
        doc, h, at = (np.array(x, np.int64) for x in list(zip(*held))[1:])
        low = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(low, of, doc)
        bearers, windows = lowest_bearers(list(number), low)
        n = windows[of]
        before = np.cumsum(n) - n
        within = np.arange(n.sum()) - np.repeat(before, n)
        place = within + np.repeat((np.cumsum(windows) - windows)[of], n)
        flags = np.add.reduceat((bearers[place] < np.repeat(doc, n)).astype(np.int64) << within, before)
        some = np.flatnonzero(flags)
        for start in range(0, len(some), 1 << 14):
            part = some[start:start + (1 << 14)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[part]), pa.array(h[part]), pa.array(at[part], pa.int32()), pa.array(flags[part], pa.int32())],
                ["doc", "h", "at", "flags"])

    def run(batches):
        held, current = [], None
        for batch in batches:
            shard, *columns = (c.to_pylist() for c in batch.columns)
            for s, *row in zip(shard, *columns):
                if s != current:
                    yield from close(held)
                    held, current = [], s
                held.append(row)
        yield from close(held)

    dealt = rows.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "words", "doc", "h", "at")
    return dealt.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, FLAGS)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Windows that a smaller document has, for rows of ``doc``, ``h`` and ``text``."""
    spark = docs.sparkSession
    known = docs.where(F.col("doc").isNotNull())
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES + 1)
    places = candidates(known.select("doc", "text"), buckets)
    per_doc = places.groupBy("doc").agg(F.collect_set("at").alias("ats"))
    cut = written(passages(maybe_in(known, concerned(places)).join(per_doc, "doc").select("doc", "h", "text", "ats")), "passages")
    asked, told = cut.where(F.col("words").isNotNull()), cut.where(F.col("words").isNull())
    many = asked.groupBy("anchor").count().where(F.col("count") > MOST_OF_ANCHOR).select("anchor")
    many = written(many, "frequent-anchors")  # its size is then known when the joins below are planned
    if not many.isEmpty():
        windows = written(single_windows(asked.join(many, "anchor", "left_semi").select(*cut.columns)), "windows")
        asked = asked.join(many, "anchor", "left_anti").select(*cut.columns).union(windows.where(F.col("words").isNotNull()))
        told = told.union(windows.where(F.col("words").isNull()))
    shards = asked.count() // SHARD_PASSAGES + 1
    return written(search(asked, shards).union(told.select("doc", "h", "at", "flags")), "repeated-windows")


RESULT = "n_words bigint, n_removed bigint, kept_sha256 string"


def kept_words(text: bytes, repeated: list[tuple[int, int]] | None) -> tuple[list[bytes], list[bytes]]:
    """All words, and those that no repeated window covers."""
    words = text.split()
    if not repeated:
        return words, words
    change = np.zeros(len(words) + 1, np.int64)
    for at, flags in repeated:
        for i in range(flags.bit_length()):
            if flags >> i & 1:
                change[at + i] += 1
                change[at + i + WINDOW] -= 1
    covered = np.cumsum(change[:-1]) > 0
    return words, [w for w, c in zip(words, covered.tolist()) if not c]


def _results(rows: DataFrame, key: str, outside=None) -> DataFrame:
    """Digests of the words kept, from ``doc``, ``text`` and ``repeated``, or of the rows outside a filter, from the first two."""
    def run(batches):
        for batch in slices(_parted(batches, outside, False) if outside else batches, 1 << 20):
            texts = pc.fill_null(batch.column(1), "").cast(pa.binary()).to_pylist()
            places = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(texts)
            found = [kept_words(t, [(p["at"], p["flags"]) for p in r or ()]) for t, r in zip(texts, places)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w, _ in found], pa.int64()),
                 pa.array([len(w) - len(k) for w, k in found], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for _, k in found], pa.string())],
                [key, "n_words", "n_removed", "kept_sha256"])

    return (_with_places(rows) if outside else rows).mapInArrow(run, f"`{key}` bigint, {RESULT}")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, words, removed words and the digest of the kept ones, for each row.

    ``key`` is of an integer type.
    """
    told = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = only(df, key, text).select(F.col(f"`{key}`").cast("long").alias("doc"), F.xxhash64(told).alias("h"), told.alias("text"))
    windows = repeated_windows(docs)
    hits = concerned(windows)
    per_text = windows.groupBy("doc", "h").agg(F.collect_set(F.struct("at", "flags")).alias("repeated"))
    hit = maybe_in(docs, hits).join(per_text, ["doc", "h"], "left").select("doc", "text", "repeated")
    return _results(hit, key).union(_results(docs.select("doc", "text"), key, outside=hits))
