"""How the tokens of two vocabularies lie on each other, and how usual each pair is.

Method: inverted pair bitmaps. Two tokens are linked where their bytes overlap.
For each pair of ids a block of documents holds a compressed bitmap of the
documents that have the pair linked, and multiplicity planes: plane j has the
documents whose number of such links, less one, has bit j. Slices of a block
are OR-merged as they come. Blocks hold different documents, so popcounts of
their bitmaps add up to the corpus-wide count of documents, and of bitmaps and
planes to that of links. Counts meet the postings again by pair, and each
posting returns them to the documents of its block, weighted by its planes.

Texts are cut where both vocabularies start a token whatever stands around: at a
single blank or line break between characters that are no white space. Workers
remember how such a chunk is aligned; both libraries encode each new chunk.

A bitmap (container) is a list of 16-bit places if it has fewer than
``BLOCK_DOCS / 16`` of them, else a bitset; its length in bytes says which.

Defined cases: null and empty texts, and texts whose tokens do not spell a blank
and the text in both vocabularies, have no tokens: zeros and ''. Every row is a
document of its own, equal ones too. Tables may be empty. Columns other than the
key and the text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles.llm import packing, sentencepieces
from openroles.llm.common import only, slices, worker_store, written

#: Documents of a block, and (document, pair) entries after which a block is closed early.
BLOCK_DOCS, BLOCK_ENTRIES = 4096, 2_000_000
SPARSE = BLOCK_DOCS // 16
#: Chunks that a worker remembers before it starts anew.
REMEMBERED_CHUNKS = 400_000
#: Blocks whose sums a task holds before it sends them.
HELD_BLOCKS = 128

_REGULAR = re.compile(r" ?[^ \n]+|\n")
_IRREGULAR = re.compile(r"[^\S \n]|[ \n](?=[ \n])|[ \n]\Z")
_CUTS = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")


def chunks(spaced: str) -> list[str]:
    """``spaced`` cut at blanks and line breaks that stand alone between other characters."""
    return _CUTS.split(spaced) if _IRREGULAR.search(spaced) else _REGULAR.findall(spaced)


class ByteVocabulary:
    """Ids and token bytes of a byte-level file; texts of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.fast = packing.tokenizer(path)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        byte_of = packing.byte_characters()
        self.surface = {i: bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
                        for token, i in self.library.get_vocab(with_added_tokens=True).items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        odd = self.fast.other.search
        return [self.library.encode(t, add_special_tokens=False).ids if odd(t) else self.fast.fast.encode_ordinary(t)
                for t in texts]


class PieceVocabulary:
    """Ids and token bytes of a SentencePiece model, for chunks that begin with their own blank."""

    def __init__(self, path: str) -> None:
        held = sentencepieces.vocabulary(path)
        self.library, self.surface = held.library, held.surface

    def encode(self, texts: list[str]) -> list[list[int]]:
        # The library marks the start of a text; the line break before the chunk takes that mark.
        return [ids[2:] for ids in self.library.encode(["\n" + t for t in texts])]


def overlaps(left: Sequence[int], right: Sequence[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Linked places, and ends of groups, of two rows of token lengths with one total."""
    links, cuts = [], []
    i = j = 0
    end_i, end_j = left[0], right[0]
    while True:
        links.append((i, j))
        to_i, to_j = end_i <= end_j, end_j <= end_i
        i, j = i + to_i, j + to_j
        if to_i and to_j:
            cuts.append((i, j))
            if i == len(left):
                return links, cuts
        if to_i:
            end_i += left[i]
        if to_j:
            end_j += right[j]


class Aligner(dict):
    """Number of each known chunk; ``learn`` aligns those met for the first time."""

    def __init__(self, first: str, second: str) -> None:
        super().__init__()
        self.first, self.second = ByteVocabulary(first), PieceVocabulary(second)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.waiting: list[str] = []
        self.groups: list[str] = []
        self.figures = np.zeros((1024, 5), np.int64)  # tokens of both, groups, links, 1 if the bytes agree
        self.starts = np.zeros(1025, np.int64)
        self.codes = np.zeros(1 << 14, np.int64)
        self.times = np.zeros(1 << 14, np.int64)

    def __missing__(self, chunk: str) -> int:
        self.waiting.append(chunk)
        self[chunk] = number = len(self)
        return number

    def learn(self) -> None:
        new, self.waiting = self.waiting, []
        if not new:
            return
        first, second = self.first.surface, self.second.surface
        figures, lengths, codes, times = [], [], [], []
        for chunk, a, b in zip(new, self.first.encode(new), self.second.encode(new)):
            told = chunk.encode()
            if b"".join(map(first.__getitem__, a)) != told or b"".join(map(second.__getitem__, b)) != told:
                figures.append((0, 0, 0, 0, 0))
                lengths.append(0)
                self.groups.append("")
                continue
            links, cuts = overlaps([len(first[x]) for x in a], [len(second[x]) for x in b])
            pairs = Counter((a[i] << 32) | b[j] for i, j in links)
            i = j = 0
            spelled = []
            for to_i, to_j in cuts:
                spelled.append(",".join(map(str, a[i:to_i])) + "|" + ",".join(map(str, b[j:to_j])))
                i, j = to_i, to_j
            self.groups.append(";".join(spelled))
            figures.append((len(a), len(b), len(cuts), len(links), 1))
            lengths.append(len(pairs))
            codes.extend(pairs)
            times.extend(pairs.values())
        at = len(self.groups) - len(new)
        self.figures = _room(self.figures, len(self.groups))
        self.figures[at:len(self.groups)] = figures
        self.starts = _room(self.starts, len(self.groups) + 1)
        self.starts[at + 1:len(self.groups) + 1] = self.starts[at] + np.cumsum(lengths)
        end = self.starts[len(self.groups)]
        self.codes, self.times = _room(self.codes, end), _room(self.times, end)
        self.codes[self.starts[at]:end], self.times[self.starts[at]:end] = codes, times


def _room(array: np.ndarray, length: int) -> np.ndarray:
    if length <= len(array):
        return array
    wider = np.zeros((max(length, 2 * len(array)), *array.shape[1:]), array.dtype)
    wider[:len(array)] = array
    return wider


def aligner(first: str, second: str) -> Aligner:
    held = worker_store()
    if ("aligner", first, second) not in held:
        held["aligner", first, second] = Aligner(first, second)
    return held["aligner", first, second]


def align_texts(known: Aligner, texts: list[str | None]):
    """Figures and group spelling of each text, and the entries (row, pair, links) of all."""
    cut = [chunks(" " + t) if t else [] for t in texts]
    numbers = [np.fromiter(map(known.__getitem__, c), np.int64, len(c)) for c in cut]
    known.learn()
    figures = np.zeros((len(texts), 4), np.int64)
    spelled = []
    for row, chosen in enumerate(numbers):
        found = known.figures[chosen]
        if len(chosen) and found[:, 4].all():
            figures[row] = found[:, :4].sum(0)
            spelled.append(";".join(map(known.groups.__getitem__, chosen.tolist())))
        else:
            numbers[row] = chosen[:0]
            spelled.append("")
    rows = np.repeat(np.arange(len(texts)), [len(x) for x in numbers])
    span = max(1, len(known))
    both, repeats = np.unique(rows * span + np.concatenate([np.zeros(0, np.int64), *numbers]), return_counts=True)
    rows, chosen = both // span, both % span
    lengths = known.starts[chosen + 1] - known.starts[chosen]
    before = np.cumsum(lengths) - lengths
    at = np.arange(lengths.sum()) + np.repeat(known.starts[chosen] - before, lengths)
    return figures, spelled, (np.repeat(rows, lengths), known.codes[at], known.times[at] * np.repeat(repeats, lengths))


def containers(pairs: np.ndarray, places: np.ndarray) -> dict[int, bytes]:
    """A bitmap for each pair; both arrays are sorted by pair, then place."""
    listed = places.astype("<u2").tobytes()
    starts = np.flatnonzero(np.diff(pairs, prepend=-1))
    out = {}
    for pair, start, end in zip(pairs[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(pairs)]):
        if end - start < SPARSE:
            out[pair] = listed[2 * start:2 * end]
        else:
            bits = np.zeros(BLOCK_DOCS, np.uint8)
            bits[places[start:end]] = 1
            out[pair] = np.packbits(bits).tobytes()
    return out


def popcount(container: bytes) -> int:
    if len(container) < 2 * SPARSE:
        return len(container) // 2
    return int.from_bytes(container, "little").bit_count()


def members(container: bytes) -> np.ndarray:
    """The places of a container."""
    if len(container) < 2 * SPARSE:
        return np.frombuffer(container, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8)))


class Block:
    """Entries of up to ``BLOCK_DOCS`` documents, merged slice by slice."""

    def __init__(self) -> None:
        self.docs = self.entries = 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, rows: np.ndarray, codes: np.ndarray, times: np.ndarray, docs: int) -> None:
        order = np.lexsort((rows, codes))
        rows, codes, times = rows[order], codes[order], times[order]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])
        at = np.flatnonzero(first)
        if len(at):
            self.parts.append((codes[at], rows[at] + self.docs, np.add.reduceat(times, at)))
        self.docs += docs
        self.entries += len(at)

    def postings(self) -> list[tuple[int, bytes, list[bytes]]]:
        """(pair, documents, planes) in the order of pairs."""
        if not self.parts:
            return []
        codes, places, times = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(codes, kind="stable")  # places rise from slice to slice
        codes, places, more = codes[order], places[order], times[order] - 1
        docs = containers(codes, places)
        planes: dict[int, list[bytes]] = {}
        for bit in range(int(more.max()).bit_length()):
            has = more >> bit & 1 == 1
            for pair, held in containers(codes[has], places[has]).items():
                planes.setdefault(pair, []).extend([b""] * (bit - len(planes.get(pair, ()))))
                planes[pair].append(held)
        return [(pair, held, planes.get(pair, [])) for pair, held in docs.items()]


FIGURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_POSTING = "pair bigint, docs_with bigint, links bigint, docs binary, planes array<binary>"


def invert(df: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of documents (``block``, ``place``, figures) and of postings (``block``, ``pair``, bitmaps), written.

    Numbers of blocks come from the task, so the table is written before it is read twice.
    """
    rows = only(df, key, text).select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = df.schema[key].dataType.simpleString()
    schema = f"block bigint, place int, key {kind}, {FIGURES}, {_POSTING}"

    def run(batches):
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = aligner(first, second)
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in _limited(slices(batches, 1 << 20)):
            if block.docs and (block.docs + batch.num_rows > BLOCK_DOCS or block.entries > BLOCK_ENTRIES):
                yield from _posting_batches(block.postings(), number, out)
                number, block = number + 1, Block()
            if len(known) > REMEMBERED_CHUNKS:
                known.forget()
            figures, spelled, entries = align_texts(known, batch.column(1).to_pylist())
            n = batch.num_rows
            digest = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled]
            yield _filled(out, n, block=pa.array([number] * n, pa.int64()),
                          place=pa.array(range(block.docs, block.docs + n), pa.int32()), key=batch.column(0),
                          groups_sha256=pa.array(digest, pa.string()),
                          **{c: pa.array(figures[:, i]) for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))})
            block.add(*entries, n)
        yield from _posting_batches(block.postings(), number, out)

    out = df.sparkSession.createDataFrame([], schema).schema
    return written(rows.mapInArrow(run, out), "pair-bitmaps")


def _limited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_DOCS):
            yield batch.slice(start, BLOCK_DOCS)


def _filled(schema, n: int, **columns) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else pa.nulls(n, to_arrow_type(f.dataType)) for f in schema.fields],
        names=schema.names)


def _posting_batches(postings, number: int, schema):
    for start in range(0, len(postings), 4096):
        some = postings[start:start + 4096]
        counts = [popcount(docs) for _, docs, _ in some]
        links = [n + sum(popcount(p) << j for j, p in enumerate(planes)) for n, (_, _, planes) in zip(counts, some)]
        yield _filled(schema, len(some), block=pa.array([number] * len(some), pa.int64()),
                      pair=pa.array([p for p, _, _ in some], pa.int64()), docs_with=pa.array(counts, pa.int64()),
                      links=pa.array(links, pa.int64()), docs=pa.array([d for _, d, _ in some], pa.binary()),
                      planes=pa.array([p for _, _, p in some], pa.list_(pa.binary())))


def pair_counts(inverted: DataFrame) -> DataFrame:
    """``pair``, ids ``a`` and ``b``, documents ``n_docs``, links ``n_links``, and ``best``: 1 if no b has more documents with this a."""
    pairs = inverted.where(F.col("pair").isNotNull()).groupBy("pair").agg(
        F.sum("docs_with").alias("n_docs"), F.sum("links").alias("n_links"))
    pairs = pairs.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))})
    most = pairs.groupBy("a").agg(F.max("n_docs").alias("most"))
    return pairs.join(most, "a").select("pair", "a", "b", "n_docs", "n_links",
                                        (F.col("n_docs") == F.col("most")).cast("int").alias("best"))


def returned_scores(inverted: DataFrame, counts: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` of each (``block``, ``place``) from the postings and the counts of their pairs."""
    scored = (inverted.where(F.col("pair").isNotNull()).select("block", "pair", "docs", "planes")
              .join(counts.select("pair", "n_docs", "best"), "pair").select("block", "docs", "planes", "n_docs", "best"))
    schema = "block bigint, place int, n_best bigint, count_sum bigint"

    def run(batches):
        held: dict[int, np.ndarray] = {}

        def send():
            for block, sums in held.items():
                at = np.flatnonzero(sums.any(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), block, np.int64)), pa.array(at, pa.int32()),
                     pa.array(sums[at, 0]), pa.array(sums[at, 1])], ["block", "place", "n_best", "count_sum"])
            held.clear()

        for batch in batches:
            for block, docs, planes, count, best in zip(*(c.to_pylist() for c in batch.columns)):
                if block not in held:
                    if len(held) >= HELD_BLOCKS:
                        yield from send()
                    held[block] = np.zeros((BLOCK_DOCS, 2), np.int64)
                sums, worth = held[block], np.array([best, count], np.int64)
                sums[members(docs)] += worth  # the places of a container are different ones
                for bit, plane in enumerate(planes):
                    if plane:
                        sums[members(plane)] += worth << bit
        yield from send()

    return (scored.repartition("block").mapInArrow(run, schema)
            .groupBy("block", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))


def align(df: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures of the alignment of each row's text, with the scores of its links."""
    inverted = invert(df, first, second, key, text)
    docs = inverted.where(F.col("pair").isNull()).select(
        "block", "place", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    scores = returned_scores(inverted, pair_counts(inverted))
    return docs.join(scores, ["block", "place"], "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), "groups_sha256")
