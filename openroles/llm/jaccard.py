"""Jaccard join on word shingles by T-occurrence search.

A document's set are the distinct five-word shingles of its lower-cased (A-Z)
words, as 64-bit hashes; a shorter text is one shingle. Documents link when the
intersection holds at least 80 of 100 parts of the union.

1. Equal sets are collapsed to one by a digest of the set; only the first
   document of each goes on.
2. A set that links with another shares one of its n - ceil(0.8 n) + 1 first
   shingles, in any order of shingles that is the same for all. The order puts
   frequent shingles (long inverted lists) last: a table of counters over all
   documents says which they are, and only speed depends on it. Documents that
   share such a shingle are put in one cell, named by the list's first document.
   A cell then drops the documents that cannot link with any other of it: counts
   of a set's shingles by the leading bits of their hashes bound the overlap of
   two sets from above, exactly, at a small part of the size of the sets.
3. In a cell a T-occurrence search finds the links: of a query's inverted lists
   the short ones are merged, documents that occur often enough there are looked
   up in the long ones by binary search (DivideSkip), and those with the required
   overlap are checked exactly. All candidates of a query pass these steps at once,
   as arrays. Documents that share too few shingles with all others together are
   left out before. A document that was linked leaves the index and is a query
   itself, so links found twice are not looked for.
4. A cell of more than ``CELL_SHINGLES`` is cut into blocks. Each block searches
   within itself, with the cell's first documents added as pivots. Documents of
   the cell that are then not in its largest component are searched against
   every block. No link between components can be missed: within the largest
   component none is needed, and all other pairs of blocks are searched.
5. Links, one row each, are merged into components by alternating star
   contraction in Spark; tasks and driver hold no component.

Defined cases: null texts and texts without words have no shingle and link with
nothing. Null ids are in results, with a null component, but take no part.
Repeated rows of an id are one document if their texts agree; if not, they are
linked with each other's groups, as they share the id, whatever their lengths.
"""

from __future__ import annotations

from collections import deque
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openroles.llm.common import fresh, only, slices, written

WIDTH = 5
#: Links need ``100 * both >= PERCENT * either``.
PERCENT = 80
#: Counters of shingle frequencies, and the shingles that one task searches at a time.
COUNTERS, STRETCH = 1 << 20, 1 << 12
#: Bits that tell tasks which documents to leave out, and those that tell which of all documents may be copies.
BITMAP, GONE_BITS = 1 << 22, 1 << 23
#: Rows of a narrow table that is broadcast.
LISTED = 200_000
CELL_SHINGLES = 1_500_000
#: Cells of more shingles are not narrowed by shapes but searched block by block at once.
SHAPED_SHINGLES = 40_000_000
PIVOTS = 4
#: DivideSkip's constant for the number of long lists.
MU = 0.01
#: Sets that a task remembers, to put copies into its lists once.
REMEMBERED = 200_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    from xxhash import xxh3_64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < width:
        width = len(words)
    n = len(words) - width + 1
    total = np.full(n, len(words) if n == 1 and width < WIDTH else WIDTH, np.uint64)
    for k in range(width):
        total += _mixed(hashes[k:k + n] + np.uint64(k)) * _ODD[k % len(_ODD)]
    return np.unique(_mixed(total))


def least_overlap(n: int) -> int:
    """Fewest shingles that a set of n shares with any set it links with."""
    return -(-PERCENT * n // 100)


def links(n: int, m: int, both: int) -> bool:
    return both > 0 and 100 * both >= PERCENT * (n + m - both)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        yield key, shingle_set(text)


def shape_of(s: np.ndarray) -> bytes:
    """Counts of a set's shingles by leading bits, about two to four in each; none if one does not fit."""
    bits = max(0, len(s).bit_length() - 2)
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(s), np.int64),
                         minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


class Shapes:
    """Documents of a cell by the number of their counters and their size, to find those that may link."""

    def __init__(self, sizes: np.ndarray, shapes: list[bytes]) -> None:
        # Sums of counters are sizes of sets; these numbers hold them exactly.
        kind = np.float32 if sizes.max(initial=0) < 1 << 24 else np.float64
        self.sizes, self.shapes = sizes, [np.frombuffer(x, np.uint8).astype(kind) for x in shapes]
        lengths = np.array([len(x) for x in self.shapes])
        self.by_length, self.folded = {}, {}
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            at = at[np.argsort(sizes[at], kind="stable")]
            self.by_length[n] = (at, sizes[at])
            self.folded[n, n] = np.stack([self.shapes[i] for i in at])

    def _table(self, length: int, to: int) -> np.ndarray:
        """Counters of all documents with ``length`` of them, added up to ``to`` counters."""
        if (length, to) not in self.folded:
            table = self.folded[length, length]
            self.folded[length, to] = table.reshape(len(table), to, -1).sum(2)
        return self.folded[length, to]

    def search(self, query: int, alive: np.ndarray) -> list[int]:
        """Documents that are alive and whose overlap with ``query`` may suffice."""
        n, own = int(self.sizes[query]), self.shapes[query]
        least, most = least_overlap(n), 100 * n // PERCENT
        found = []
        for length, (at, sizes) in self.by_length.items():
            if sizes[-1] < least or sizes[0] > most:
                continue
            a, b = np.searchsorted(sizes, [least, most + 1]).tolist()
            at, sizes = at[a:b], sizes[a:b]
            use = alive[at]
            if not use.any():
                continue
            to = min(length, len(own))
            if to > 0:
                table = self._table(length, to)[a:b]
                if not use.all():
                    at, sizes, table = at[use], sizes[use], table[use]
                q = own if to == len(own) else own.reshape(to, -1).sum(1)
                both = np.minimum(table, q) @ np.ones(to, q.dtype)
                at = at[100 * both.astype(np.int64) >= PERCENT * (n + sizes - both.astype(np.int64))]
            else:
                at = at[use]
            found.extend(at.tolist())
        return found


def _wide(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def profile(docs: DataFrame) -> DataFrame:
    """(doc_id, n, k1, k2, shape): number of shingles, digest and shape of the set; and rows of counters.

    A task counts its documents' shingles in one table of counters, up to 255;
    the rows with a ``stretch`` hold that table's nonzero parts.
    """
    def run(batches):
        from xxhash import xxh3_128_intdigest

        counters = np.zeros(COUNTERS, np.uint8)
        names = ["doc_id", "n", "k1", "k2", "stretch", "bytes"]
        for batch in slices(batches):
            keys, sizes, digest, shapes = [], [], [], []
            for key, s in _sets(batch):
                keys.append(key), sizes.append(len(s)), shapes.append(shape_of(s))
                d = xxh3_128_intdigest(s.tobytes())
                digest.append((d >> 64, d & (2 ** 64 - 1)))
                at = (s % np.uint64(COUNTERS)).astype(np.int64)
                counters[at] += counters[at] < 255
            k = np.array(digest, np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), _wide(k[:, 0].copy()), _wide(k[:, 1].copy()),
                 pa.nulls(len(keys), pa.int32()), pa.array(shapes, pa.binary())], names=names)
        for at in range(0, COUNTERS, STRETCH):
            part = counters[at:at + STRETCH]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(1, pa.int64())] * 4, pa.array([at // STRETCH], pa.int32()),
                     pa.array([part.tobytes()], pa.binary())], names=names)

    return docs.mapInArrow(run, "doc_id bigint, n bigint, k1 bigint, k2 bigint, stretch int, bytes binary")


def frequent_counters(profiled: DataFrame) -> np.ndarray:
    """Which counters hold a shingle that stands out from the mean; one bit each.

    The driver gets as many bytes as there are counters in eight, for any corpus.
    """
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(counts, np.uint8).astype(np.int64)
                sums[at] = sums[at] + found if at in sums else found
        for at, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([v.tobytes()], pa.binary())],
                                             names=["stretch", "counts"])

    rows = (profiled.where("stretch is not null").select("stretch", "bytes").repartition("stretch")
            .mapInArrow(add, "stretch int, counts binary"))
    rows = written(rows, "counters")
    total = np.zeros(COUNTERS, np.int64)
    for r in rows.toLocalIterator():
        total[r["stretch"] * STRETCH:(r["stretch"] + 1) * STRETCH] = np.frombuffer(r["counts"], np.int64)
    mean = total.mean()
    return np.packbits(total > mean + 8 * np.sqrt(mean) + 32)


def heads(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(h, doc_id): the first n - ceil(0.8 n) + 1 shingles of each set, frequent ones last.

    A set that a task has met before is left out there, as its list holds it already.
    """
    def run(batches):
        from xxhash import xxh3_128_digest

        often = np.unpackbits(frequent).astype(bool)
        met: set[bytes] = set()
        for batch in slices(batches):
            hashes, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for key, s in _sets(batch):
                digest = xxh3_128_digest(s.tobytes())
                if key is None or len(s) == 0 or digest in met:
                    continue
                if len(met) >= REMEMBERED:
                    met.clear()
                met.add(digest)
                late = often[(s % np.uint64(COUNTERS)).astype(np.int64)]
                first = np.concatenate([s[~late], s[late]])[:len(s) - least_overlap(len(s)) + 1]
                hashes.append(first), keys.append(np.full(len(first), key, np.int64))
            yield pa.RecordBatch.from_arrays([_wide(np.concatenate(hashes)), pa.array(np.concatenate(keys))],
                                             names=["h", "doc_id"])

    return docs.mapInArrow(run, "h bigint, doc_id bigint")


def cells_of(rows: DataFrame) -> DataFrame:
    """Distinct (cell, doc_id): each document of a list with others, under the list's first document.

    Lists pass as sorted streams; none is held.
    """
    def run(batches):
        last, hub, told = None, 0, False
        for batch in batches:
            h, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(h):
                continue
            start = np.r_[last is None or h[0] != last, h[1:] != h[:-1]]
            at = np.maximum.accumulate(np.where(start, np.arange(len(h)), -1))
            hubs = np.where(at < 0, hub, doc[np.maximum(at, 0)])
            more = ~start
            pairs = np.stack([np.r_[hubs[more], hubs[more]], np.r_[doc[more], hubs[more]]])
            pairs = np.unique(pairs, axis=1)
            last, hub = h[-1], hubs[-1]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["cell", "doc_id"])

    return (rows.repartition("h").sortWithinPartitions("h", "doc_id")
            .mapInArrow(run, "cell bigint, doc_id bigint").distinct())


class Index:
    """Inverted lists over some sets, searched by DivideSkip; a step is taken for all candidates at once."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray) -> None:
        self.lengths = np.array([len(s) for s in sets], np.int64)
        hashes = np.concatenate([np.zeros(0, np.uint64), *[sets[i] for i in members]])
        owners = np.repeat(members, self.lengths[members])
        order = np.argsort(hashes, kind="stable")
        hashes, self.owners = hashes[order], owners[order]
        starts = np.flatnonzero(np.r_[np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1]])
        self.hashes, self.bounds = hashes[starts], np.r_[starts, len(hashes)]
        #: List and owner in one number; sorted, so that one binary search probes for any number of both.
        self.places = np.repeat(np.arange(len(starts)), np.diff(self.bounds)) * len(sets) + self.owners

    def search(self, query: np.ndarray, alive: np.ndarray) -> list[int]:
        """Members that are alive and link with ``query``."""
        n = len(query)
        need = least_overlap(n)
        if need == 0 or not len(self.hashes):
            return []
        at = np.minimum(np.searchsorted(self.hashes, query), len(self.hashes) - 1)
        lists = at[self.hashes[at] == query]
        if len(lists) < need:
            return []
        sizes = self.bounds[lists + 1] - self.bounds[lists]
        order = np.argsort(sizes, kind="stable")
        lists, sizes = lists[order], sizes[order]
        longest = min(need - 1, int(need / (MU * np.log2(sizes[-1] + 1) + 1)))
        short = len(lists) - longest
        found, count = self._merged(lists[:short], sizes[:short])
        near = (count >= need - longest) & alive[found]
        found, count = found[near], count[near]
        near = _may_link(n, self.lengths[found], count + longest)
        found, count = found[near], count[near]
        if longest and len(found):
            count = count + self._probed(found, lists[short:], sizes[short:])
        return found[_may_link(n, self.lengths[found], count)].tolist()

    def _merged(self, lists: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The owners in some lists, and how many of the lists each is in."""
        total = int(sizes.sum())
        at = np.repeat(self.bounds[lists] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        if 4 * total < len(self.lengths):
            return np.unique(self.owners[at], return_counts=True)
        count = np.bincount(self.owners[at], minlength=len(self.lengths))
        found = np.flatnonzero(count)
        return found, count[found]

    def _probed(self, found: np.ndarray, lists: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """In how many of the lists each of ``found`` is, by binary search, or by a merge if the lists are the shorter way."""
        if 4 * len(found) * len(lists) > sizes.sum():
            owners, count = self._merged(lists, sizes)
            at = np.minimum(np.searchsorted(owners, found), len(owners) - 1)
            return np.where(owners[at] == found, count[at], 0)
        wanted = (lists[:, None] * len(self.lengths) + found).ravel()
        at = np.minimum(np.searchsorted(self.places, wanted), len(self.places) - 1)
        return (self.places[at] == wanted).reshape(len(lists), -1).sum(0)


def _may_link(n: int | np.ndarray, sizes: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Which overlaps suffice for sets of n shingles with sets of these sizes."""
    return (both > 0) & (100 * both >= PERCENT * (n + sizes - both))


def _linkable(sets: list[np.ndarray]) -> np.ndarray:
    """Which sets hold enough shingles of others to link with any of them.

    A set shares no more than it has in lists of two or more, and a link takes
    more of it the larger its other side is. Sets that are left out shorten the
    lists, so this goes on while it leaves out many.
    """
    n = np.array([len(s) for s in sets], np.int64)
    some = n > 0
    lists = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)[1]
    owners = np.repeat(np.arange(len(n)), n)
    while some.any():
        often = np.bincount(lists)[lists] > 1
        shared = np.bincount(owners[often], minlength=len(n))
        # The smallest set that is large enough for the other side, or this one itself.
        order = np.sort(n[some])
        least = order[np.minimum(np.searchsorted(order, -(-PERCENT * n // 100)), len(order) - 1)]
        before = some.sum()
        some = some & _may_link(n, least, shared)
        if 20 * (before - some.sum()) <= some.sum():
            break
        use = some[owners]
        lists, owners = lists[use], owners[use]
    return some


def search_block(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that span the components of a block; each set is a query once."""
    at = np.flatnonzero(_linkable(sets)).tolist()
    sets = [sets[i] for i in at]
    index, indexed = None, 0

    def linked(q: int, alive: np.ndarray, left: int) -> list[int]:
        nonlocal index, indexed
        if index is None or left * 2 < indexed:
            index, indexed = Index(sets, np.flatnonzero(alive)), left
        return index.search(sets[q], alive)

    return [(at[a], at[b]) for a, b in _spanning(len(sets), linked)]


def _spanning(n: int, linked: Callable[[int, np.ndarray, int], list[int]]) -> list[tuple[int, int]]:
    """Breadth first: what is found leaves the search and is a query in turn."""
    alive, left = np.ones(n, bool), n
    out = []
    for seed in range(n):
        if not alive[seed]:
            continue
        alive[seed] = False
        left -= 1
        queue = deque([seed])
        while queue:
            if not left:
                return out
            q = queue.popleft()
            for c in linked(q, alive, left):
                alive[c] = False
                left -= 1
                out.append((q, c))
                queue.append(c)
    return out


EDGES = "u bigint, v bigint"


def _groups(batches, n_keys: int):
    """(key, rows) of a sorted stream, rows as lists of columns after the key."""
    key, rows = None, []
    for batch in slices(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    found = [(max(p), min(p)) for p in pairs if p[0] != p[1]]
    return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()),
                                       pa.array([v for _, v in found], pa.int64())], names=["u", "v"])


def _search_blocks(batches):
    for _, rows in _groups(batches, 2):
        sets = [np.frombuffer(s, np.uint64) for _, s in rows]
        yield _edges([(rows[a][0], rows[b][0]) for a, b in search_block(sets)])


def _narrowed(batches):
    """(cell, doc_id) of documents that may link with another of their cell; cells are split where none can."""
    for (cell,), rows in _groups(batches, 1):
        shapes = Shapes(np.array([r[1] for r in rows], np.int64), [r[2] for r in rows])
        pairs = _spanning(len(rows), lambda q, alive, left: shapes.search(q, alive))
        first = {}
        for a, b in pairs:
            first[b] = first.setdefault(a, a)
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[f][0] for f in first.values()], pa.int64()), pa.array([rows[i][0] for i in first], pa.int64())],
            names=["cell", "doc_id"])


def _search_across(batches):
    """Queries of one block against another: one link per document and component found."""
    for _, rows in _groups(batches, 3):
        asked = [r for r in rows if r[0]]
        told = [r for r in rows if not r[0]]
        sets = [np.frombuffer(r[3], np.uint64) for r in told]
        alive = np.ones(len(sets), bool)
        index = Index(sets, np.arange(len(sets)))
        pairs = []
        for _, doc, component, s in asked:
            found = index.search(np.frombuffer(s, np.uint64), alive)
            other = {told[i][2]: told[i][1] for i in found if told[i][2] != component}
            pairs.extend((doc, d) for d in other.values())
        yield _edges(pairs)


def _fingerprint(edges: DataFrame) -> tuple:
    """Number and summed hashes of distinct edges: two tables that agree in both are the same."""
    hashes = [F.sum(F.xxhash64("u", "v", F.lit(i)).cast("decimal(38,0)")) for i in range(2)]
    return tuple(edges.agg(F.count("*"), *hashes).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node reaches, by star contraction.

    Every round is written to the shared folder and halves the longest path at least.
    """
    edges = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    told = _fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where("u != v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(floor, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u != v").distinct())
        after = written(small, "edges")
        last, told = told, _fingerprint(after)
        if told == last:
            break
        edges = after
    node = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return node


def _listed(df: DataFrame) -> DataFrame:
    """A broadcast hint for a stored table of at most ``LISTED`` narrow rows; larger ones are shuffled."""
    return F.broadcast(df) if df.limit(LISTED + 1).count() <= LISTED else df


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, s): sets of the documents whose id may be among ``wanted``.

    A bitmap of fixed size tells the tasks which ids to leave out; ids that only
    look wanted are removed by the join that follows.
    """
    at = F.pmod("doc_id", F.lit(BITMAP))
    words = (wanted.select((at / 32).cast("long").alias("w"), (at % 32).cast("int").alias("b")).groupBy("w")
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("b"))).alias("bits")).collect())
    bitmap = np.zeros(BITMAP // 32, np.uint32)
    for r in words:
        bitmap[r["w"]] = r["bits"]

    def run(batches):
        for batch in slices(batches):
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.mod(np.where(np.isnan(keys.astype(float)), 0, keys).astype(np.int64), BITMAP)
            asked = (bitmap[at // 32] >> (at % 32).astype(np.uint32)) & 1 == 1
            batch = batch.filter(pa.array(asked & batch.column(0).is_valid().to_numpy(zero_copy_only=False)))
            found = [(k, s) for k, s in _sets(batch) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()),
                                              pa.array([s.tobytes() for _, s in found], pa.binary())],
                                             names=["doc_id", "s"])

    return docs.mapInArrow(run, "doc_id bigint, s binary")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``."""
    rows = only(docs, key, text).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    profiled = written(profile(rows), "profile")
    sized = profiled.where("stretch is null")
    full = sized.where("n > 0 and doc_id is not null").select("doc_id", "n", "k1", "k2", "bytes")
    copies = (full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
              .where("c > 1").drop("c"))
    member = written(full.join(copies, ["k1", "k2"], "left")
                     .select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), "bytes"), "member")
    moved = member.where("rep != doc_id").select("doc_id").distinct()
    shown = written(member.select("doc_id", "rep").join(moved, "doc_id", "left_semi").distinct(), "copies")

    listed = cells_of(heads(rows, frequent_counters(profiled)))
    cells = written(listed.join(_listed(shown), "doc_id", "left")
                    .select("cell", F.coalesce("rep", "doc_id").alias("doc_id")).distinct(), "cells")
    # An id with several sets has a row for each of them.
    shaped = member.where("rep = doc_id").select("doc_id", "n", F.col("bytes").alias("shape")).distinct()
    sizes = shaped.groupBy("doc_id").agg(F.sum("n").alias("n"))
    sized_cells = written(cells.join(shaped, "doc_id").select("cell", "doc_id", "n", "shape"), "sized")
    totals = sized_cells.groupBy("cell").agg(F.count("*").alias("docs"), F.sum("n").alias("total")).where("docs > 1")
    totals = written(totals, "totals")
    small = sized_cells.join(_listed(totals.where(F.col("total") <= SHAPED_SHINGLES)), "cell", "left_semi")
    whole = sized_cells.join(_listed(totals.where(F.col("total") > SHAPED_SHINGLES)), "cell", "left_semi")
    narrowed = (small.repartition("cell").sortWithinPartitions("cell", "doc_id", "n", "shape").select("cell", "doc_id", "n", "shape")
                .mapInArrow(_narrowed, "cell bigint, doc_id bigint"))
    cells = written(narrowed.union(whole.select("cell", "doc_id")).distinct(), "narrowed")
    mixed = F.xxhash64("doc_id")
    stats = (cells.join(sizes.select("doc_id", "n"), "doc_id").groupBy("cell").agg(
        F.count("*").alias("docs"), F.sum("n").alias("total"), F.min("doc_id").alias("p0"), F.max("doc_id").alias("p1"),
        F.min_by("doc_id", mixed).alias("p2"), F.max_by("doc_id", mixed).alias("p3")).where("docs > 1"))
    stats = written(stats.withColumn("blocks", F.ceil(F.col("total") / CELL_SHINGLES).cast("int"))
                    .withColumn("pivots", F.array(*[f"p{i}" for i in range(PIVOTS)]))
                    .select("cell", "blocks", "pivots"), "stats")
    placed = cells.join(_listed(stats), "cell")
    placed = written(placed.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("blocks")).cast("int")),
                     "placed")
    every = F.when((F.col("blocks") > 1) & F.array_contains("pivots", F.col("doc_id")),
                   F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = placed.select("doc_id", "cell", F.explode(every).alias("block"))
    sets = _sets_of(rows, placed.select("doc_id"))
    edges = (sets.join(_listed(first), "doc_id").select("cell", "block", "doc_id", "s").repartition("cell", "block")
             .sortWithinPartitions("cell", "block", "doc_id").mapInArrow(_search_blocks, EDGES))
    several = shown.join(shown.groupBy("doc_id").count().where("count > 1"), "doc_id", "left_semi")
    edges = written(edges.union(several.select("doc_id", "rep")).distinct(), "links")
    component = written(connected(edges), "components")

    large = placed.where("blocks > 1")
    if not large.isEmpty():
        known = written(large.join(component, F.col("doc_id") == F.col("node"), "left")
                        .select("cell", "blocks", "block", "doc_id", F.coalesce("component", "doc_id").alias("c")), "large")
        main = (known.groupBy("cell", "c").agg(F.count("*").alias("n")).groupBy("cell")
                .agg(F.max_by("c", F.struct("n", "c")).alias("main")))
        rest = written(known.join(main, "cell").where("c != main").select("cell", "blocks", "block", "doc_id", "c"), "rest")
        if not rest.isEmpty():
            parts = rest.groupBy("cell").agg(F.collect_set("block").alias("asking"))  # at most one number per block
            ask = rest.select("cell", F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
                              F.lit(True).alias("asks"), "doc_id", "c")
            tell = (known.join(parts, "cell").select("cell", F.explode("asking").alias("i"), F.col("block").alias("j"),
                                                     F.lit(False).alias("asks"), "doc_id", "c"))
            across = written(ask.union(tell), "across")
            more = (_sets_of(rows, across.select("doc_id")).join(across, "doc_id")
                    .select("cell", "i", "j", "asks", "doc_id", "c", "s").repartition("cell", "i", "j")
                    .sortWithinPartitions("cell", "i", "j").mapInArrow(_search_across, EDGES))
            component = written(connected(edges.union(more)), "components")

    own = member.select("doc_id", "n", "rep").join(component.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n", F.coalesce("component", "rep").alias("component_id"))
    empty = sized.where("n = 0 or doc_id is null").select("doc_id", "n")
    bare = written(empty.where("doc_id is not null").select("doc_id").distinct(), "bare")
    if not bare.isEmpty():  # ids with a text without words may have others
        wordless = own.join(_listed(bare), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("c"))
        empty = empty.join(_listed(written(wordless, "wordless")), "doc_id", "left").select("doc_id", "n", F.coalesce("c", "doc_id"))
    else:
        empty = empty.withColumn("c", F.col("doc_id"))
    return own.union(empty).withColumnRenamed("n", "n_shingles").withColumnRenamed("doc_id", key)


def _without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not among the distinct ids of ``gone``, a stored table of one column.

    If the ids are too many for a broadcast, a bitmap of fixed size is: rows that it
    tells to stay are not shuffled with their texts, only those that may be gone.
    """
    name = gone.columns[0]
    own, same = F.col(f"`{key}`"), F.col(f"`{key}`") == F.col(name)
    listed = _listed(gone)
    if listed is not gone:
        return docs.join(listed, same, "left_anti")

    def place(c):
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(GONE_BITS))

    word, bits = fresh(docs, "_word"), fresh(docs, "_bits")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place(F.col(name)), F.lit(64)).cast("int"))
    words = written(gone.select(F.floor(place(F.col(name)) / 64).alias(word), bit.alias(bits))
                    .groupBy(word).agg(F.bit_or(bits).alias(bits)), "gone_bits")
    told = docs.join(F.broadcast(words), F.floor(place(own) / 64) == F.col(word), "left")
    may = own.isNotNull() & F.coalesce(F.getbit(F.col(bits), F.pmod(place(own), F.lit(64)).cast("int")) == 1, F.lit(False))
    stay, asked = told.where(~may).drop(word, bits), told.where(may).drop(word, bits)
    return stay.union(asked.join(gone, same, "left_anti"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that link, in any number of steps, with one of a smaller id.

    Of repeated rows of an id one stays. Rows without an id stay.
    """
    found = written(classes(docs, key, text), "classes").toDF("id", "n", "c")
    name = fresh(docs, "_id")
    gone = written(found.where("id != c").select(F.col("id").alias(name)).distinct(), "gone")
    kept = _without(docs, key, gone)
    if found.where("id is not null").groupBy("id").count().where("count > 1").isEmpty():
        return kept
    named = kept.where(F.col(f"`{key}`").isNotNull()).dropDuplicates([key])
    return named.union(kept.where(F.col(f"`{key}`").isNull()))
