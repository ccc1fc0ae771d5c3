"""Encoding and decoding with merge-type SentencePiece vocabularies.

Method: an agenda of adjacent symbol pairs ordered by the score of the piece
they make, the leftmost first among equal scores. The best pair is merged, its
new neighbours enter the agenda, and this goes on until no pair is a piece.
Symbols that are no piece fall back to their UTF-8 bytes.

No piece of such a vocabulary spans a line break or has the space mark behind
another character, so texts are cut there into words; the parts do not affect
each other. Every word that a worker meets for the first time goes through the
agenda. The new words of an Arrow batch do so together: their agendas are the
rows of a matrix, and a round merges the best pair of each row. They are then
checked against the sentencepiece library, which must give the same ids. Decoded
texts are checked against the library for each text.

Defined cases: null and empty texts have no ids and decode to the empty text.
A text of one word of any length is encoded whole. Repeated rows stay repeated;
other columns are not carried unless they are named as keys.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from functools import cached_property
from itertools import chain, count, islice
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from openroles.llm.common import only, slices, worker_store

MARK = "▁"
#: Words that a worker remembers; when there are more it forgets the later half.
REMEMBERED_WORDS = 400_000
#: The agenda of longer words is a heap.
SHORT_WORD = 32
#: Words, of about one length, whose agendas are one matrix.
ROWS = 2048
NEVER = float("inf")
#: Longer words are encoded anew each time and not remembered.
LONGEST_REMEMBERED = 64


class Rows:
    """Rows of small numbers, of any lengths, one behind the other in one array."""

    #: So many rows are copied at a time.
    BLOCK = 1 << 13

    def __init__(self, dtype: type) -> None:
        self.values, self.starts, self.n = np.zeros(1024, dtype), np.zeros(1024, np.int64), 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        n = self.n + len(lengths)
        if n >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(n, np.int64)])
        self.starts[self.n + 1:n + 1] = self.starts[self.n] + np.cumsum(lengths)
        if self.starts[n] > len(self.values):
            self.values = np.concatenate([self.values, np.zeros(self.starts[n], self.values.dtype)])
        self.values[self.starts[self.n]:self.starts[n]] = values
        self.n = n

    def cut(self, n: int) -> None:
        """Leave the first ``n`` rows."""
        self.n, self.starts = n, self.starts[:2 * n + 1].copy()
        self.values = self.values[:2 * self.starts[n]].copy()

    def take(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen rows, one behind the other, and their lengths."""
        lengths = self.starts[chosen + 1] - self.starts[chosen]
        parts = [self.values[:0]]
        for at in range(0, len(chosen), self.BLOCK):
            some = lengths[at:at + self.BLOCK]
            ends = np.cumsum(some)
            parts.append(self.values[np.repeat(self.starts[chosen[at:at + self.BLOCK]] - ends + some, some)
                                     + np.arange(ends[-1])])
        return np.concatenate(parts), lengths


def rows_of(parts: Sequence[bytes]) -> Rows:
    rows = Rows(np.uint8)
    rows.extend(np.frombuffer(b"".join(parts), np.uint8), np.fromiter(map(len, parts), np.int64, len(parts)))
    return rows


class Vocabulary:
    """The pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(n)]
        special = [self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i)
                   for i in range(n)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.rank = {p: -self.library.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(self.library.is_byte(i) for i in self.byte_ids):
            raise ValueError("the vocabulary has no byte pieces")
        if any("\n" in p or MARK in p.lstrip(MARK) or p.startswith(MARK * 2) and p.strip(MARK)
               for p in self.ids):
            raise ValueError("a piece spans words")
        self.surface = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([b])
        for i in range(n):
            if self.library.is_control(i):
                self.surface[i] = b""
        self.surfaces, self.decimals = rows_of(self.surface), rows_of([b"%d," % i for i in range(n)])
        #: The number of each known word, and the ids of each number.
        self.known: defaultdict[str, int] = defaultdict(count().__next__)
        self.coded = Rows(np.int32)

    @cached_property
    def pairs(self) -> _Pairs:
        return _Pairs(self)

    def agenda(self, word: str) -> list[int]:
        """The ids of ``word``, in which spaces are already marks."""
        symbols = self._by_scan(word) if len(word) <= SHORT_WORD else self._by_heap(word)
        out = []
        for s in symbols:
            known = self.ids.get(s)
            if known is None:
                out.extend(self.byte_ids[b] for b in s.encode())
            else:
                out.append(known)
        return out

    def _by_scan(self, word: str) -> list[str]:
        """The agenda as a list by place; its best and leftmost entry is found by a scan."""
        rank = self.rank.get
        symbols = list(word)
        agenda = [rank(word[i:i + 2], NEVER) for i in range(len(word) - 1)]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            pair = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = rank(pair + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + pair, NEVER)
        return symbols

    def _by_heap(self, word: str) -> list[str]:
        """The agenda as a heap; entries whose symbols have changed are passed over."""
        rank = self.rank
        symbols: list[str | None] = list(word)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            pair = word[i:i + 2]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = symbols[i]
            if left is None:
                continue
            j = after[i]
            if j >= n or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = pair + symbols[k]
                if wider in rank:
                    heapq.heappush(heap, (rank[wider], i, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + pair
                if wider in rank:
                    heapq.heappush(heap, (rank[wider], h, wider))
        return [s for s in symbols if s is not None]

    def agendas(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all of ``words``, one word behind the other, and the number of ids of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        short = int(np.searchsorted(lengths[order], SHORT_WORD, "right"))
        found = Rows(np.int32)
        for start in range(0, short, ROWS):
            found.extend(*self.pairs.agendas([words[i] for i in order[start:min(start + ROWS, short)].tolist()]))
        for place in order[short:].tolist():
            ids = self.agenda(words[place])
            found.extend(np.array(ids, np.int32), np.array([len(ids)]))
        return found.take(np.argsort(order))

    def learn(self, new: list[str]) -> None:
        """Put the ids of ``new`` words behind those of the known ones; the library must give the same."""
        ids, lengths = self.agendas([marked(w) for w in new])
        # The library marks the start of a text; a line break before a word that has its own start avoids that.
        bare = [w[0] in STARTS for w in new]
        told = self.library.encode(["\n" + w.replace(MARK, " ") if b else w for w, b in zip(new, bare)], num_threads=1)
        told = [x[2:] if b else x for x, b in zip(told, bare)]
        sizes = np.fromiter(map(len, told), np.int64, len(told))
        if not (np.array_equal(lengths, sizes)
                and np.array_equal(ids, np.fromiter(chain.from_iterable(told), np.int32, int(sizes.sum())))):
            ours = np.split(ids, np.cumsum(lengths)[:-1])
            wrong = next(w for w, x, y in zip(new, ours, told) if x.tolist() != y)
            raise ValueError(f"ids differ from the library's for {wrong!r}")
        self.coded.extend(ids, lengths)

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.known) != self.coded.n:  # the library differed before
            self.keep(self.coded.n)
        if len(self.known) >= REMEMBERED_WORDS:  # frequent words came first; they stay
            self.keep(REMEMBERED_WORDS // 2)
        before = len(self.known)
        numbers = [list(map(self.known.__getitem__, words_of(t))) if t else [] for t in texts]
        sizes = list(map(len, numbers))
        new = list(islice(reversed(self.known), len(self.known) - before))[::-1]
        if new:
            self.learn(new)
        ids, lengths = self.coded.take(np.fromiter(chain.from_iterable(numbers), np.int64, sum(sizes)))
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *sizes])].tolist()
        short = [i for i, w in enumerate(new) if len(w) <= LONGEST_REMEMBERED]
        if len(short) < len(new):
            kept = self.coded.take(before + np.array(short, np.int64))
            self.coded.cut(before)
            self.coded.extend(*kept)
            for word in new:
                del self.known[word]
            self.known.update((new[i], number) for number, i in enumerate(short, before))
            self.known.default_factory = count(len(self.known)).__next__
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def keep(self, n: int) -> None:
        """Forget all but the first ``n`` words."""
        self.known = defaultdict(count(n).__next__, islice(self.known.items(), n))
        self.coded.cut(n)

    def decode(self, ids: Sequence[np.ndarray]) -> list[str]:
        """The text of each row of ids."""
        told, lengths = self.surfaces.take(np.concatenate([np.zeros(0, np.int32), *ids]))
        told, ends = told.tobytes(), np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, ids)])].tolist()
        texts = [told[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
        return [t[1:] if t.startswith(" ") else t for t in texts]


#: What words begin with that have no mark of their own put before them.
STARTS = "\n" + MARK
_WORDS = re.compile(f"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*")


def words_of(text: str) -> list[str]:
    """``text`` cut before spaces and line breaks; one space is left out, a line break stays with its word."""
    if MARK not in text:
        words = text.replace("\n", " \n").split(" ")
        if "" not in words:
            return words
    return _WORDS.findall(MARK + text.replace(" ", MARK))


def marked(word: str) -> str:
    """A word of ``words_of`` with its mark."""
    return word if word[0] in STARTS else MARK + word


class _Pairs:
    """The pieces that two symbols make, found for many pairs at a time.

    A symbol is a number: that of a piece, or one for another character that pieces hold;
    characters that no piece holds share ``other``, which makes no pair.
    """

    LAST = np.iinfo(np.int32).max
    MIX = np.int64(0x9E3779B97F4A7C15 - (1 << 64))

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.byte_ids, self.n_pieces = vocabulary.byte_ids, len(vocabulary.pieces)
        number = dict(vocabulary.ids)
        for c in dict.fromkeys(chain.from_iterable(vocabulary.ids)):
            number.setdefault(c, self.n_pieces + len(number))
        self.other = max(number.values(), default=0) + 1
        self.span = self.other + 1
        characters = {ord(c): i for c, i in number.items() if len(c) == 1}
        self.of_code = np.full(max(characters, default=0) + 2, self.other, np.int32)
        self.of_code[list(characters)] = list(characters.values())
        level = {r: i for i, r in enumerate(sorted(set(vocabulary.rank.values())))}
        made = [(number[p[:k]] * self.span + number[p[k:]], level[vocabulary.rank[p]], i)
                for p, i in vocabulary.ids.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        made.append((-1, self.LAST, -1))  # found for pairs that make no piece
        self.keys, ranks, pieces = (np.array(x, np.int64) for x in zip(*made))
        self.ranks, self.pieces = ranks.astype(np.int32), pieces.astype(np.int32)
        self.none = len(made) - 1
        self.bits = (8 * len(made)).bit_length()
        # A hash table: a pair stands at its home or at the first place behind it that was free.
        self.slots = np.full(1 << self.bits, self.none, np.int32)
        rest = np.arange(self.none)
        at = self.home(self.keys[:-1])
        while len(rest):
            free = self.slots[at] == self.none
            self.slots[at[free]] = rest[free]
            rest, at = (x[self.slots[at] != rest] for x in (rest, at))
            at = (at + 1) & (len(self.slots) - 1)

    def home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * self.MIX >> (64 - self.bits)) & (len(self.slots) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; the rank is ``LAST`` if it makes none."""
        keys = left.astype(np.int64) * self.span + right
        at = self.home(keys)
        found = self.slots[at]
        rest = np.flatnonzero((self.keys[found] != keys) & (found != self.none))
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(self.slots) - 1)
            found[rest] = self.slots[at[rest]]
            rest = rest[(self.keys[found[rest]] != keys[rest]) & (found[rest] != self.none)]
        return self.ranks[found], self.pieces[found]

    def agendas(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids that ``Vocabulary.agenda`` gives for each word, and their numbers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        # A row has a symbol by place and ``other`` behind its last; flat places of one row follow each other.
        width = int(lengths.max()) + 1
        held = np.arange(width) < lengths[:, None]
        codes = np.zeros(held.shape, np.int64)
        codes[held] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = np.where(held, self.of_code[np.minimum(codes, len(self.of_code) - 1)], self.other)
        rank = np.full(held.shape, self.LAST, np.int32)
        piece = np.full(held.shape, -1, np.int32)
        ranks, pieces = self.find(symbols[:, :-1].reshape(-1), symbols[:, 1:].reshape(-1))
        rank[:, :-1], piece[:, :-1] = ranks.reshape(len(words), -1), pieces.reshape(len(words), -1)
        places = np.arange(held.size).reshape(held.shape)
        after, before = places + 1, places - 1
        before[:, 0] = places[:, -1]
        symbols, flat_rank, piece, after, before = (x.reshape(-1) for x in (symbols, rank, piece, after, before))
        rows = np.arange(len(words))
        while len(rows):
            best = rank.take(rows, 0).argmin(1) + rows * width
            live = flat_rank[best] != self.LAST
            rows, i = rows[live], best[live]
            j, h = after[i], before[i]
            k = after[j]
            made = symbols[i] = piece[i]
            symbols[j], flat_rank[j] = -1, self.LAST
            after[i], before[k] = k, i
            ranks, pieces = self.find(np.concatenate([made, symbols[h]]), np.concatenate([symbols[k], made]))
            flat_rank[i], flat_rank[h] = ranks[:len(i)], ranks[len(i):]
            piece[i], piece[h] = pieces[:len(i)], pieces[len(i):]
        symbols = symbols.reshape(held.shape)
        left = held & (symbols >= 0)
        ids, codes, per_word = symbols[left], codes[left], left.sum(1)
        lacking = np.flatnonzero(ids >= self.n_pieces)
        if len(lacking):
            parts = [[self.byte_ids[b] for b in chr(c).encode()] for c in codes[lacking].tolist()]
            per_symbol = np.ones(len(ids), np.int64)
            per_symbol[lacking] = sizes = np.array(list(map(len, parts)))
            in_bytes = np.zeros(len(ids), bool)
            in_bytes[lacking] = True
            np.add.at(per_word, np.arange(len(words)).repeat(per_word)[lacking], sizes - 1)
            ids, in_bytes = np.repeat(ids, per_symbol), np.repeat(in_bytes, per_symbol)
            ids[in_bytes] = list(chain.from_iterable(parts))
        return ids.astype(np.int32), per_word


def vocabulary(path: str) -> Vocabulary:
    """One per worker process, kept from task to task."""
    loaded = worker_store()
    if ("pieces", path) not in loaded:
        loaded["pieces", path] = Vocabulary(path)
    return loaded["pieces", path]


CODED = "ids array<int>, decoded string"


def encode_batch(voc: Vocabulary, texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
    """Ids and decoded texts, checked against the library."""
    ids = voc.encode(texts)
    decoded = voc.decode(ids)
    lists = [x.tolist() for x in ids]
    for ours, theirs in zip(decoded, voc.library.decode(lists, num_threads=1) if lists else []):
        if ours != theirs:
            raise ValueError("a decoded text differs from the library's")
    return ids, decoded


def encode(df: DataFrame, model: str, keys: Sequence[str] = ("doc_id",), text: str = "text",
           digest: Callable | None = None, digest_schema: str = "") -> DataFrame:
    """``keys`` with ``ids`` and ``decoded`` for each row.

    ``digest(voc, ids, decoded) -> list of arrays`` puts columns of
    ``digest_schema`` in place of the two, within the same Arrow batch, for
    callers who want figures of the ids and not the ids.
    """
    kept = only(df, *keys)
    out = T.StructType(kept.schema.fields + T._parse_datatype_string(digest_schema or CODED).fields)
    n_keys = len(keys)

    def run(batches):
        voc = vocabulary(model)
        for batch in slices(batches, 1 << 20):
            ids, decoded = encode_batch(voc, batch.column(n_keys).to_pylist())
            if digest:
                columns = digest(voc, ids, decoded)
            else:
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *ids])
                columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                           pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keys], *columns], names=out.names)

    return only(df, *keys, text).mapInArrow(run, out)


DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digests(voc: Vocabulary, ids: list[np.ndarray], decoded: list[str]) -> list[pa.Array]:
    """Number of ids, and digests of the ids in decimals and of the decoded text."""
    spelled, lengths = voc.decimals.take(np.concatenate([np.zeros(0, np.int32), *ids]))
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, ids)])].tolist()
    spelled = spelled.tobytes()
    return [pa.array([len(x) for x in ids], pa.int64()),
            # The comma behind the last id is left out.
            pa.array([hashlib.sha256(spelled[a:max(a, b - 1)]).hexdigest() for a, b in zip(ends, ends[1:])]),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded])]
