"""Chat formatting at token level.

Each turn is assembled from segments: a reserved id that opens the turn, the
encoded text, a reserved id that closes it. Segments are encoded separately, so
no token spans a border, and the reserved ids lie above the vocabulary, so no
text can produce them. Strings that look like the template's marks are escaped
inside texts with a backslash, reversibly. The loss mask is the running sum of
+1 where an assistant's text starts and -1 where it ends; running sums of the
turns' sizes place each turn in its conversation.

Rows of a conversation are sorted by turn, then role and text, and pass through
a task as a stream; no conversation is held as a whole.

Defined cases: null texts and roles are empty ones. Rows without a conversation
id form one conversation. Repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from openroles.llm.common import only, slices, worker_store

ROLES = ("system", "user", "assistant")
LOSS_ROLE = "assistant"
#: Texts of the reserved ids, which follow the vocabulary in this order.
OPENERS = tuple(f"### {r.capitalize()}: " for r in ROLES)
OTHER, ROLE_END, CLOSER = "### Other (", "): ", " </turn>\n"
MARKS = (*OPENERS, OTHER, ROLE_END, CLOSER)
CONTROL = tuple(sorted({m.strip() for m in MARKS}, key=len, reverse=True))
_TO_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))


def escape(text: str) -> str:
    """``text`` in which no mark of the template occurs and backslashes are doubled."""
    return _TO_ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class Codec:
    """A byte-level vocabulary with the template's reserved ids above it."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # special strings inside a text are ordinary text
        first = self.library.get_vocab_size(with_added_tokens=True)
        self.reserved = {m: first + i for i, m in enumerate(MARKS)}
        self.marks = {i: m for m, i in self.reserved.items()}

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(list(texts), add_special_tokens=False)]

    def decode(self, ids: Sequence[int]) -> str:
        return self.library.decode(list(ids), skip_special_tokens=False)

    def format(self, turns: Sequence[tuple[str, str]]) -> tuple[list[np.ndarray], list[np.ndarray], list[str]]:
        """Ids, loss masks and formatted texts of (role, text) turns."""
        texts = [escape(t) for _, t in turns]
        others = [escape(r) for r, _ in turns if r not in ROLES]
        encoded = self.encode(texts + others)
        spare = iter(encoded[len(texts):])
        ids, formatted, sizes, bounds = [], [], [], []
        for (role, _), text, body in zip(turns, texts, encoded):
            if role in ROLES:
                mark = OPENERS[ROLES.index(role)]
                front, shown = [self.reserved[mark]], mark
            else:
                front = [self.reserved[OTHER], *next(spare), self.reserved[ROLE_END]]
                shown = OTHER + escape(role) + ROLE_END
            ids.append(np.array([*front, *body, self.reserved[CLOSER]], np.int32))
            bounds.append((len(front), len(front) + len(body)) if role == LOSS_ROLE else None)
            formatted.append(shown + text + CLOSER)
            sizes.append(len(ids[-1]))
        ends = np.cumsum(sizes, dtype=np.int64)
        steps = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int8)
        for end, size, b in zip(ends, sizes, bounds):
            if b:
                steps[end - size + b[0]] += 1
                steps[end - size + b[1]] -= 1
        mask = np.cumsum(steps[:-1], dtype=np.int8)
        return ids, np.split(mask, ends[:-1]) if len(ends) else [], formatted

    def parse(self, ids: Sequence[int]) -> tuple[str, str]:
        """Role and text of a turn, read from its ids alone."""
        first = self.marks[ids[0]]
        if first in OPENERS:
            return ROLES[OPENERS.index(first)], unescape(self.decode(ids[1:-1]))
        end = list(ids).index(self.reserved[ROLE_END])
        return unescape(self.decode(ids[1:end])), unescape(self.decode(ids[end + 1:-1]))


def codec(path: str) -> Codec:
    loaded = worker_store()
    if ("chat", path) not in loaded:
        loaded["chat", path] = Codec(path)
    return loaded["chat", path]


FORMATTED = "ids array<int>, mask array<tinyint>, formatted string, token_start bigint, char_start bigint"


def assemble(df: DataFrame, path: str, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One row per turn: ids, loss mask, formatted text and their places in the conversation.

    Rows of a conversation are in one partition, in order.
    """
    rows = (only(df, conversation, turn, role, text).repartition(F.col(f"`{conversation}`"))
            .sortWithinPartitions(*[F.col(f"`{c}`") for c in (conversation, turn, role, text)]))
    out = T.StructType(rows.schema.fields[:2] + T._parse_datatype_string(FORMATTED).fields)

    def run(batches):
        os_environ_off()
        chat = codec(path)
        current, tokens, chars = object(), 0, 0
        for batch in slices(batches, 1 << 20):
            conversations, _, roles, texts = (c.to_pylist() for c in batch.columns)
            ids, masks, formatted = chat.format([(r or "", t or "") for r, t in zip(roles, texts)])
            token_start, char_start = [], []
            for c, i, f in zip(conversations, ids, formatted):
                if c != current:
                    current, tokens, chars = c, 0, 0
                token_start.append(tokens), char_start.append(chars)
                tokens, chars = tokens + len(i), chars + len(f)
            ends = pa.array(np.cumsum([0, *map(len, ids)], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(masks).astype(np.int8))),
                 pa.array(formatted), pa.array(token_start, pa.int64()), pa.array(char_start, pa.int64())],
                names=out.names)

    return rows.mapInArrow(run, out)


def os_environ_off() -> None:
    """One thread per task; the library would start one per core."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"


READ_BACK = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint")


def read_back(assembled: DataFrame, path: str) -> DataFrame:
    """Digests per conversation of what the ids and masks of :func:`assemble` say.

    It relies on the order of that function's rows and adds no shuffle.
    """
    at = [assembled.columns.index(c) for c in ("ids", "mask", "formatted")]

    def run(batches):
        os_environ_off()
        chat = codec(path)
        current, state, done = object(), None, []

        def finish():
            if state is not None:
                n, turns, loss_n, loss, chars = state
                done.append((current, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

        def rows():
            found = list(zip(*done)) or [[]] * 6
            done.clear()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(found, kinds)],
                                              names=["conv_id", "n_turns", "turns_sha256", "loss_chars",
                                                     "loss_sha256", "formatted_chars"])

        for batch in slices(batches, 1 << 20):
            for c, ids, mask, shown in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in at)):
                if c != current:
                    finish()
                    current, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = chat.parse(ids)
                kept = unescape(chat.decode([i for i, m in zip(ids, mask) if m]))
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(kept)
                state[3].update(kept.encode())
                state[4] += len(shown)
            yield rows()
        finish()
        yield rows()

    return assembled.mapInArrow(run, READ_BACK)
