"""The best text that starts with each of many asked strings, by one sorted sweep.

Asked strings and texts are sorted together by range. All texts that start with
a string follow it directly, so a task that reads its range in order needs only
the stack of strings that the current one starts with. A text counts for the top
of the stack; a string that is left hands its best on to the one below. Strings
that began in an earlier range are prefixes of the first row of this one, so
each range opens with all prefixes of its first row. What a range found for them
is merged with what the others found, and what nobody asked for meets no asked
string. A prefix that a third of all texts share is thus spread over many ranges
and comes back as one row from each.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


class _Open:
    """Open strings, the longest last, each with the best row seen since it was opened."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.best: list[tuple | None] = []

    def leave(self, text: str) -> list[tuple[str, tuple]]:
        """Closes what ``text`` does not start with; strings that have a row, with it."""
        closed = []
        while self.names and not text.startswith(self.names[-1]):
            closed.extend(self._close())
        return closed

    def _close(self) -> list[tuple[str, tuple]]:
        name, best = self.names.pop(), self.best.pop()
        if best is None:
            return []
        self.count(best)
        return [(name, best)]

    def enter(self, name: str) -> None:
        if not self.names or self.names[-1] != name:
            self.names.append(name)
            self.best.append(None)

    def count(self, row: tuple) -> None:
        if self.best and (self.best[-1] is None or row[:2] < self.best[-1][:2]):
            self.best[-1] = row

    def end(self) -> list[tuple[str, tuple]]:
        return [x for _ in range(len(self.names)) for x in self._close()]


def best_with_prefix(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """For each string of ``asked`` (column ``prefix``) the first text that starts with it.

    ``texts`` has ``text``, ``rank`` (smallest first), ``name`` (settles equal
    ranks), both not null, and any other columns. The result has ``prefix`` and all columns of ``texts``
    but ``text``. Empty and null strings find nothing and are not found; strings
    no text starts with have no row.
    """
    asked = asked.select("prefix").where("prefix <> ''").distinct()
    texts = texts.where("text <> ''")
    carried = [f for f in texts.schema.fields if f.name != "text"]
    carried.sort(key=lambda f: (f.name != "rank", f.name != "name"))
    rows = (asked.select(F.col("prefix").alias("text"), F.lit(0).alias("kind"),
                         *[F.lit(None).cast(f.dataType).alias(f.name) for f in carried])
            .union(texts.select("text", F.lit(1), *[f.name for f in carried])))
    # Rows of equal texts are told apart by rank and name, so that they may be cut apart, too.
    order = ("text", "kind", "rank", "name")
    schema = T.StructType([T.StructField("prefix", T.StringType()), *[T.StructField(f.name, f.dataType) for f in carried]])
    arrow = to_arrow_schema(schema)

    def batch(found):
        columns = zip(*((p, *row) for p, row in found))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def sweep(batches):
        open_, found, begun = _Open(), [], False
        for part in batches:
            for text, kind, *row in zip(*(c.to_pylist() for c in part.columns)):
                if not begun:
                    begun = True
                    for n in range(1, len(text) + 1):
                        open_.enter(text[:n])
                found += open_.leave(text)
                if kind:
                    open_.count(tuple(row))
                else:
                    open_.enter(text)
            if len(found) > 4096:
                yield batch(found)
                found = []
        found += open_.end()
        if found:
            yield batch(found)

    partial = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sweep, schema)
    number = F.row_number().over(Window.partitionBy("prefix").orderBy("rank", "name"))
    return (partial.withColumn("_n", number).where("_n = 1").drop("_n")
            .join(asked, "prefix", "left_semi"))
