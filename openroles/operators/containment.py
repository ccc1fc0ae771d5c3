"""Which texts contain which of many asked strings.

All asked strings of a cell make one Aho-Corasick automaton, which reads each
text once and finds every occurrence of every string, so the work grows with the
texts and the hits, not with all their substrings or with pairs.

Cells are planned from byte counts per group (a host, or one group for a whole
table). A group of ordinary size is one cell. The strings of a larger one are
dealt to buckets of about ``STRING_BYTES`` by the hash of their last characters,
and a text goes to the buckets that its own runs of so many characters fall
into: at most one copy per character, however many strings there are. A bucket
that is still large, as its strings end alike, is cut into blocks of strings
and slices of texts of about ``TEXT_BYTES``, and each block meets each slice: no
task holds more than that, however large a group is. Texts of groups nobody asks
about are not sent. A cell sends one row per string that it found, so what is
shuffled after the search is in proportion to the hits.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: An automaton takes some 50 bytes a character.
STRING_BYTES, TEXT_BYTES = 1 << 20, 16 << 20
#: How many of its last characters a string of a large group is dealt by: the first of these it has.
ENDINGS = (8, 4, 2, 1)
BUCKET = ["group", "ending", "bucket"]


def _parts(df: DataFrame, keys: list[str], column: str, limit: int, name: str) -> DataFrame:
    size = F.sum(F.octet_length(column))
    return df.groupBy(*keys).agg((F.floor(size / limit) + 1).cast("int").alias(name))


def _dealt(texts: DataFrame, strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides by group and bucket: each string once, a text in every bucket that may have strings it contains."""
    # At most one row per group and kind of ending for each ``STRING_BYTES`` asked, so both joins are broadcasts.
    large = _parts(strings, ["group"], "asked", STRING_BYTES, "parts").where("parts > 1")
    ending = F.coalesce(*[F.when(F.length("asked") >= n, n) for n in ENDINGS])
    strings = strings.join(F.broadcast(large), "group", "left").withColumn(
        "ending", F.when(F.col("parts").isNotNull(), ending).otherwise(0)).drop("parts")
    kinds = _parts(strings.where("ending > 0"), ["group", "ending"], "asked", STRING_BYTES, "buckets")

    def bucket(end: Column) -> Column:
        return F.pmod(F.xxhash64(end), F.col("buckets")).cast("int")

    strings = strings.join(F.broadcast(kinds), ["group", "ending"], "left").withColumn(
        "bucket", F.coalesce(bucket(F.right("asked", F.col("ending"))), F.lit(0))).drop("buckets")
    runs = F.transform(F.sequence(F.lit(0), F.length("text") - F.col("ending")),
                       lambda i: bucket(F.substr(F.col("text"), i + 1, F.col("ending"))))
    found = (F.when(F.coalesce(F.col("buckets"), F.lit(1)) == 1, F.array(F.lit(0)))
             .when(F.length("text") >= F.col("ending"), F.array_distinct(runs)))
    texts = texts.join(F.broadcast(kinds), "group", "left").withColumn("bucket", F.explode(found)).drop("buckets")
    # A column of its own, as a cogroup cannot tell apart what both sides have of ``kinds``.
    return texts.withColumn("ending", F.coalesce("ending", F.lit(0))), strings


def _cells(texts: DataFrame, strings: DataFrame) -> DataFrame:
    """Blocks and slices of each bucket that has both texts and strings."""
    return _parts(strings, BUCKET, "asked", STRING_BYTES, "blocks").join(
        _parts(texts, BUCKET, "text", TEXT_BYTES, "slices"), BUCKET)


def first_containing(texts: DataFrame, strings: DataFrame, order: list[tuple[str, str]] = ()) -> DataFrame:
    """For each ``(group, asked)`` of ``strings`` the first text of its group that contains it.

    ``texts`` has ``group``, ``text`` and any other columns, which the result
    carries; ``order`` names some of them with ``ascending`` or ``descending``
    and is total among texts that tell apart. Strings found nowhere, empty ones
    and null ones have no row. ``strings`` may repeat; results do not.
    """
    kept = [c for c in texts.columns if c not in ("group", "text")]
    asked = strings.select("group", "asked").where("asked <> ''").distinct()
    texts, asked = _dealt(texts.where("text <> ''"), asked)
    cells = _cells(texts, asked)
    left = (asked.join(cells, BUCKET)
            .withColumn("block", F.pmod(F.xxhash64("asked"), F.col("blocks")).cast("int"))
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            .select(*BUCKET, "block", "slice", "asked"))
    right = (texts.join(cells, BUCKET)
             .withColumn("slice", F.pmod(F.xxhash64("text", *kept), F.col("slices")).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*BUCKET, "block", "slice", "text", *kept))
    out = left.select("group", "asked").join(right.select("group", *kept), "group").schema
    keys, sort = (*BUCKET, "block", "slice"), list(order)

    def search(some_strings: pa.Table, some_texts: pa.Table) -> pa.Table:
        import ahocorasick

        names = some_strings.column("asked").to_pylist()
        rows = some_texts.sort_by(sort) if sort else some_texts
        first: dict[int, int] = {}
        if names and rows.num_rows:
            automaton = ahocorasick.Automaton()
            for i, name in enumerate(names):
                automaton.add_word(name, i)
            automaton.make_automaton()
            for row, text in enumerate(rows.column("text").to_pylist()):
                for _, i in automaton.iter(text):
                    first.setdefault(i, row)
                if len(first) == len(names):
                    break
        found = rows.take(pa.array(list(first.values()), pa.int64())).select(["group", *kept])
        told = pa.array([names[i] for i in first], some_strings.schema.field("asked").type)
        return found.add_column(1, "asked", told)

    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, out)
    if not order:
        return hits.distinct() if not kept else hits.dropDuplicates(["group", "asked"])
    # One row per string and slice is left; the best of them by the same order.
    by = [F.col(c).asc_nulls_last() if way == "ascending" else F.col(c).desc_nulls_last() for c, way in order]
    number = F.row_number().over(Window.partitionBy("group", "asked").orderBy(*by))
    return hits.withColumn("_n", number).where("_n = 1").drop("_n")
