"""Bottom-k fingerprints of word shingles, in DataFrame functions only.

A text's fingerprint is the sorted array of the K smallest distinct 64-bit
hashes of its shingles (five words; a shorter text is one shingle). Such
sketches of parts merge into the sketch of the whole, and two of them estimate
resemblance and containment; one estimates the number of distinct shingles.
With up to K shingles all three are exact.

Defined cases: null is the empty text, whose fingerprint is empty; two empty
ones are alike (1.0), an empty one and another are not (0.0). Rows that repeat
an id and its text count once in :func:`with_neighbours`; rows of one id with
different texts follow each other in an order of their own. Null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openroles.functions.text import let
from openroles.llm.common import SPACE_CLASS, only, written

K = 128
SHINGLE = 5


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """Hashes of the shingles of a text, with repeats."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")

    def of(w: Column) -> Column:
        slid = F.transform(F.sequence(F.lit(0), F.size(w) - width),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return (F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
                .when(F.size(w) < width, F.array(F.xxhash64(F.concat_ws(" ", w))))
                .otherwise(slid))

    return let(words, of)


def sketch(text: Column, k: int = K) -> Column:
    return smallest(F.array_distinct(shingle_hashes(text)), k)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.array_sort(hashes), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return smallest(F.array_union(a, b), k)


def merge_all(df: DataFrame, key: str, fingerprint: str = "fingerprint", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts, by ranks of single hashes.

    The hashes are made distinct with partial sums first, so a key with any
    share of the parts costs at most k rows a task.
    """
    each = df.select(F.col(f"`{key}`").alias("key"), F.explode(F.col(f"`{fingerprint}`")).alias("h")).distinct()
    rank = F.row_number().over(Window.partitionBy("key").orderBy("h"))
    return (each.withColumn("r", rank).where(F.col("r") <= k).groupBy("key")
            .agg(F.array_sort(F.collect_list("h")).alias("fingerprint")).withColumnRenamed("key", key))


def _shared(a: Column, b: Column, k: int) -> Column:
    return let(merge(a, b, k), lambda u: F.struct(
        F.size(F.array_intersect(F.array_intersect(u, a), b)).alias("both"), F.size(u).alias("all")))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    return let(_shared(a, b, k), lambda s: F.when(s["all"] == 0, F.lit(1.0)).otherwise(s["both"] / s["all"]))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    span = (F.get(a, F.lit(k - 1)).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / span)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, 0 to 1."""
    union = distinct_shingles(merge(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def as_text(a: Column) -> Column:
    """16 hexadecimal digits per hash, in order."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _links(keys: DataFrame) -> DataFrame:
    """Rows (a, b, pa, pb, pn): each key with the one before it and that one's n.

    Keys are cut into ranges, numbered within each, and the ends of the ranges
    joined; the first key's predecessor is the last key.
    """
    ranged = keys.repartitionByRange("a", "b").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "keys")
    inner = Window.partitionBy("part").orderBy("a", "b")
    own = ranged.select("*", *[F.lag(c).over(inner).alias(f"p{c}") for c in ("a", "b", "n")])
    ends = ranged.groupBy("part").agg(F.max(F.struct("a", "b", "n")).alias("last"))
    # One row per non-empty range, so at most as many as there are partitions.
    order = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ends.select("part", F.coalesce(F.lag("last").over(order), F.last("last").over(whole)).alias("edge"))
    joined = own.join(before, "part")
    first = F.col("pa").isNull()
    return joined.select("a", "b", *[F.when(first, F.col(f"edge.{c}")).otherwise(F.col(f"p{c}")).alias(f"p{c}")
                                     for c in ("a", "b", "n")])


_NO_ID = -(1 << 63)


def with_neighbours(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, text, fingerprint, edited text, its fingerprint, the next document's fingerprint.

    The edited text has the last floor(n/4) code points replaced by the first as
    many of the next document in ascending order of ids; the first follows the
    last. What a document takes from the next is cut there, so a join carries
    that part and the fingerprint only. Whole texts are shuffled once.
    """
    rows = only(df, key, text).toDF("id", "t").select(
        F.coalesce(F.col("id").cast("long"), F.lit(_NO_ID)).alias("a"), F.coalesce("t", F.lit("")).alias("t"))
    rows = rows.select("a", F.xxhash64("t").alias("b"), "t")
    keys = rows.select("a", "b", F.char_length("t").cast("long").alias("n"))
    counts = keys.agg(F.count("*").alias("n"), F.count_distinct("a").alias("d")).first()
    if counts["n"] != counts["d"]:
        rows = rows.dropDuplicates(["a", "b"])
        keys = keys.distinct()
    rows = rows.withColumn("f", sketch(F.col("t")))
    links = _links(keys)
    given = (rows.join(links, ["a", "b"])
             .select(F.col("pa").alias("a"), F.col("pb").alias("b"),
                     F.expr("substring(t, 1, cast(floor(pn / 4) as int))").alias("front"), F.col("f").alias("next")))
    n = F.char_length("t")
    both = rows.join(given, ["a", "b"]).withColumn(
        "e", F.concat(F.substring(F.col("t"), F.lit(1), n - F.floor(n / 4).cast("int")), F.col("front")))
    both = both.withColumn("ef", sketch(F.col("e")))
    return both.select(F.when(F.col("a") != _NO_ID, F.col("a")).alias(key), F.col("t").alias("text"),
                       F.col("f").alias("fingerprint"), F.col("e").alias("edited"),
                       F.col("ef").alias("edited_fingerprint"), F.col("next").alias("next_fingerprint"))


def fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and fingerprint of every row, without a shuffle."""
    return only(df, key, text).select(F.col(f"`{key}`"), sketch(F.col(f"`{text}`")).alias("fingerprint"))
