"""Global row numbers without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openroles.session import cut_lineage

LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_global_rank(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``1..n`` in the given total order.

    Range partitioning on the whole order splits even a single hot score; each
    partition numbers its own sorted rows and adds the sizes of the partitions
    before it. The sorted rows are checkpointed in between, so both uses see
    the same partitions also after an executor is lost. The table of sizes has
    one row per partition.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut_lineage(spread.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", LOCAL_BITS)
    numbered = numbered.withColumns({
        "_part": part, "_local": F.col("_m") - F.shiftleft(part, LOCAL_BITS) + 1})
    sizes = numbered.groupBy("_part").agg(F.max("_local").alias("size"))
    # One row per partition of the sort: bounded by the shuffle partition count.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    return numbered.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_local") + F.col("before")).drop("_m", "_part", "_local", "before")
