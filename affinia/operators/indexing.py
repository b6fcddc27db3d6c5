"""Global order without a one-partition window: numbering, previous row, last value seen.

A window per user or key puts all of a hot key's rows in one task. Here the rows are
range-sorted as a whole and checkpointed with their partition and place in it, so a hot
key spans as many partitions as it needs and a retried task cannot shift anything. What
crosses partitions is one row per partition, which is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinia.session import cut_lineage


def _earlier():
    """All earlier partitions; applied to one row per partition."""
    return W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)


def sorted_parts(df: DataFrame, *order: Column) -> DataFrame:
    """Rows in global order (without ``order``, in the one they have), with ``_part`` and ``_place``."""
    placed = (df.orderBy(*order) if order else df).withColumn("_part", F.spark_partition_id())
    first = F.shiftleft(F.col("_part").cast("bigint"), 33)
    return cut_lineage(placed.withColumn("_place", F.monotonically_increasing_id() - first))


def dense_index(df: DataFrame, *order: Column, name: str = "index") -> DataFrame:
    """Number rows 0..n-1 in the given total order, or in the order that the rows already have."""
    placed = sorted_parts(df, *order)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(_earlier()), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def place_in_group(df: DataFrame, group: list[str], *order: Column, name: str = "place") -> DataFrame:
    """Number the rows of each group 0.. in order, groups of any size."""
    numbered = dense_index(df, *[F.asc(g) for g in group], *order, name="_at")
    starts = numbered.groupBy(*group).agg(F.min("_at").alias("_first"))
    return numbered.join(starts, group).withColumn(name, F.col("_at") - F.col("_first")).drop("_at", "_first")


def with_last_seen(placed: DataFrame, value: Column, name: str, inclusive: bool = True) -> DataFrame:
    """Adds the latest non-null ``value`` at (or strictly before) each row of the order."""
    upto = W.partitionBy("_part").orderBy("_place").rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    tagged = placed.withColumn("_v", value)
    ends = tagged.where(F.col("_v").isNotNull()).groupBy("_part").agg(F.max_by("_v", "_place").alias("_v"))
    parts = placed.select("_part").distinct().join(ends, "_part", "left")
    carried = parts.select("_part", F.last("_v", ignorenulls=True).over(_earlier()).alias("_carried"))
    here = F.last("_v", ignorenulls=True).over(upto)
    return tagged.withColumn("_here", here).join(F.broadcast(carried), "_part").withColumn(
        name, F.coalesce("_here", "_carried")
    ).drop("_v", "_here", "_carried")


def running_sum(placed: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the running sum of ``value`` over the whole order, the row included."""
    upto = W.partitionBy("_part").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(_earlier()), F.lit(0)).alias("_start"))
    return placed.withColumn("_run", F.sum(value).over(upto)).join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.col("_run")
    ).drop("_run", "_start")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n, rank: str = "rank") -> DataFrame:
    """First n rows per group by a total order.

    ``row_number() <= n`` plans a group limit on the map side, so a hot group sends at
    most n rows per task to its reducer.
    """
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)
