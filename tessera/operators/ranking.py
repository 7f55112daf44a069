"""Ordered prefix sums without a single-task window.

``Window.orderBy(x)`` without ``partitionBy`` (or partitioned by a key with
one huge group) moves every row into one task. For ranks over a whole
column's domain and for the AUC running sum we instead:

1. range-partition the rows on (group, order) and tag each row with its
   range id,
2. materialise that with a reliable ``checkpoint`` (range bounds come from a
   sample, so the two uses below must see the same assignment even when a
   task is retried),
3. take running sums inside each (range, group),
4. add the total of all earlier ranges of the group, taken from a table of
   one row per (range, group) — broadcast after checking its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


MAX_BROADCAST_OFFSETS = 1_000_000


def ordered_prefix(df: DataFrame, group_cols: list[str], order_cols: list[str | Column],
                   weight: str | Column | None = None, out: str = "prefix",
                   partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (default 1) over rows of the same group
    strictly before this row in ``order_cols`` order. Order keys should be
    unique within a group (aggregate ties first)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    w = F.lit(1).cast("bigint") if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    order_exprs = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(g) for g in group_cols] + order_exprs
    # Without an explicit count AQE may merge adjacent ranges; merged ranges
    # are still contiguous and numbered in order, which is all we need.
    weighted = df.withColumn("_w", w)
    ranged = ((weighted.repartitionByRange(partitions, *keys) if partitions
               else weighted.repartitionByRange(*keys))
              .withColumn("_range", F.spark_partition_id())
              .checkpoint(eager=True))
    before = Window.unboundedPreceding
    inside = (Window.partitionBy("_range", *group_cols).orderBy(*order_exprs)
              .rowsBetween(before, -1))
    local = ranged.withColumn("_local", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    totals = ranged.groupBy("_range", *group_cols).agg(F.sum("_w").alias("_total"))
    earlier = Window.partitionBy(*group_cols).orderBy("_range").rowsBetween(before, -1)
    offsets = totals.select("_range", *group_cols,
                            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    # One row per (range, group). Without groups that is one row per range,
    # bounded by the partition count; otherwise check the bound (a small job
    # over the checkpoint) and shuffle when there are very many groups.
    if not group_cols or totals.count() <= MAX_BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    return (local.join(offsets, ["_range", *group_cols])
            .withColumn(out, F.col("_local") + F.col("_offset"))
            .drop("_w", "_range", "_local", "_offset"))


def dense_ids(df: DataFrame, group_col: str, value_col: str, out: str = "id") -> DataFrame:
    """Distinct (group, value) pairs numbered 1..k within each group in
    ascending value order."""
    pairs = df.select(group_col, value_col).distinct()
    ranked = ordered_prefix(pairs, [group_col], [value_col], out="_before")
    return ranked.select(group_col, value_col, (F.col("_before") + 1).cast("int").alias(out))
