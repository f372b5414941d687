"""Row numbering within groups that stays balanced when one group is huge.

``row_number() OVER (PARTITION BY k ORDER BY o)`` puts a whole group in one
task.  Here the rows are range-partitioned on (k, o) instead, so a hot group is
cut into consecutive slices held by different tasks.  Each slice is numbered
locally; the slice offsets come from a small count per (k, slice) table,
prefix-summed per group.  The result equals ``row_number`` exactly when the
ordering is total (callers end ``order_by`` with a unique column).

Range bounds come from sampling, and a re-executed sample may cut elsewhere,
so the sliced rows are checkpointed (reliably, in the shared checkpoint
folder) before the numbering and the counting branch both read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from replenix.session import checkpoint_root


def balanced_row_number(df: DataFrame, partition_by: list[str], order_by: list[Column],
                        name: str = "row_number", num_slices: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in partition_by]
    checkpoint_root(spark)
    sliced = (df.repartitionByRange(n, *keys, *order_by)
              .withColumn("_slice", F.spark_partition_id())
              .checkpoint(eager=True))
    # local number inside a (group, slice): bounded by one slice's size
    local_w = Window.partitionBy(*partition_by, "_slice").orderBy(*order_by)
    numbered = sliced.withColumn("_local", F.row_number().over(local_w))
    # rows of the group held by earlier slices: one row per (group, slice)
    counts = sliced.groupBy(*partition_by, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*partition_by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*partition_by, "_slice",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (numbered.join(offsets, [*partition_by, "_slice"])
            .withColumn(name, F.col("_local") + F.col("_offset"))
            .drop("_slice", "_local", "_offset"))
