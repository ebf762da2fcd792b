"""Dense surrogate ids 1..n in key order, computed without a global window.

Rows are range-partitioned on the order key and sorted inside each
partition; ``monotonically_increasing_id`` then encodes (partition, position).
Per-partition row counts (one row per partition -- a bounded, broadcastable
table) give each partition its offset. No single task sees all rows.

The partitioned, sorted rows are checkpointed (reliably, into the shared
checkpoint folder) before they are numbered: the range bounds come from a
sample, and a recomputation after a lost executor -- or the second read by
the count branch -- must see exactly the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_dense_id(df: DataFrame, order_cols: Sequence[str], id_col: str = "id",
                  partitions: int | None = None) -> DataFrame:
    from bizlens.session import shared_dir

    spark = df.sparkSession
    shared_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).checkpoint(eager=True)
    tagged = (
        staged.withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return tagged.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_off") + F.col("_pos") + 1).alias(id_col)
    )


def check_dense_id(df: DataFrame, id_col: str = "id") -> None:
    """Raises unless the ids of ``df`` are 1..n, each once."""
    n, low, high, different = df.agg(F.count(F.lit(1)), F.min(id_col), F.max(id_col), F.countDistinct(id_col)).first()
    if n and (low, high, different) != (1, n, n):
        raise ValueError(f"{id_col}: {different} different values from {low} to {high} in {n} rows")
