"""Dense ordinal over a global sort order, without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead the frame is range-sorted and checkpointed (the checkpoint fixes
partition membership and order, also when tasks are retried), each
partition's row count is taken (one row per partition), and a row's
ordinal is its partition's offset plus its position inside the partition.
The offsets table has one row per partition, a proven bound, so it is
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage


def dense_index(df: DataFrame, order_cols, name: str = "ordinal") -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_cols`` order."""
    ordered = cut_lineage(df.orderBy(*order_cols))
    tagged = (ordered.withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    # monotonically_increasing_id = (partition id << 33) + row position in the partition.
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + pos).cast("bigint"))
            .drop("_pid", "_mid", "_off"))
