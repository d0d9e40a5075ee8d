"""Global positions without a single-task sort."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridseries.session import ensure_checkpoint_dir

INDEX_BITS = 33


def in_order(df: DataFrame) -> DataFrame:
    """Number rows 0..n-1 in the order they come in, partition after partition.

    The rows are checkpointed, because the borders of sorted partitions may differ between two evaluations and
    both reads must see the same partitions. Only one row per partition meets in one place.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.withColumn("_mark", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_mark", INDEX_BITS)
    placed = placed.withColumns({"_part": part, "_index": F.col("_mark") - F.shiftleft(part, INDEX_BITS)})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn("position", F.col("_offset") + F.col("_index"))
            .drop("_mark", "_part", "_index", "_offset"))


def with_position(df: DataFrame, order: list[str]) -> DataFrame:
    """Number rows 0..n-1 in the given order: rows are range-partitioned and sorted within their partitions."""
    return in_order(df.repartitionByRange(*order).sortWithinPartitions(*order))
