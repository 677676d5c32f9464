"""Dense row numbers without a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_dir


def dense_ids(df: DataFrame, order_by: list[str], id_col: str, after: int = 0) -> DataFrame:
    """``df`` with ``id_col``: ``after`` + 1, + 2, ... in the order of ``order_by`` (rows that tie, in any order).

    Rows are range-partitioned and sorted, and written once with their place in their partition; the partitions' sizes, a row each, give
    the offsets, which are joined back. Equal keys share a partition, so the last column should tell them apart."""
    spark = df.sparkSession
    path = fresh_dir(spark, "numbered")
    (df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
     .withColumn("_place_id", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path)
    part = F.shiftright("_place_id", 33)
    before, offsets = after, []
    for p, n in sorted(map(tuple, rows.groupBy(part.alias("p")).count().collect())):
        offsets.append((p, before))
        before += n
    known = spark.createDataFrame(offsets, "_part bigint, _before bigint")
    return (rows.join(F.broadcast(known), part == F.col("_part"))            # a row for each partition
            .withColumn(id_col, F.col("_before") + F.col("_place_id").bitwiseAND((1 << 33) - 1) + 1)
            .drop("_place_id", "_part", "_before"))
