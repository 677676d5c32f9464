"""Skew-safe building blocks for hot keys and hot groups of identical rows.

The reference's facts are Zipf-skewed on customer_id and retried records arrive as copies, so
one key (or one group of identical rows) may hold a large share of a table. These helpers keep
such a group from landing in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_CHUNK = 100_000
SPREAD = 1024                   # partitions that chunks of copies are dealt to, at most


def count_copies(df: DataFrame, cols: list[str]) -> DataFrame:
    """Identical rows collapsed to one row with a ``_copies`` count (partial aggregation first,
    so a group of copies is reduced in every map task before the shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))


def expand_copies(df: DataFrame, by: list[str], per_chunk: int = COPIES_PER_CHUNK, number: str | None = None) -> DataFrame:
    """Undo ``count_copies``: each row repeated ``_copies`` times, with the copy's number as column ``number``.

    A group is cut into chunks of at most ``per_chunk`` copies, and the chunks are dealt by their number and ``by`` to a stated number of
    partitions, which adaptive execution leaves alone: chunk rows are tiny, so sizes would put them all together, but the copies are
    not. So a huge group of copies is produced by many tasks.
    """
    cols = [c for c in df.columns if c != "_copies"]
    n = F.col("_copies")
    chunked = df.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / per_chunk).cast("int"))))
    size = F.least(F.lit(per_chunk), n - F.col("_chunk") * per_chunk).cast("int")
    parts = min(SPREAD, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (chunked.repartition(parts, *by, "_chunk")
            .select(*cols, "_chunk", F.explode(F.sequence(F.lit(1), size)).alias("_i"))
            .select(*cols, *([(F.col("_chunk").cast("bigint") * per_chunk + F.col("_i")).alias(number)] if number else [])))
