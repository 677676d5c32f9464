"""Latest row per key (DISTINCT ON ... ORDER BY) as ``row_number() == 1``.

Catalyst plans this as a partial ``WindowGroupLimit`` before the shuffle (each map task keeps
one row per key) and a final one after it, so duplicates are dropped map-side. Keys here are
record ids, so the shuffle is uniform; NULL keys must be filtered by the caller first, or they
would all land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
