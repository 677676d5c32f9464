"""Per-customer aggregates from stored daily state instead of from the facts.

The state has a row for each customer and day, with sums and counts that merge by addition; a day knows its month, so months in which a customer
was active are counted from it as well. It lies in the same partitions as the facts. A refresh recomputes the partitions whose fact files
changed since they were last read, and those of the last ``reconcile_days`` days before ``until``; all others stay as stored, and their facts are
not read. What the state was built from is written down last, so an interrupted refresh is done again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bucket_label, month_start
from ..sources.partitioned import PART, PartitionedTable, partition_files
from ..sources.readers import read_or_empty

_S, _L, _D = T.StringType(), T.LongType(), T.DateType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


BILLING_STATE = _st(("customer_id", _S), ("day", _D), ("revenue", T.DecimalType(22, 2)), ("n", _L),
                    ("latest", T.TimestampType()))
SESSION_STATE = _st(("customer_id", _S), ("day", _D), ("data_sum", T.DecimalType(20, 2)), ("duration_sum", _L), ("n", _L),
                    ("short_sessions", _L), ("medium_sessions", _L), ("long_sessions", _L))
_BUILT = _st((PART, _S), ("files", _S))


def billing_days(stg_billing: DataFrame) -> DataFrame:
    """(customer_id, day, revenue, n, latest)."""
    return (stg_billing.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id", F.to_date("transaction_date").alias("day"))
            .agg(F.sum("amount").cast("decimal(22,2)").alias("revenue"), F.count(F.lit(1)).alias("n"),
                 F.max("transaction_date").alias("latest")))


def session_days(stg_sessions: DataFrame) -> DataFrame:
    """(customer_id, day, volume, duration, sessions, and sessions by bucket)."""
    d = F.col("session_duration_sec")
    bucket = bucket_label(d)
    return (stg_sessions.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id", F.col("session_date").alias("day"))
            .agg(F.sum("data_used_mb").cast("decimal(20,2)").alias("data_sum"), F.sum(d.cast("bigint")).alias("duration_sum"),
                 F.count(F.lit(1)).alias("n"), F.count_if(bucket == "short").alias("short_sessions"),
                 F.count_if(bucket == "medium").alias("medium_sessions"), F.count_if(bucket == "long").alias("long_sessions")))


def customer_months(state: DataFrame) -> DataFrame:
    """(customer_id, revenue_month, revenue, n) from daily state: the same frame as from the facts."""
    return (state.groupBy("customer_id", month_start(F.col("day")).alias("revenue_month"))
            .agg(F.sum("revenue").alias("revenue"), F.sum("n").alias("n")))


def session_totals(state: DataFrame) -> DataFrame:
    """One row for each customer: the merged session state."""
    sums = [c for c in SESSION_STATE.names if c not in ("customer_id", "day")]
    return state.groupBy("customer_id").agg(*(F.sum(c).alias(c) for c in sums))


class DailyState:
    """The stored state of one fact table, or of another state: it offers what it needs of its own source."""

    def __init__(self, spark: SparkSession, root: str, facts: PartitionedTable | DailyState, schema: T.StructType,
                 build: Callable[[DataFrame], DataFrame]):
        self.spark, self.root, self.facts, self.schema, self.build = spark, root.rstrip("/"), facts, schema, build
        self.built = f"{self.root}-built"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def with_parts(self) -> DataFrame:
        return read_or_empty(self.spark, self.root, T.StructType([*self.schema.fields, T.StructField(PART, _S)]))

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        df = self.with_parts()
        if parts is not None:
            df = df.where(F.col(PART).isin(sorted(parts)))
        return df.select(*self.schema.names)

    def files(self) -> dict[str, tuple[str, ...]]:
        return partition_files(self._fs, self._path, self.root)

    def part_of(self, col: Column) -> Column:
        return self.facts.part_of(col)

    def parts_between(self, first: dt.date, end: dt.date) -> list[str]:
        return self.facts.parts_between(first, end)

    def rows_of(self, parts: set[str]) -> DataFrame:
        return self.build(self.facts.read(parts))

    def _replace(self, rows: DataFrame, parts: set[str]) -> None:
        """Put ``rows`` in place of the partitions ``parts``; one that gets no row goes."""
        before = self.files()
        rows = rows.select(*self.schema.names, self.part_of(F.col("day")).alias(PART))
        (rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.root))
        after = self.files()
        for p in parts & set(before):
            if after.get(p) == before[p]:                    # not written
                self._fs.delete(self._path(f"{self.root}/{PART}={p}"), True)

    def refresh(self, reconcile_days: int = 0, until: dt.date | None = None) -> list[str]:
        """Bring the state up to the facts; the partitions that were recomputed."""
        now = {p: hashlib.sha256("\n".join(f).encode()).hexdigest() for p, f in self.facts.files().items()}
        was = {r[PART]: r["files"] for r in read_or_empty(self.spark, self.built, _BUILT).collect()}     # a row a partition
        due = {p for p, f in now.items() if was.get(p) != f}
        if reconcile_days and until is not None:
            due |= set(self.facts.parts_between(until - dt.timedelta(days=reconcile_days), until))
        gone = set(was) - set(now)
        if due:
            self._replace(self.rows_of(due), due)
        for p in gone:
            self._fs.delete(self._path(f"{self.root}/{PART}={p}"), True)
        if due or gone:
            self.spark.createDataFrame(sorted(now.items()), _BUILT).coalesce(1).write.mode("overwrite").parquet(self.built)
        return sorted(due | gone)
