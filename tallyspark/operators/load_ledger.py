"""What was loaded when: a ledger of loaded windows, backfills planned from it, and the volume check on it.

Each load of a date window appends a line: the window, the time of the load, the rows that the source held for it, and those that were new. Rows of a
loaded day that were ingested after the last load of that day arrived late: their days, joined to windows where they follow each
other, are what a backfill reruns. Reruns insert only absent keys, so each is idempotent. Work grows with the late rows' days
and the ledger, not with the facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..session import fresh_dir
from ..sources.partitioned import PartitionedTable
from ..sources.readers import read_or_empty
from ..sources.sinks import observed, write_counted
from .quality import anomalies
from .staging import _ts, stage_billing_window

LEDGER = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("window_start", T.DateType()),
                       T.StructField("window_end", T.DateType()), T.StructField("loaded_at", T.TimestampType()),
                       T.StructField("rows", T.LongType()), T.StructField("inserted", T.LongType())])


class LoadLedger:
    """An append-only table; the last line of a window is the one that counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.root, LEDGER)

    def record(self, table: str, start: dt.date, end: dt.date, as_of: dt.datetime | None, rows: int, inserted: int) -> None:
        line = self.spark.createDataFrame([(table, start, end, rows, inserted)], "table_name string, window_start date, window_end date, rows bigint, inserted bigint")
        (line.select("table_name", "window_start", "window_end", _ts(as_of).alias("loaded_at"), "rows", "inserted")
         .coalesce(1).write.mode("append").parquet(self.root))

    def days(self, table: str) -> DataFrame:
        """(day, seen): the last load of each day of a loaded window."""
        return (self.read().where(F.col("table_name") == table)
                .select(F.explode(F.sequence("window_start", F.date_sub("window_end", 1))).alias("day"), "loaded_at")
                .groupBy("day").agg(F.max("loaded_at").alias("seen")))


def load_window(table: PartitionedTable, ledger: LoadLedger, src_billing: DataFrame, start: dt.date, end: dt.date,
                as_of: dt.datetime | None = None, iso_text: bool = False) -> dict[str, int]:
    """Insert the absent rows of [start, end) and write the ledger's line; rows are counted while they are written, those of the window
    aside first."""
    path, new = fresh_dir(table.spark, "window"), Observation()
    offered = write_counted(stage_billing_window(src_billing, start, end, iso_text=iso_text), path)
    table.insert(table.spark.read.schema(table.schema).parquet(path), new)
    counts = {"rows": offered, "inserted": observed(new, "rows")}
    ledger.record("stg_billing", start, end, as_of, **counts)
    return counts


def late_days(src_billing: DataFrame, ledger: LoadLedger, as_of: dt.datetime | None = None) -> DataFrame:
    """(day, late_rows, first_ingested): loaded days of which the source holds rows that came in after their last load, by ``as_of``."""
    rows = (src_billing.where(F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull())
            .select(F.to_date(F.col("transaction_date").cast("timestamp")).alias("day"), F.col("ingested_at").cast("timestamp").alias("ingested_at"))
            .where(F.col("ingested_at") <= _ts(as_of)))
    per_hour = rows.groupBy("day", "ingested_at").agg(F.count(F.lit(1)).alias("n"))      # partial counts before the join
    return (per_hour.join(ledger.days("stg_billing"), "day").where(F.col("ingested_at") > F.col("seen"))
            .groupBy("day").agg(F.sum("n").alias("late_rows"), F.min("ingested_at").alias("first_ingested")))


def plan_backfill(src_billing: DataFrame, ledger: LoadLedger, as_of: dt.datetime | None = None) -> list[tuple[dt.date, dt.date]]:
    """The windows to rerun: late days, those that follow each other as one window. The list has a day for each loaded day at most."""
    out: list[list[dt.date]] = []
    for (day,) in sorted(map(tuple, late_days(src_billing, ledger, as_of).select("day").collect())):
        if out and out[-1][1] == day:
            out[-1][1] = day + dt.timedelta(days=1)
        else:
            out.append([day, day + dt.timedelta(days=1)])
    return [(a, b) for a, b in out]


def run_backfill(table: PartitionedTable, ledger: LoadLedger, src_billing: DataFrame, as_of: dt.datetime | None = None,
                 iso_text: bool = False) -> list[tuple[dt.date, dt.date]]:
    """Rerun what ``plan_backfill`` lists. A rerun that fails is still listed next time."""
    windows = plan_backfill(src_billing, ledger, as_of)
    for start, end in windows:
        load_window(table, ledger, src_billing, start, end, as_of, iso_text)
    return windows


def load_volume(ledger: LoadLedger, table: str = "stg_billing", lookback_days: int = P.VOLUME_LOOKBACK_DAYS, sigmas: int = P.VOLUME_SIGMAS) -> DataFrame:
    """Rows that each day's load offered against the days before: reads the ledger, not the facts. A rerun replaces its window's line; a window of
    several days counts for each in equal parts."""
    last = (ledger.read().where(F.col("table_name") == table)
            .groupBy("window_start", "window_end").agg(F.max_by("rows", "loaded_at").alias("rows")))
    days = F.datediff("window_end", "window_start")
    daily = (last.select(F.explode(F.sequence("window_start", F.date_sub("window_end", 1))).alias("day"), F.floor(F.col("rows") / days).alias("loads"))
             .groupBy("day").agg(F.max("loads").alias("loads")))
    return anomalies(daily, lookback_days, sigmas)
