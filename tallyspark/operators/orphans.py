"""Revenue of customers that the master does not know yet: open until they arrive, then released, once.

For each unknown customer and day a line holds the revenue, and whether it is open or released. The lines follow the daily billing state
partition by partition, so a load books the orphans of the partitions that it changed and looks at no other. While a line is open its revenue counts for
the placeholder customer of the warehouse. When the customer is staged, ``release`` closes the customer's open lines and rewrites their partitions;
the revenue, which lies under the customer's own id in the state all along, then counts there and no more for the placeholder. So totals equal
those of a rebuild from all facts. A run releases before it books; both steps may be run again: booked partitions that did not change, and lines released before, stay.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..session import fresh_dir
from ..sources.partitioned import PART
from .daily_state import DailyState, customer_months
from .staging import _ts

OPEN, RELEASED = "open", "released"
ORPHAN_LINES = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("day", T.DateType()),
                             T.StructField("revenue", T.DecimalType(22, 2)), T.StructField("n", T.LongType()),
                             T.StructField("status", T.StringType()), T.StructField("opened_at", T.TimestampType()),
                             T.StructField("released_at", T.TimestampType())])


class OrphanRevenue(DailyState):
    """Lines of ``billing``, the daily billing state."""

    def __init__(self, spark: SparkSession, root: str, billing: DailyState):
        super().__init__(spark, root, billing, ORPHAN_LINES, lambda days: days)
        self._known: DataFrame | None = None
        self._as_of: dt.datetime | None = None

    def _aside(self, rows: DataFrame) -> DataFrame:
        """``rows`` written elsewhere: they come partly from the partitions that they replace."""
        path = fresh_dir(self.spark, "orphan-lines")
        rows.select(*self.schema.names).write.parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def rows_of(self, parts: set[str]) -> DataFrame:
        """Open lines of the unknown customers of these partitions of the state, and what was released of them before."""
        days, stored = self.facts.read(parts), self.read(parts)
        since = stored.where(F.col("status") == OPEN).select("customer_id", "day", F.col("opened_at").alias("since"))
        unknown = days.select("customer_id", "day", "revenue", "n").join(self._known, "customer_id", "left_anti").alias("u")
        opened = (unknown.join(since.alias("s"), (F.col("u.customer_id") == F.col("s.customer_id")) & F.col("u.day").eqNullSafe(F.col("s.day")), "left")
                  .select("u.customer_id", "u.day", "u.revenue", "u.n", F.lit(OPEN).alias("status"),
                          F.coalesce("since", _ts(self._as_of)).alias("opened_at"), F.lit(None).cast("timestamp").alias("released_at")))
        kept = stored.where(F.col("status") == RELEASED)
        return self._aside(opened.unionByName(kept))

    def book(self, customers: DataFrame, as_of: dt.datetime | None = None) -> list[str]:
        """Open lines for the unknown customers of the state's changed partitions; the partitions that were looked at."""
        self._known = customers.where(F.col("customer_id").isNotNull()).select("customer_id")
        self._as_of = as_of
        return self.refresh()

    def release(self, customers: DataFrame, as_of: dt.datetime | None = None) -> list[str]:
        """Close the open lines of customers that are known now; the partitions that were rewritten."""
        known = customers.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
        open_lines = self.with_parts().where(F.col("status") == OPEN)
        parts = {r[0] for r in open_lines.join(known, "customer_id", "left_semi").select(PART).distinct().collect()}    # a row a partition
        if parts:
            lines = self.read(parts).join(known.withColumn("_known", F.lit(True)), "customer_id", "left")
            now = F.col("_known").isNotNull() & (F.col("status") == OPEN)
            lines = (lines.withColumn("released_at", F.when(now, _ts(as_of)).otherwise(F.col("released_at")))
                     .withColumn("status", F.when(now, F.lit(RELEASED)).otherwise(F.col("status"))))
            self._replace(self._aside(lines), parts)
        return sorted(parts)

    def placeholder_months(self, unknown_id: str = P.UNKNOWN_CUSTOMER_ID) -> DataFrame:
        """(customer_id, revenue_month, revenue, n) of the placeholder: all that is open."""
        lines = self.read().where(F.col("status") == OPEN)
        return customer_months(lines.withColumn("customer_id", F.lit(unknown_id)))
