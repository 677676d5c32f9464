"""Apply change feeds arriving as files with Structured Streaming.

Each micro-batch is handed to the same batch operator the daily job uses (latest change per
key + upsert, or window staging + insert-if-absent). Customer changes go to a table in buckets of the key's hash, of
which a micro-batch reads and rewrites those that its own keys fall into; billing files are appended. Both merges are idempotent, so
a micro-batch replayed after a failure (the checkpoint has not recorded it yet) leaves the target unchanged: effectively exactly-once.
No streaming state is kept: dedup across batches happens against the target table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import params as P
from .. import schemas as S
from ..operators.incremental import latest_changes
from ..operators.staging import stage_billing
from ..sources.partitioned import PartitionedTable
from ..sources.sinks import VersionedTable


COMPACT_AFTER = 64              # deltas before they are folded into one run
BUCKETS = 64                    # of a customer table; a bucket should be one task's work


def customer_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> PartitionedTable:
    """The staged customers in key buckets, as a change feed maintains them."""
    return PartitionedTable(spark, root, S.STG_CUSTOMERS, "customer_id", buckets=buckets)


def apply_changes(target: PartitionedTable, feed: DataFrame, as_of: dt.datetime | None = None) -> list[str]:
    """Apply a batch of customer changes; the buckets that were rewritten. The latest change of each customer counts; one that is older
    than the stored row (both dated) leaves that row as it is, and one that changes nothing leaves its ``staged_at``."""
    return target.upsert(latest_changes(feed, as_of), stamp="staged_at", newest_by="created_at")


def customer_change_stream(spark: SparkSession, feed_dir: str, target: PartitionedTable,
                           checkpoint: str, as_of: dt.datetime | None = None,
                           available_now: bool = True, max_files_per_trigger: int | None = None
                           ) -> StreamingQuery:
    reader = spark.readStream.schema(S.SRC_CUSTOMERS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    feed = reader.parquet(feed_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        apply_changes(target, batch, as_of)

    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def billing_file_stream(spark: SparkSession, landing_dir: str, target: VersionedTable,
                        checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """New billing files -> staged (latest version per transaction within the batch) ->
    insert-if-absent into stg_billing (a transaction already loaded keeps its version)."""
    feed = spark.readStream.schema(S.SRC_BILLING).parquet(landing_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        # insert-only: append the batch's transactions the target does not hold yet. A replayed
        # batch finds its rows already present and appends nothing.
        new = stage_billing(batch).join(target.read().select("transaction_id"), "transaction_id", "left_anti")
        target.append(new, compact_after=COMPACT_AFTER)

    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
