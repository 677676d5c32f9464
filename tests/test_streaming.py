from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark import schemas as S
from tallyspark.operators.staging import stage_billing, stage_customers
from tallyspark.session import fresh_dir
from tallyspark.sources.fixtures import sources
from tallyspark.sources.sinks import VersionedTable
from tallyspark.streaming.feeds import apply_changes, billing_file_stream, customer_change_stream, customer_table

from .conftest import customers_rows


def test_billing_file_stream_two_batches_equals_batch_load(spark):
    src = sources(spark, "/root/testdata/sf0.001")[P.SRC_BILLING]
    landing = fresh_dir(spark, "landing")
    early = F.col("transaction_date") < "1998-01-01"
    src.where(early).write.parquet(f"{landing}/part1")
    target = VersionedTable(spark, fresh_dir(spark, "stg_billing_stream"), S.STG_BILLING)
    ckpt = fresh_dir(spark, "ckpt")
    billing_file_stream(spark, f"{landing}/*", target, ckpt).awaitTermination()
    assert target.read().count() == stage_billing(src.where(early)).count()
    src.where(~early).write.parquet(f"{landing}/part2")
    billing_file_stream(spark, f"{landing}/*", target, ckpt).awaitTermination()
    # insert-if-absent across batches: a transaction keeps the version loaded first
    expected = stage_billing(src.where(early)).unionByName(
        stage_billing(src.where(~early)).join(stage_billing(src.where(early)).select("transaction_id"),
                                              "transaction_id", "left_anti"))
    got = target.read()
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


def test_change_of_one_customer_rewrites_one_bucket(spark, make):
    feed = lambda *rows: make(S.SRC_CUSTOMERS, customers_rows(*((i, n, "a@b", "NG", at) for i, n, at in rows)))
    t = customer_table(spark, fresh_dir(spark, "buckets"), 8)
    t.upsert(stage_customers(feed(*((str(k), "old", "2024-01-10 00:00:00") for k in range(60)))))
    before = t.files()
    assert len(before) == 8
    change = feed(("7", "new", "2024-01-11 00:00:00"), ("7", "newer", "2024-01-12 00:00:00"))
    touched = apply_changes(t, change)
    after = t.files()
    assert len(touched) == 1 and {p for p in after if after[p] != before[p]} == set(touched)
    assert apply_changes(t, change) == [] and t.files() == after                 # a replay writes nothing
    apply_changes(t, feed(("7", "late", "2024-01-01 00:00:00"), ("8", "undated", None), ("99", "added", "2020-01-01 00:00:00")))
    names = {r["customer_id"]: r["customer_name"] for r in t.read().collect()}
    assert (names["7"], names["8"], names["99"], names["9"], len(names)) == ("Newer", "Undated", "Added", "Old", 61)
    stamps = {r["customer_id"]: r["staged_at"] for r in t.read().collect()}
    apply_changes(t, change)                                                     # an older batch again: no row changes
    assert {r["customer_id"]: r["staged_at"] for r in t.read().collect()} == stamps


def test_change_stream_in_micro_batches(spark, make):
    feed_dir = fresh_dir(spark, "change-feed")
    for at, name in (("2024-01-03 00:00:00", "third"), ("2024-01-01 00:00:00", "first")):
        make(S.SRC_CUSTOMERS, customers_rows(("1", name, "a@b", "NG", at))).coalesce(1).write.mode("append").parquet(feed_dir)
    t = customer_table(spark, fresh_dir(spark, "stream-buckets"), 4)
    customer_change_stream(spark, feed_dir, t, fresh_dir(spark, "ckpt"), max_files_per_trigger=1).awaitTermination()
    assert [(r["customer_id"], r["customer_name"]) for r in t.read().collect()] == [("1", "Third")]
