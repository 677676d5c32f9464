import datetime as dt

from tallyspark import schemas as S
from tallyspark.operators.incremental import incremental_billing
from tallyspark.operators.merge import upsert
from tallyspark.operators.staging import stage_billing
from tallyspark.session import fresh_dir
from tallyspark.sources.sinks import VersionedTable

from .conftest import billing_rows


def test_upsert_replaced_added_kept(spark, make):
    target = stage_billing(make(S.SRC_BILLING, billing_rows(("a", "1", "1.00", "2024-01-01 00:00:00"),
                                                            ("b", "1", "2.00", "2024-01-01 00:00:00"))))
    incoming = stage_billing(make(S.SRC_BILLING, billing_rows(("b", "1", "9.00", "2024-01-02 00:00:00"),
                                                              ("c", "1", "3.00", "2024-01-02 00:00:00"))))
    got = {r["transaction_id"]: str(r["amount"]) for r in upsert(target, incoming, "transaction_id").collect()}
    assert got == {"a": "1.00", "b": "9.00", "c": "3.00"}
    kept = {r["transaction_id"]: str(r["amount"]) for r in
            upsert(target, incoming, "transaction_id", "ignore").collect()}
    assert kept == {"a": "1.00", "b": "2.00", "c": "3.00"}


def test_incremental_rerun_is_noop_and_keeps_loaded_version(spark, make):
    src = make(S.SRC_BILLING, billing_rows(("a", "1", "1.00", "1998-04-30 10:00:00"),
                                           ("a", "1", "7.00", "1998-05-01 10:00:00"),
                                           ("b", "1", "2.00", "1998-05-02 10:00:00")))
    table = VersionedTable(spark, fresh_dir(spark, "t-inc"), S.STG_BILLING)
    table.commit(stage_billing(src.where("transaction_date < '1998-05-01'")))
    for _ in range(2):
        table.commit(incremental_billing(table.read(), src, dt.date(1998, 5, 1), dt.date(1998, 6, 1)))
        got = {r["transaction_id"]: str(r["amount"]) for r in table.read().collect()}
        assert got == {"a": "1.00", "b": "2.00"}


def test_versioned_table_reads_empty_then_latest(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-ver"), S.AGG_ARPU)
    assert t.read().count() == 0
    t.commit(spark.createDataFrame([("1", None, 0)], S.AGG_ARPU))
    t.commit(spark.createDataFrame([("1", None, 0), ("2", None, 1)], S.AGG_ARPU))
    assert t.read().count() == 2


def test_append_then_compact(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-append"), S.AGG_ARPU)
    for i in range(3):
        t.append(spark.createDataFrame([(str(i), None, i)], S.AGG_ARPU), compact_after=2)
    assert len(t.current_paths()) == 1                  # folded on the third append
    assert sorted(r[0] for r in t.read().collect()) == ["0", "1", "2"]


def test_interrupted_commit_keeps_history(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-cut"), S.AGG_ARPU)
    t.commit(spark.createDataFrame([("1", None, 0)], S.AGG_ARPU))
    broken = t._folder(2, "full")                       # written, but never marked
    spark.createDataFrame([("x", None, 0)], S.AGG_ARPU).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    assert [r[0] for r in t.read().collect()] == ["1"]
    t.append(spark.createDataFrame([("2", None, 0)], S.AGG_ARPU))
    assert sorted(r[0] for r in t.read().collect()) == ["1", "2"]


def test_old_runs_are_deleted(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-old"), S.AGG_ARPU)
    for i in range(5):
        t.commit(spark.createDataFrame([(str(i), None, i)], S.AGG_ARPU))
    assert len(t._runs()) == 2 and t.read().first()[0] == "4"


def test_partitioned_refresh_keeps_nothing_stale(spark):
    from tallyspark.sources.sinks import overwrite, replace_partitions
    path = fresh_dir(spark, "t-part")
    overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k int, d string"), path, ["d"])
    overwrite(spark.createDataFrame([(1, "b")], "k int, d string"), path, ["d"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "b")]
    replace_partitions(spark.createDataFrame([(3, "c")], "k int, d string"), path, ["d"])
    assert spark.read.parquet(path).count() == 2


def test_upsert_evaluates_each_side_once(spark, make):
    target = make("k int, v string", [(1, "old"), (2, "kept"), (None, "null")])
    new = make("k int, v string", [(1, "new"), (3, "added")])
    assert sorted(map(str, upsert(target, new, "k").collect())) == sorted(
        map(str, make("k int, v string", [(1, "new"), (2, "kept"), (3, "added"), (None, "null")]).collect()))
    plan = upsert(target, new, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and "LeftAnti" not in plan


def test_late_older_change_leaves_the_newer_row(spark):
    from tallyspark import schemas as S
    from tallyspark.operators.incremental import apply_customer_changes
    from tallyspark.operators.staging import stage_customers
    raw = "customer_id string, name string, email string, country string, created_at string, ingested_at timestamp_ntz"

    def feed(*rows):
        return spark.createDataFrame([(i, n, "a@b.c", None, d, None) for i, n, d in rows], raw)
    target = stage_customers(feed(("1", "march", "2024-03-01 00:00:00"), ("2", "undated", None),
                                  ("3", "kept", "2024-01-01 00:00:00")))
    got = apply_customer_changes(target, feed(("1", "january", "2024-01-01 00:00:00"), ("2", "dated", "2024-01-01 00:00:00"),
                                              ("4", "added", None)))
    assert got.columns == S.STG_CUSTOMERS.names
    assert {r["customer_id"]: r["customer_name"] for r in got.collect()} == {
        "1": "March", "2": "Dated", "3": "Kept", "4": "Added"}


def test_reconciliation_recomputes_recent_days_only(spark):
    import datetime as dt
    from decimal import Decimal as D
    from tallyspark.operators.aggregates import reconcile_daily
    stored = spark.createDataFrame([("1", dt.date(2024, 1, 1), D(5), 1), ("1", dt.date(2024, 1, 9), D(7), 1), ("1", None, D(2), 1)],
                                   "customer_id string, day date, revenue decimal(22,2), n bigint")
    stg = spark.createDataFrame([("1", D(100), dt.datetime(2024, 1, 1, 10)), ("1", D(9), dt.datetime(2024, 1, 9, 10))],
                                "customer_id string, amount decimal(12,2), transaction_date timestamp")
    got = {(r["day"], int(r["revenue"])) for r in reconcile_daily(stored, stg, dt.date(2024, 1, 8)).collect()}
    assert got == {(dt.date(2024, 1, 1), 5), (None, 2), (dt.date(2024, 1, 9), 9)}
