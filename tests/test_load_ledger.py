"""Ledger, planned backfills, volume of loads, and the run's optional steps."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark import schemas as S
from tallyspark.operators import load_ledger as LL
from tallyspark.plans.pipeline import run_pipeline
from tallyspark.session import fresh_dir
from tallyspark.sources.partitioned import PartitionedTable

D = dt.date


def source(spark, rows):
    """(id, date text, day of ingestion in May)"""
    from decimal import Decimal
    return spark.createDataFrame([(i, "c1", Decimal("1.00"), d, dt.datetime(2024, 5, k, 2)) for i, d, k in rows], S.SRC_BILLING)


def new(spark):
    return (PartitionedTable(spark, fresh_dir(spark, "t"), S.STG_BILLING, "transaction_id", "transaction_date", "day"),
            LL.LoadLedger(spark, fresh_dir(spark, "ledger")))


def test_backfill_is_planned_from_late_rows_and_run_once(spark):
    table, ledger = new(spark)
    rows = [("a", "2024-05-01 10:00:00", 2), ("b", "2024-05-02 10:00:00", 3), ("c", "2024-05-04 10:00:00", 5), ("x", "2024-04-01 10:00:00", 9)]
    for day in range(1, 5):                                  # four daily loads at 03:00 of the day after
        as_of = dt.datetime(2024, 5, day + 1, 3)
        src = source(spark, [r for r in rows if r[2] <= day + 1])
        got = LL.load_window(table, ledger, src, D(2024, 5, day), D(2024, 5, day + 1), as_of)
        assert got == {"rows": int(day != 3), "inserted": int(day != 3)}
    again = LL.load_window(table, ledger, source(spark, rows), D(2024, 5, 4), D(2024, 5, 5), dt.datetime(2024, 5, 5, 4))
    assert again == {"rows": 1, "inserted": 0}
    late = [("l1", "2024-05-01 11:00:00", 7), ("l2", "2024-05-02 11:00:00", 7), ("l3", "2024-05-04 23:00:00", 8), ("l4", None, 8), ("l5", "2024-05-30 01:00:00", 8)]
    src = source(spark, rows + late)
    assert LL.plan_backfill(src, ledger, dt.datetime(2024, 5, 6)) == []                  # not ingested yet
    as_of = dt.datetime(2024, 5, 9, 3)
    assert {(r["day"], r["late_rows"]) for r in LL.late_days(src, ledger, as_of).collect()} == {(D(2024, 5, 1), 1), (D(2024, 5, 2), 1), (D(2024, 5, 4), 1)}
    assert LL.run_backfill(table, ledger, src, as_of) == [(D(2024, 5, 1), D(2024, 5, 3)), (D(2024, 5, 4), D(2024, 5, 5))]
    assert LL.plan_backfill(src, ledger, as_of) == [] and LL.run_backfill(table, ledger, src, as_of) == []
    assert sorted(r["transaction_id"] for r in table.read().collect()) == ["a", "b", "c", "l1", "l2", "l3"]


def test_volume_reads_the_ledger_and_a_rerun_replaces_its_line(spark):
    table, ledger = new(spark)
    for day, n in enumerate([100, 104, 98, 101, 99, 102, 100, 3, 100], 1):
        ledger.record("stg_billing", D(2024, 5, day), D(2024, 5, day + 1), dt.datetime(2024, 5, day + 1, 3), n, n)
    odd = lambda: [r["day"] for r in LL.load_volume(ledger).where("is_anomaly").collect()]
    assert odd() == [D(2024, 5, 8)]
    ledger.record("stg_billing", D(2024, 5, 8), D(2024, 5, 9), dt.datetime(2024, 5, 12, 3), 101, 98)
    assert odd() == []
    assert LL.load_volume(LL.LoadLedger(spark, fresh_dir(spark, "none"))).count() == 0


def test_run_with_gate_and_monitoring(spark, make):
    from .conftest import customers_rows
    cust = make(S.SRC_CUSTOMERS, customers_rows(("c1", "a", "b", None, None)))
    rows = [("a", "2024-05-01 10:00:00", 2), ("b", "2024-05-02 10:00:00", 3)]
    day = lambda r: {P.SRC_CUSTOMERS: cust, P.SRC_SESSIONS: make(S.SRC_SESSIONS, []), P.SRC_BILLING: source(spark, r)}
    out = fresh_dir(spark, "monitored")
    few = run_pipeline(spark, day(rows[:1]), out, D(2024, 5, 1), D(2024, 5, 2), as_of=dt.datetime(2024, 5, 2, 3), gate_min_rows=2)
    assert few.status["row_gate"].startswith("failed") and few.status["stage_billing"].startswith("skipped")
    first = run_pipeline(spark, day(rows[:1]), out, D(2024, 5, 1), D(2024, 5, 2), as_of=dt.datetime(2024, 5, 2, 3), gate_min_rows=1, monitor=True)
    assert all(v == "ok" for v in first.status.values()), first.status
    assert first.metrics["stg_billing"] == {"rows": 1, "inserted": 1} and first.metrics["stg_customers"]["rows"] == 1
    orphan = source(spark, [("o", "2024-05-02 12:00:00", 3)]).withColumn("customer_id", F.lit("nobody"))
    srcs = day(rows + [("late", "2024-05-01 23:00:00", 3)])
    srcs[P.SRC_BILLING] = srcs[P.SRC_BILLING].unionByName(orphan)
    second = run_pipeline(spark, srcs, out, D(2024, 5, 2), D(2024, 5, 3), as_of=dt.datetime(2024, 5, 3, 3), monitor=True)
    assert all(v == "ok" for v in second.status.values()), second.status
    assert second.refreshed["backfill"] == ["2024-05-01/2024-05-02"]
    fresh = second.read(spark, "check_freshness").first()
    assert fresh["max_transaction_date"] == dt.datetime(2024, 5, 2, 12) and not fresh["is_stale"]
    assert [r["loads"] for r in second.read(spark, "check_volume").orderBy("day").collect()] == [2, 2]
    assert {r["issue_type"] for r in second.read(spark, "quarantine").collect()} == {P.ISSUE_BILLING_ORPHAN}
    audit = second.read(spark, "pipeline_audit_log").orderBy("created_at").collect()
    assert [r["billing_rows"] for r in audit] == [1, 4] and audit[-1]["customer_rows"] == 1
