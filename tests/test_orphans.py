"""Revenue of unknown customers: booked, released once, the same totals as a rebuild."""

import datetime as dt

from tallyspark import schemas as S
from tallyspark.operators import daily_state as DS
from tallyspark.operators.orphans import OrphanRevenue
from tallyspark.operators.staging import stage_billing, stage_customers
from tallyspark.plans.pipeline import run_pipeline
from tallyspark.session import fresh_dir
from tallyspark.sources.partitioned import PartitionedTable

from .conftest import billing_rows, customers_rows

BILLS = [("a", "1", "1.00", "2024-03-01 10:00:00"), ("b", "2", "2.00", "2024-03-05 10:00:00"), ("c", "2", "4.00", "2024-04-01 10:00:00"),
         ("d", "3", "8.00", None), ("e", "3", "16.00", "2024-04-02 10:00:00"), ("f", None, "32.00", "2024-04-02 10:00:00")]


def known(make, *ids):
    return make(S.SRC_CUSTOMERS, customers_rows(*((i, "a b", "x@y", None, "2024-01-01 00:00:00") for i in ids)))


def lines(orphans):
    return sorted((r["customer_id"], str(r["day"]), float(r["revenue"]), r["status"]) for r in orphans.read().collect())


def test_lines_follow_the_state_and_are_released_once(spark, make):
    table = PartitionedTable(spark, fresh_dir(spark, "facts"), S.STG_BILLING, "transaction_id", "transaction_date")
    table.upsert(stage_billing(make(S.SRC_BILLING, billing_rows(*BILLS))))
    state = DS.DailyState(spark, fresh_dir(spark, "state"), table, DS.BILLING_STATE, DS.billing_days)
    orphans = OrphanRevenue(spark, fresh_dir(spark, "orphans"), state)
    assert orphans.placeholder_months().count() == 0 and orphans.release(stage_customers(known(make, "1"))) == []
    state.refresh()
    one, two = stage_customers(known(make, "1")), stage_customers(known(make, "1", "2"))
    assert orphans.book(one) == ["2024-03", "2024-04", "none"] and orphans.book(one) == []
    assert lines(orphans) == [("2", "2024-03-05", 2.0, "open"), ("2", "2024-04-01", 4.0, "open"),
                              ("3", "2024-04-02", 16.0, "open"), ("3", "None", 8.0, "open")]
    before = orphans.files()
    assert orphans.release(two) == ["2024-03", "2024-04"] and orphans.release(two) == []
    assert orphans.files()["none"] == before["none"]
    # a load of April books that month anew; what was released stays on record, and is not opened again
    opened = {(r["customer_id"], r["day"]): r["opened_at"] for r in orphans.read().collect()}
    table.upsert(stage_billing(make(S.SRC_BILLING, billing_rows(("g", "2", "64.00", "2024-04-03 10:00:00"), ("h", "3", "1.00", "2024-04-02 11:00:00")))))
    state.refresh()
    assert orphans.book(two) == ["2024-04"]
    assert lines(orphans) == [("2", "2024-03-05", 2.0, "released"), ("2", "2024-04-01", 4.0, "released"),
                              ("3", "2024-04-02", 17.0, "open"), ("3", "None", 8.0, "open")]
    assert all(opened[r["customer_id"], r["day"]] == r["opened_at"] for r in orphans.read().collect())
    months = {str(r["revenue_month"]): (r["customer_id"], float(r["revenue"]), r["n"]) for r in orphans.placeholder_months().collect()}
    assert months == {"2024-04-01": ("UNKNOWN", 17.0, 2), "None": ("UNKNOWN", 8.0, 1)}


def test_partition_without_orphans_left_has_no_lines(spark, make):
    table = PartitionedTable(spark, fresh_dir(spark, "facts"), S.STG_BILLING, "transaction_id", "transaction_date")
    table.upsert(stage_billing(make(S.SRC_BILLING, billing_rows(("a", "9", "1.00", "2024-03-01 10:00:00"), ("b", "9", "1.00", "2024-04-01 10:00:00")))))
    state = DS.DailyState(spark, fresh_dir(spark, "state"), table, DS.BILLING_STATE, DS.billing_days)
    orphans = OrphanRevenue(spark, fresh_dir(spark, "orphans"), state)
    nobody = stage_customers(known(make))
    state.refresh()
    orphans.book(nobody)
    table.upsert(stage_billing(make(S.SRC_BILLING, billing_rows(("a", None, "1.00", "2024-03-01 10:00:00"), ("b", "9", "3.00", "2024-04-01 10:00:00")))))
    state.refresh()                       # transaction a lost its customer: the row is not staged, the stored one stays
    table.upsert(stage_billing(make(S.SRC_BILLING, billing_rows(("a", "9", "1.00", "2024-05-01 10:00:00")))))
    assert state.refresh() == ["2024-03", "2024-05"] and orphans.book(nobody) == ["2024-03", "2024-04", "2024-05"]
    assert lines(orphans) == [("9", "2024-04-01", 3.0, "open"), ("9", "2024-05-01", 1.0, "open")]


def test_second_day_equals_a_rebuild(spark, make):
    sessions = make(S.SRC_SESSIONS, [])
    day = lambda bills, *ids: {"src_customers": known(make, *ids), "src_billing_transactions": make(S.SRC_BILLING, billing_rows(*bills)),
                               "src_network_sessions": sessions}
    new = [("n1", "2", "5.00", "2024-05-17 09:00:00"), ("n2", "4", "7.00", "2024-05-17 10:00:00")]
    out, as_of = fresh_dir(spark, "two-days"), dt.datetime(2024, 5, 18, 3)
    first = run_pipeline(spark, day(BILLS, "1"), out, billing_mode="full", as_of=as_of, unknown_customer=True)
    assert all(v == "ok" for v in first.status.values()), first.status
    revenue = lambda res: {r["customer_id"]: (float(r["total_revenue"]), r["total_transactions"]) for r in res.read(spark, "dw_user_analytics").collect()}
    assert revenue(first) == {"1": (1.0, 1), "UNKNOWN": (30.0, 4)}
    runs = [run_pipeline(spark, day(BILLS + new, "1", "2"), out, dt.date(2024, 5, 17), dt.date(2024, 5, 18), as_of=as_of, unknown_customer=True)
            for _ in range(2)]
    full = run_pipeline(spark, day(BILLS + new, "1", "2"), fresh_dir(spark, "rebuild"), billing_mode="full", as_of=as_of, unknown_customer=True)
    assert revenue(runs[0]) == revenue(runs[1]) == revenue(full) == {"1": (1.0, 1), "2": (11.0, 3), "UNKNOWN": (31.0, 3)}
    assert runs[0].refreshed["orphans_released"] == ["2024-03", "2024-04"] and runs[1].refreshed["orphans_released"] == []
    assert runs[1].refreshed["orphan_revenue"] == []
    for name in ("dw_user_analytics",):
        a, b = runs[1].read(spark, name), full.read(spark, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
