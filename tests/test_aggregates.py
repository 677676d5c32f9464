from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import aggregates as A
from tallyspark.operators import staging as ST
from tallyspark.plans.pipeline import build_stages, warehouse
from tallyspark.sources.fixtures import sources

from .conftest import billing_rows, customers_rows


def _arpu(make, billing):
    cust = ST.stage_customers(make(S.SRC_CUSTOMERS, customers_rows(
        ("1", "a", "a@x", "NG", "2021-01-01 00:00:00"), ("2", "b", "b@x", "NG", "2021-01-01 00:00:00"))))
    bill = ST.stage_billing(make(S.SRC_BILLING, billing_rows(*billing)))
    cm = A.billing_customer_month(bill)
    return {r["customer_id"]: (r["arpu"], r["active_months"]) for r in A.agg_arpu(cust, cm).collect()}, cm


def test_arpu_two_months(make):
    got, _ = _arpu(make, [("t1", "1", "10.00", "2024-01-05 00:00:00"), ("t2", "1", "5.00", "2024-02-05 00:00:00")])
    assert got["1"] == (Decimal("7.50"), 2)
    assert got["2"] == (Decimal("0.00"), 0)          # no activity -> 0, still present


def test_arpu_rounds_half_up(make):
    got, _ = _arpu(make, [("t1", "1", "10.05", "2024-01-05 00:00:00"), ("t2", "1", "0.00", "2024-02-05 00:00:00")])
    assert got["1"] == (Decimal("5.03"), 2)


def test_arpu_null_month_adds_revenue_not_months(make):
    got, cm = _arpu(make, [("t1", "1", "10.00", "2024-05-05 00:00:00"), ("t2", "1", "5.00", None)])
    assert got["1"] == (Decimal("15.00"), 1)
    months = {r["revenue_month"] for r in A.agg_monthly_revenue(cm).collect()}
    assert None in months                            # the NULL month is its own group


def test_fixture_properties(spark):
    st = build_stages(sources(spark, "/root/testdata/sf0.001"))
    rev = st.agg_user_revenue.agg(F.sum("total_revenue")).first()[0]
    monthly = st.agg_monthly_revenue.agg(F.sum("monthly_revenue")).first()[0]
    staged = st.stg_billing.agg(F.sum("amount")).first()[0]
    assert rev == monthly == staged == Decimal("1342875.44")      # FIXTURES.md section 3
    dist = st.agg_session_distribution.join(A.agg_user_usage(st.stg_sessions), "customer_id")
    assert dist.where(F.col("short_sessions") + F.col("medium_sessions") + F.col("long_sessions")
                      != F.col("total_sessions")).count() == 0
    buckets = {r["bucket"]: r["count"] for r in st.session_buckets.groupBy("bucket").count().collect()}
    assert buckets == {"short": 212, "medium": 410, "long": 363}
    dw = warehouse(st)
    assert dw.count() == st.stg_customers.count() == 149


def test_orphan_in_revenue_not_in_warehouse(make):
    cust = make(S.SRC_CUSTOMERS, customers_rows(("1", "a", "a@x", "NG", "2021-01-01 00:00:00")))
    bill = make(S.SRC_BILLING, billing_rows(("t1", "1", "1.00", "2024-01-01 00:00:00"),
                                            ("t2", "9", "2.00", "2024-01-01 00:00:00")))
    sess = make(S.SRC_SESSIONS, [])
    st = build_stages({"src_customers": cust, "src_billing_transactions": bill, "src_network_sessions": sess})
    assert {r[0] for r in st.agg_user_revenue.select("customer_id").collect()} == {"1", "9"}
    dw = warehouse(st).collect()
    assert [r["customer_id"] for r in dw] == ["1"]
    assert dw[0]["total_sessions"] == 0 and dw[0]["avg_data_per_session_mb"] == Decimal("0.00")
