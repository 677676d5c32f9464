from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import staging as ST

from .conftest import billing_rows, customers_rows, sessions_rows


def test_null_created_at_wins_for_customers(make):
    src = make(S.SRC_CUSTOMERS, customers_rows(
        ("1", "old name", "A@X.com", None, "2024-01-01 00:00:00"),
        ("1", "null dated", "A@X.com", "NG", None)))
    rows = ST.stage_customers(src).collect()
    assert len(rows) == 1 and rows[0]["created_at"] is None
    assert rows[0]["customer_name"] == "Null Dated" and rows[0]["country"] == "NG"


def test_customer_cleaning(make):
    src = make(S.SRC_CUSTOMERS, customers_rows(("7", "ada o'brien", "Ada@MAIL.com", None, "2021-02-03 08:30:00")))
    r = ST.stage_customers(src).first()
    assert (r["customer_name"], r["email"], r["country"]) == ("Ada O'Brien", "ada@mail.com", "Nigeria")


def test_null_date_loses_in_billing(make):
    src = make(S.SRC_BILLING, billing_rows(("t1", "1", "5.00", "2024-01-01 00:00:00"),
                                           ("t1", "1", "9.00", None)))
    r = ST.stage_billing(src).collect()
    assert len(r) == 1 and str(r[0]["amount"]) == "5.00"


def test_billing_filters_and_defaults(make):
    src = make(S.SRC_BILLING, billing_rows(("t1", None, "1.00", "2024-01-01 00:00:00"),
                                           (None, "1", "1.00", "2024-01-01 00:00:00"),
                                           ("t2", "1", None, "2024-01-01 00:00:00")))
    rows = ST.stage_billing(src).collect()
    assert [(r["transaction_id"], str(r["amount"])) for r in rows] == [("t2", "0.00")]


def test_sessions_latest_start_wins_and_duration(make):
    src = make(S.SRC_SESSIONS, sessions_rows(
        ("s1", "1", "2024-01-01 10:00:00", "2024-01-01 10:01:00", "1.00"),
        ("s1", "1", "2024-01-01 11:00:00", "2024-01-01 11:05:00", None)))
    r = ST.stage_sessions(src).collect()
    assert len(r) == 1
    assert r[0]["session_duration_sec"] == 300 and str(r[0]["data_used_mb"]) == "0.00"
    assert str(r[0]["session_date"]) == "2024-01-01"


def test_window_edges(make):
    src = make(S.SRC_BILLING, billing_rows(("a", "1", "1.00", "1998-05-01 00:00:00"),
                                           ("b", "1", "1.00", "1998-06-01 00:00:00"),
                                           ("c", "1", "1.00", "1998-05-31 23:59:59")))
    import datetime as dt
    got = sorted(r[0] for r in ST.stage_billing_window(src, dt.date(1998, 5, 1), dt.date(1998, 6, 1))
                 .select("transaction_id").collect())
    assert got == ["a", "c"]


def test_staged_keys_unique_on_fixture(spark):
    from tallyspark.sources.fixtures import sources
    srcs = sources(spark, "/root/testdata/sf0.001")
    for df, key in [(ST.stage_customers(srcs["src_customers"]), "customer_id"),
                    (ST.stage_billing(srcs["src_billing_transactions"]), "transaction_id"),
                    (ST.stage_sessions(srcs["src_network_sessions"]), "session_id")]:
        assert df.groupBy(key).count().where(F.col("count") > 1).count() == 0
