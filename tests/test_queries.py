import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.plans import analytics as Q


def _dw(spark, rows):
    base = ("n", "e", "NG", dt.datetime(2020, 1, 1), Decimal("0"), 0, Decimal("0"), Decimal("0"), 0,
            Decimal("0"), 0, 0, 0, Decimal("0"), dt.datetime(2024, 2, 1))
    out = []
    for cid, since, sessions, revenue in rows:
        r = list(base)
        r[3], r[8], r[4] = since, sessions, Decimal(revenue)
        out.append((cid, *r))
    return spark.createDataFrame(out, S.DW_USER_ANALYTICS)


def test_churn_tenure_is_strict(spark):
    as_of = dt.datetime(2024, 2, 1)
    dw = _dw(spark, [("exact30", as_of - dt.timedelta(days=30), 0, "0"),
                     ("older", as_of - dt.timedelta(days=31), 4, "999.99"),
                     ("busy", as_of - dt.timedelta(days=300), 5, "0"),
                     ("nulldate", None, 0, "0")])
    got = {r["customer_id"]: r["days_since_registration"] for r in Q.q2_churn_risk(dw, as_of).collect()}
    assert got == {"older": 31}


def test_top_k_has_total_order(spark):
    dw = _dw(spark, [(str(i), dt.datetime(2020, 1, 1), 1, "5.00") for i in range(15)])
    assert [r[0] for r in Q.q1_top_customers(dw).collect()] == sorted(str(i) for i in range(15))[:10]


def test_session_mix_percentages(spark):
    dw = _dw(spark, [("a", dt.datetime(2020, 1, 1), 3, "0")]).withColumn("long_sessions", __import__(
        "pyspark.sql.functions", fromlist=["lit"]).lit(2).cast("bigint"))
    r = Q.q5_session_mix(dw).first()
    assert r["pct_long"] == 66.7 and r["pct_short"] == 0.0


def test_order_of_q2_to_q5(spark):
    as_of, old = dt.datetime(2024, 2, 1), dt.datetime(2020, 1, 1)
    dw = _dw(spark, [("c", old, 2, "20"), ("b", old, 2, "20"), ("a", old, 3, "20"), ("d", old, 4, "10")]).repartition(3)
    assert [r[0] for r in Q.q2_churn_risk(dw, as_of).collect()] == ["d", "b", "c", "a"]
    usage = F.when(F.col("total_revenue") > 5000, 50).otherwise(600).cast("decimal(14,2)")
    dw3 = _dw(spark, [("low", old, 1, "9000"), ("h1", old, 1, "10"), ("h3", old, 1, "90"), ("h2", old, 1, "90")]) \
        .withColumn("total_data_used_mb", usage).repartition(3)
    assert [r[0] for r in Q.q3_revenue_usage_mismatch(dw3).collect()] == ["h2", "h3", "h1", "low"]
    monthly = spark.createDataFrame([("a", dt.date(2024, 3, 1), Decimal("1")), ("a", dt.date(2023, 12, 1), Decimal("2")),
                                     ("b", dt.date(2024, 3, 1), Decimal("4")), ("b", None, Decimal("8"))],
                                    "customer_id string, revenue_month date, monthly_revenue decimal(14,2)").repartition(3)
    assert [r[0] for r in Q.q4_monthly_trend(monthly).collect()] == [dt.date(2023, 12, 1), dt.date(2024, 3, 1), None]
    dw5 = dw.withColumn("long_sessions", F.when(F.col("customer_id") == "d", 4).otherwise(0).cast("bigint"))
    assert [r[0] for r in Q.q5_session_mix(dw5).collect()] == ["d", "a", "b", "c"]
