"""Ad-hoc business questions over ``dw_user_analytics`` / ``agg_monthly_revenue``.

Time is an explicit ``as_of`` argument (the reference reads the wall clock), so results are
reproducible; pass ``None`` for the current time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..operators.staging import _ts


def _now(as_of: dt.datetime | None):
    return _ts(as_of, ntz=True)


def q1_top_customers(dw: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by revenue (a per-task top-k then one merge: TakeOrderedAndProject)."""
    return (dw.select("customer_id", "customer_name", "country", "total_revenue",
                      "total_transactions", "arpu", "total_sessions")
            .orderBy(F.col("total_revenue").desc(), F.col("customer_id").asc())
            .limit(k))


def q2_churn_risk(dw: DataFrame, as_of: dt.datetime | None = None,
                  max_sessions: int = P.CHURN_MAX_SESSIONS, max_revenue: int = P.CHURN_MAX_REVENUE,
                  min_tenure_days: int = P.CHURN_MIN_TENURE_DAYS) -> DataFrame:
    now = _now(as_of)
    cutoff = now - F.make_dt_interval(F.lit(min_tenure_days))
    return (dw.where((F.col("total_sessions") < max_sessions)
                     & (F.col("total_revenue") < max_revenue)
                     & (F.col("customer_since") < cutoff))
            .select("customer_id", "customer_name", "email", "total_sessions", "total_revenue",
                    "customer_since",
                    F.datediff(now.cast("date"), F.to_date("customer_since")).alias("days_since_registration"))
            .orderBy("total_revenue", "total_sessions", "customer_id"))


def revenue_usage_flag():
    data, rev = F.col("total_data_used_mb"), F.col("total_revenue")
    high = (data > P.HIGH_USAGE_MB) & (rev < P.LOW_SPEND_REVENUE)
    low = (data < P.LOW_USAGE_MB) & (rev > P.HIGH_SPEND_REVENUE)
    return high, low


def q3_revenue_usage_mismatch(dw: DataFrame) -> DataFrame:
    high, low = revenue_usage_flag()
    flag = (F.when(high, F.lit(P.FLAG_HIGH_USAGE)).when(low, F.lit(P.FLAG_LOW_USAGE))
            .otherwise(F.lit(P.FLAG_NORMAL)))
    return (dw.where(high | low)
            .select("customer_id", "customer_name", "total_revenue", "total_data_used_mb",
                    "avg_data_per_session_mb", flag.alias("revenue_usage_flag"))
            .orderBy(F.col("revenue_usage_flag").asc(), F.col("total_revenue").desc(),
                     F.col("customer_id").asc()))


def q4_monthly_trend(monthly: DataFrame) -> DataFrame:
    """Revenue and active customers per month.

    ``agg_monthly_revenue`` is keyed by (customer_id, revenue_month), so COUNT(DISTINCT
    customer_id) within a month equals COUNT(customer_id): one partial+final aggregate
    instead of the two-exchange distinct plan.
    """
    return (monthly.groupBy("revenue_month")
            .agg(F.sum("monthly_revenue").alias("total_monthly_revenue"),
                 F.count("customer_id").alias("active_customers"))
            .orderBy(F.col("revenue_month").asc_nulls_last()))


def q5_session_mix(dw: DataFrame) -> DataFrame:
    total = F.nullif(F.col("total_sessions"), F.lit(0))

    def pct(c: str):
        return F.round(F.lit(100.0) * F.col(c).cast("double") / total, 1)

    return (dw.where(F.col("total_sessions") > 0)
            .select("customer_id", "customer_name", "short_sessions", "medium_sessions",
                    "long_sessions", "total_sessions",
                    pct("long_sessions").alias("pct_long"), pct("short_sessions").alias("pct_short"))
            .orderBy(F.col("pct_long").desc(), F.col("customer_id").asc()))


def churn_by_rate(dw: DataFrame, as_of: dt.datetime | None = None,
                  sessions_per_week: int = P.CHURN_SESSIONS_PER_WEEK,
                  revenue_per_week: int = P.CHURN_REVENUE_PER_WEEK) -> DataFrame:
    """Tenure-normalised churn: < 1 session and < 250 revenue per week since registration.

    Compared exactly in integers/decimals: sessions/(days/7) < r  <=>  7*sessions < r*days.
    Customers with no tenure yet (0 days, or NULL registration) are not rated.
    """
    now = _now(as_of)
    days = F.datediff(now.cast("date"), F.to_date("customer_since"))
    return (dw.withColumn("days_since_registration", days)
            .where((F.col("days_since_registration") > 0)
                   & (F.col("total_sessions") * 7 < F.col("days_since_registration") * sessions_per_week)
                   & (F.col("total_revenue") * 7 < F.col("days_since_registration") * revenue_per_week))
            .select("customer_id", "customer_name", "total_sessions", "total_revenue",
                    "days_since_registration"))
