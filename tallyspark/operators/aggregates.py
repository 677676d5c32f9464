"""Per-customer aggregates.

Billing outputs (revenue, monthly revenue, ARPU) all roll up from one (customer, month)
pre-aggregate: raw rows are scanned and shuffled once, with map-side partial aggregation, and
the per-customer step reads one row per customer-month. Grouping by (customer, month) also
spreads a hot customer over as many reducers as it has months. Session outputs (usage and the
short/medium/long mix) come from one per-customer rollup for the same reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions import bucket_label, month_start, round_ratio


def billing_customer_month(stg_billing: DataFrame) -> DataFrame:
    """(customer_id, revenue_month, revenue, n): the shared billing pre-aggregate."""
    return (stg_billing.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id", month_start(F.col("transaction_date")).alias("revenue_month"))
            .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("n")))


def billing_per_customer(cm: DataFrame) -> DataFrame:
    """(customer_id, revenue, n, active_months); NULL months add revenue but are not counted."""
    return cm.groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("n").alias("n"),
        F.count("revenue_month").alias("active_months"))


def agg_user_revenue(cm: DataFrame) -> DataFrame:
    return billing_per_customer(cm).select(
        "customer_id",
        F.coalesce(F.col("revenue"), F.lit(0)).cast(S.TOTAL).alias("total_revenue"),
        F.col("n").cast("bigint").alias("total_transactions"))


def agg_monthly_revenue(cm: DataFrame) -> DataFrame:
    return cm.select(
        "customer_id", "revenue_month",
        F.coalesce(F.col("revenue"), F.lit(0)).cast(S.TOTAL).alias("monthly_revenue"))


def _arpu(revenue, months):
    return F.coalesce(round_ratio(revenue, months, 2), F.lit(0)).cast(S.TOTAL)


def arpu_by_customer(cm: DataFrame) -> DataFrame:
    """ARPU for every customer with billing rows (not anchored on the customer master)."""
    return billing_per_customer(cm).select(
        "customer_id", _arpu(F.col("revenue"), F.col("active_months")).alias("arpu"),
        F.col("active_months").cast("bigint").alias("active_months"))


def billing_metrics(cm: DataFrame) -> DataFrame:
    """Revenue, transaction count and ARPU per customer in one projection of one aggregate."""
    return billing_per_customer(cm).select(
        "customer_id",
        F.coalesce(F.col("revenue"), F.lit(0)).cast(S.TOTAL).alias("total_revenue"),
        F.col("n").cast("bigint").alias("total_transactions"),
        _arpu(F.col("revenue"), F.col("active_months")).alias("arpu"))


def agg_arpu(stg_customers: DataFrame, cm: DataFrame) -> DataFrame:
    """ARPU anchored on the customer master: aggregate first, then left join.

    Equal to joining raw billing rows and grouping, because customer_id is unique in
    ``stg_customers``; joining after the aggregate keeps a hot customer's rows out of the join.
    """
    per = billing_per_customer(cm)
    return (stg_customers.select("customer_id").join(per, "customer_id", "left")
            .select("customer_id", _arpu(F.col("revenue"), F.col("active_months")).alias("arpu"),
                    F.coalesce(F.col("active_months"), F.lit(0)).cast("bigint").alias("active_months")))


def session_rollup(stg_sessions: DataFrame) -> DataFrame:
    """One pass over staged sessions: volume, duration, count and the bucket counts."""
    d = F.col("session_duration_sec")
    bucket = bucket_label(d)
    return (stg_sessions.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.sum("data_used_mb").alias("data_sum"),
                 F.sum(d.cast("bigint")).alias("duration_sum"),
                 F.count(F.lit(1)).alias("n"),
                 F.count_if(bucket == "short").alias("short_sessions"),
                 F.count_if(bucket == "medium").alias("medium_sessions"),
                 F.count_if(bucket == "long").alias("long_sessions")))


def usage_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        "customer_id",
        F.col("data_sum").cast(S.TOTAL).alias("total_data_used_mb"),
        round_ratio(F.col("duration_sum").cast("decimal(20,0)"), F.col("n"), 2)
        .cast(S.TOTAL).alias("avg_session_duration_sec"),
        F.col("n").cast("bigint").alias("total_sessions"))


def session_metrics(rollup: DataFrame) -> DataFrame:
    """Usage and bucket mix per customer in one projection of one aggregate."""
    return rollup.select(
        "customer_id",
        F.col("data_sum").cast(S.TOTAL).alias("total_data_used_mb"),
        round_ratio(F.col("duration_sum").cast("decimal(20,0)"), F.col("n"), 2)
        .cast(S.TOTAL).alias("avg_session_duration_sec"),
        F.col("n").cast("bigint").alias("total_sessions"),
        "short_sessions", "medium_sessions", "long_sessions")


def distribution_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.select("customer_id", "short_sessions", "medium_sessions", "long_sessions")


def agg_user_usage(stg_sessions: DataFrame) -> DataFrame:
    """Per customer: SUM(data), AVG(duration) (exact, rounded half up), COUNT(*)."""
    return usage_from_rollup(session_rollup(stg_sessions))


def session_buckets(stg_sessions: DataFrame, short_max: int = P.SHORT_SESSION_MAX_SEC,
                    medium_max: int = P.MEDIUM_SESSION_MAX_SEC) -> DataFrame:
    d = F.col("session_duration_sec")
    return (stg_sessions.where(F.col("customer_id").isNotNull())
            .select("session_id", "customer_id", d.cast(S.DATA_MB).alias("duration_sec"),
                    bucket_label(d, short_max, medium_max).alias("bucket")))


def agg_session_distribution(buckets: DataFrame) -> DataFrame:
    b = F.col("bucket")
    return (buckets.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
            .agg(F.count_if(b == "short").alias("short_sessions"),
                 F.count_if(b == "medium").alias("medium_sessions"),
                 F.count_if(b == "long").alias("long_sessions")))


def daily_revenue(stg_billing: DataFrame) -> DataFrame:
    """Partial aggregate per (customer, day): the unit an incremental rollup stores."""
    return (stg_billing.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id", F.to_date("transaction_date").alias("day"))
            .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("n")))


def roll_up_daily(daily: DataFrame) -> DataFrame:
    """Per-customer revenue totals from daily partials (stored + recomputed)."""
    return daily.groupBy("customer_id").agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(S.TOTAL).alias("total_revenue"),
        F.sum("n").cast("bigint").alias("total_transactions"))


def reconcile_daily(stored: DataFrame, stg_billing: DataFrame, since: dt.date) -> DataFrame:
    """Daily partials in which every day from ``since`` on is recomputed from ``stg_billing`` and older days, and
    rows without a date, stay as they are stored."""
    recent = daily_revenue(stg_billing.where(F.to_date("transaction_date") >= F.lit(since)))
    return stored.where((F.col("day") < F.lit(since)) | F.col("day").isNull()).unionByName(recent)
