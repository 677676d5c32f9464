"""The wide per-customer warehouse table and the audit row."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions import round_ratio
from .staging import _ts

_METRICS = {
    "total_revenue": S.TOTAL, "total_transactions": "bigint", "total_data_used_mb": S.TOTAL,
    "avg_session_duration_sec": S.TOTAL, "total_sessions": "bigint", "arpu": S.TOTAL,
    "short_sessions": "bigint", "medium_sessions": "bigint", "long_sessions": "bigint",
}


def dw_user_analytics(stg_customers: DataFrame, *metrics: DataFrame,
                      as_of: dt.datetime | None = None) -> DataFrame:
    """Customer master LEFT JOIN per-customer metric frames (each unique on customer_id).

    Accepts the four reference tables (revenue, usage, arpu, distribution) or fused frames
    carrying the same columns. A metric no frame provides is 0 (an empty/missing input).
    Every metric frame is the output of a ``groupBy(customer_id)``, so it is already
    hash-partitioned on the join key; only the customer master is shuffled for the joins.
    """
    base = stg_customers.select("customer_id", "customer_name", "email", "country", "created_at")
    wanted = set(_METRICS)
    frames = []
    for m in metrics:
        cols = [c for c in m.columns if c in wanted]
        wanted -= set(cols)
        if cols:
            frames.append(m.select("customer_id", *cols))
    joined = reduce(lambda acc, m: acc.join(m, "customer_id", "left"), frames, base)
    present = set(joined.columns)

    def metric(name: str):
        typ = _METRICS[name]
        zero = F.lit(0).cast(typ)
        return (F.coalesce(F.col(name).cast(typ), zero) if name in present else zero).alias(name)

    data = F.coalesce(F.col("total_data_used_mb"), F.lit(0)) if "total_data_used_mb" in present else F.lit(0)
    sessions = F.col("total_sessions") if "total_sessions" in present else F.lit(None).cast("bigint")
    return joined.select(
        "customer_id", "customer_name", "email", "country",
        F.col("created_at").cast("timestamp_ntz").alias("customer_since"),
        *[metric(n) for n in ("total_revenue", "total_transactions", "total_data_used_mb",
                              "avg_session_duration_sec", "total_sessions", "arpu",
                              "short_sessions", "medium_sessions", "long_sessions")],
        F.coalesce(round_ratio(data.cast(S.TOTAL), sessions, 2), F.lit(0)).cast(S.TOTAL)
        .alias("avg_data_per_session_mb"),
        _ts(as_of, ntz=True).alias("last_updated"),
    )


def remap_orphan_months(cm: DataFrame, stg_customers: DataFrame,
                        unknown_id: str = P.UNKNOWN_CUSTOMER_ID) -> DataFrame:
    """Billing customer-months whose customer is not in the master, moved to a placeholder id.

    Works on the (customer, month) pre-aggregate, so the join sees at most one row per
    customer-month (never a hot customer's raw rows), then re-aggregates the placeholder.
    """
    known = stg_customers.select("customer_id", F.lit(True).alias("_known"))
    return (cm.join(known, "customer_id", "left")
            .withColumn("customer_id", F.when(F.col("_known"), F.col("customer_id"))
                        .otherwise(F.lit(unknown_id)))
            .groupBy("customer_id", "revenue_month")
            .agg(F.sum("revenue").alias("revenue"), F.sum("n").alias("n")))


def with_unknown_customer(stg_customers: DataFrame, as_of: dt.datetime | None = None,
                          unknown_id: str = P.UNKNOWN_CUSTOMER_ID) -> DataFrame:
    """The customer master plus one placeholder row that orphan revenue is attributed to."""
    spark = stg_customers.sparkSession
    placeholder = spark.range(1).select(
        F.lit(unknown_id).alias("customer_id"), F.lit("Unknown Customer").alias("customer_name"),
        F.lit(None).cast("string").alias("email"), F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("timestamp").alias("created_at"), _ts(as_of).alias("staged_at"))
    return stg_customers.unionByName(placeholder)


def pipeline_audit_log(stg_billing: DataFrame, stg_sessions: DataFrame, stg_customers: DataFrame,
                       as_of: dt.datetime | None = None, status: str = P.AUDIT_STATUS_SUCCESS) -> DataFrame:
    """One audit row: the three staged-table counts from a single global aggregate.

    The three inputs are tagged and unioned, so each task emits partial counts and one final
    aggregate combines them (no joins, no per-table job).
    """
    tagged = (stg_billing.select(F.lit(0).alias("_t"))
              .unionByName(stg_sessions.select(F.lit(1).alias("_t")))
              .unionByName(stg_customers.select(F.lit(2).alias("_t"))))
    now = _ts(as_of)
    return tagged.agg(
        F.count_if(F.col("_t") == 0).alias("billing_rows"),
        F.count_if(F.col("_t") == 1).alias("session_rows"),
        F.count_if(F.col("_t") == 2).alias("customer_rows"),
    ).select(now.cast("date").alias("run_date"), "billing_rows", "session_rows",
             "customer_rows", F.lit(status).alias("status"), now.alias("created_at"))


def audit_row(spark, billing_rows: int, session_rows: int, customer_rows: int, as_of: dt.datetime | None = None,
              status: str = P.AUDIT_STATUS_SUCCESS) -> DataFrame:
    """The audit row from counts that are known already."""
    counts = spark.createDataFrame([(billing_rows, session_rows, customer_rows)], "billing_rows bigint, session_rows bigint, customer_rows bigint")
    now = _ts(as_of)
    return counts.select(now.cast("date").alias("run_date"), "*", F.lit(status).alias("status"), now.alias("created_at"))
