"""Declared schemas of every dataset (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, TS_NTZ, D = T.StringType(), T.TimestampType(), T.TimestampNTZType(), T.DateType()
LONG, INT = T.LongType(), T.IntegerType()

AMOUNT = T.DecimalType(12, 2)       # billing amount
DATA_MB = T.DecimalType(10, 2)      # session volume
TOTAL = T.DecimalType(14, 2)        # aggregates and warehouse money / volume / averages


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SRC_CUSTOMERS = _st(("customer_id", S), ("name", S), ("email", S), ("country", S),
                    ("created_at", S), ("ingested_at", TS_NTZ))
SRC_BILLING = _st(("transaction_id", S), ("customer_id", S), ("amount", AMOUNT),
                  ("transaction_date", S), ("ingested_at", TS_NTZ))
SRC_SESSIONS = _st(("session_id", S), ("customer_id", S), ("start_time", S), ("end_time", S),
                   ("data_used_mb", DATA_MB), ("ingested_at", TS_NTZ))

QUARANTINE = _st(("quarantine_id", LONG), ("row_data", S), ("source_table", S),
                 ("issue_type", S), ("detected_at", TS))

QUARANTINE_STORED = T.StructType([*QUARANTINE.fields, T.StructField("row_hash", S, True)])

STG_CUSTOMERS = _st(("customer_id", S), ("customer_name", S), ("email", S), ("country", S),
                    ("created_at", TS), ("staged_at", TS))
STG_BILLING = _st(("transaction_id", S), ("customer_id", S), ("amount", AMOUNT),
                  ("transaction_date", TS))
STG_SESSIONS = _st(("session_id", S), ("customer_id", S), ("start_time", TS), ("end_time", TS),
                   ("data_used_mb", DATA_MB), ("session_date", D), ("session_duration_sec", INT))

AGG_USER_REVENUE = _st(("customer_id", S), ("total_revenue", TOTAL), ("total_transactions", LONG))
AGG_MONTHLY_REVENUE = _st(("customer_id", S), ("revenue_month", D), ("monthly_revenue", TOTAL))
AGG_USER_USAGE = _st(("customer_id", S), ("total_data_used_mb", TOTAL),
                     ("avg_session_duration_sec", TOTAL), ("total_sessions", LONG))
AGG_ARPU = _st(("customer_id", S), ("arpu", TOTAL), ("active_months", LONG))
SESSION_BUCKETS = _st(("session_id", S), ("customer_id", S), ("duration_sec", DATA_MB),
                      ("bucket", S))
AGG_SESSION_DISTRIBUTION = _st(("customer_id", S), ("short_sessions", LONG),
                               ("medium_sessions", LONG), ("long_sessions", LONG))

DW_USER_ANALYTICS = _st(
    ("customer_id", S), ("customer_name", S), ("email", S), ("country", S),
    ("customer_since", TS_NTZ), ("total_revenue", TOTAL), ("total_transactions", LONG),
    ("total_data_used_mb", TOTAL), ("avg_session_duration_sec", TOTAL), ("total_sessions", LONG),
    ("arpu", TOTAL), ("short_sessions", LONG), ("medium_sessions", LONG), ("long_sessions", LONG),
    ("avg_data_per_session_mb", TOTAL), ("last_updated", TS_NTZ))

PIPELINE_AUDIT_LOG = _st(("run_date", D), ("billing_rows", LONG), ("session_rows", LONG),
                         ("customer_rows", LONG), ("status", S), ("created_at", TS))
