"""Staging: typed, cleaned, one row per record id.

Dedup orders (NULL placement is part of the semantics; the trailing columns make the order
total so reruns are deterministic):

* customers: created_at DESC NULLS FIRST (a NULL date wins), then name, email, country
* billing:   transaction_date DESC NULLS LAST, then amount DESC NULLS LAST, customer_id
* sessions:  start_time DESC NULLS LAST, then end_time, data_used_mb DESC NULLS LAST, customer_id
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions import guarded_duration_sec, text_to_date, text_to_timestamp, title_case
from .dedup import latest_per_key


def _ts(value: dt.datetime | dt.date | None, ntz: bool = False) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    else:
        text = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def customers_order() -> list[Column]:
    return [F.col("_created_ts").desc_nulls_first(), F.col("name").asc_nulls_last(),
            F.col("email").asc_nulls_last(), F.col("country").asc_nulls_last()]


def billing_order() -> list[Column]:
    return [F.col("_date_ts").desc_nulls_last(), F.col("amount").desc_nulls_last(),
            F.col("customer_id").asc_nulls_last()]


def sessions_order() -> list[Column]:
    return [F.col("_start_ts").desc_nulls_last(), F.col("_end_ts").desc_nulls_last(),
            F.col("data_used_mb").desc_nulls_last(), F.col("customer_id").asc_nulls_last()]


def stage_customers(src: DataFrame, as_of: dt.datetime | None = None,
                    default_country: str = P.DEFAULT_COUNTRY, strict: bool = True) -> DataFrame:
    rows = (src.where(F.col("customer_id").isNotNull())
            .withColumn("_created_ts", text_to_timestamp("created_at", strict)))
    latest = latest_per_key(rows, "customer_id", customers_order())
    return latest.select(
        "customer_id",
        title_case("name").alias("customer_name"),
        F.lower("email").alias("email"),
        F.coalesce(F.col("country"), F.lit(default_country)).alias("country"),
        F.col("_created_ts").alias("created_at"),
        _ts(as_of).alias("staged_at"),
    )


def _billing_rows(src: DataFrame, strict: bool = True) -> DataFrame:
    return (src.where(F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull())
            .withColumn("_date_ts", text_to_timestamp("transaction_date", strict)))


def _billing_project(latest: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return latest.select(
        "transaction_id", "customer_id",
        F.coalesce(F.col("amount").cast(S.AMOUNT), F.lit(0).cast(S.AMOUNT)).alias("amount"),
        F.col("_date_ts").alias("transaction_date"),
        *keep,
    )


def stage_billing(src: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    latest = latest_per_key(_billing_rows(src, strict), "transaction_id", billing_order())
    return _billing_project(latest, keep)


def iso_text_window(col: str, t_start: dt.date, t_end: dt.date) -> Column:
    """[t_start, t_end) on ISO 'yyyy-MM-dd HH:mm:ss' text as a plain string range.

    For ISO text, string order is time order, so this is implied by the typed predicate; added
    next to it, it is what the parquet reader can push down (row-group min/max skipping)."""
    return (F.col(col) >= F.lit(t_start.isoformat())) & (F.col(col) < F.lit(t_end.isoformat()))


def stage_billing_window(src: DataFrame, t_start: dt.date, t_end: dt.date,
                         strict: bool = True, keep: tuple[str, ...] = (),
                         iso_text: bool = False) -> DataFrame:
    """Staged billing rows whose transaction_date is in the half-open window [t_start, t_end).

    The window predicate is applied before the dedup so only the window's rows are shuffled.
    The typed predicate is evaluated after the scan (the column is text); with ``iso_text``
    (the source's dates are ISO-formatted text) an equivalent string range is added that
    reaches the parquet scan, so a daily load skips the row groups outside the window.
    """
    if iso_text:
        src = src.where(iso_text_window("transaction_date", t_start, t_end))
    rows = _billing_rows(src, strict).where(
        (F.col("_date_ts") >= _ts(t_start)) & (F.col("_date_ts") < _ts(t_end)))
    return _billing_project(latest_per_key(rows, "transaction_id", billing_order()), keep)


def stage_sessions(src: DataFrame, strict: bool = True) -> DataFrame:
    rows = (src.where(F.col("session_id").isNotNull() & F.col("customer_id").isNotNull())
            .withColumn("_start_ts", text_to_timestamp("start_time", strict))
            .withColumn("_end_ts", text_to_timestamp("end_time", strict)))
    latest = latest_per_key(rows, "session_id", sessions_order())
    return latest.select(
        "session_id", "customer_id",
        F.col("_start_ts").alias("start_time"),
        F.col("_end_ts").alias("end_time"),
        F.coalesce(F.col("data_used_mb").cast(S.DATA_MB), F.lit(0).cast(S.DATA_MB)).alias("data_used_mb"),
        text_to_date("start_time", strict).alias("session_date"),
        guarded_duration_sec(F.col("_start_ts"), F.col("_end_ts")).alias("session_duration_sec"),
    )
