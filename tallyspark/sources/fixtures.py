"""Raw source tables derived from the driver's test tables (rules of FIXTURES.md section 2).

The reference ships no data; these rules plant every defect class it handles (NULL ids,
retries with changed and identical content, NULL dates, bad clocks, orphans, late arrivals)
into tables whose size grows with the scale factor. Each table is one pruned scan plus a
row-multiplying ``explode`` (no self-unions), so the derivation is a single narrow stage.
The per-row rules are SQL expressions (``selectExpr``): one plan node per table, built with a
handful of driver round trips.

Arithmetic is exact: integer cents, integer division of non-negative integers, and decimals
made from integer hundredths by a long-backed decimal product (never from a rounded double).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import params as P
from ..session import session_key

# FIXED VALUES: name prefixes of the customer fixture, picked by custkey % 4.
NAME_PREFIXES = ["ada o'brien ", "MARY-JANE okafor ", "dr. john SMITH ", "tunde  bello "]
INGESTED_AT = "2024-02-01 03:00:00"

_SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cents(x: str) -> str:
    return f"CAST(round({x} * 100, 0) AS BIGINT)"


def idiv(a: str, b: str) -> str:
    """Integer division of non-negative integers (``div``: exact, truncating)."""
    return f"(({a}) div ({b}))"


def dec2(n: str, precision: int) -> str:
    """Integer hundredths -> decimal(precision, 2) via a long-backed decimal product."""
    return f"CAST(CAST({n} AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL({precision},2))"


def _variants(k: str, modulus: int, first: int) -> str:
    """[0] for a base row, [0, 1] / [0, 2] for rows that also get a changed / exact copy."""
    return (f"explode(CASE WHEN {k} % {modulus} = {first} THEN array(0, 1) "
            f"WHEN {k} % {modulus} = {first + 1} THEN array(0, 2) ELSE array(0) END) AS v")


def src_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = ", ".join(_sql_str(p) for p in NAME_PREFIXES)
    base = _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", "c_nationkey",
        f"concat(element_at(array({prefixes}), CAST(c_custkey % 4 + 1 AS INT)), CAST(c_custkey AS STRING)) AS nm",
        "date_add(DATE'2021-01-01', CAST((c_custkey * 37) % 1150 AS INT)) AS cd",
        "explode(CASE WHEN c_custkey % 100 = 7 THEN array(0, 1) WHEN c_custkey % 100 = 8 THEN array(0, 2) "
        "WHEN c_custkey % 100 = 9 THEN array(0, 3) ELSE array(0) END) AS v")
    return base.selectExpr(
        "CASE WHEN k % 97 = 96 THEN CAST(NULL AS STRING) ELSE CAST(k AS STRING) END AS customer_id",
        "CASE v WHEN 1 THEN concat(nm, ' new') WHEN 3 THEN concat(nm, ' null dated') ELSE nm END AS name",
        "concat('User.', CAST(k AS STRING), '@MAIL.com') AS email",
        "CASE WHEN k % 33 = 0 THEN CAST(NULL AS STRING) "
        "ELSE concat('Country_', CAST(c_nationkey AS STRING)) END AS country",
        "CASE WHEN v = 1 THEN concat(CAST(date_add(cd, 1) AS STRING), ' 08:30:00') "
        "WHEN v = 3 OR k % 61 = 60 THEN CAST(NULL AS STRING) "
        "ELSE concat(CAST(cd AS STRING), ' 08:30:00') END AS created_at",
        f"TIMESTAMP_NTZ'{INGESTED_AT}' AS ingested_at")


def src_billing_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    divisor = "CASE o_custkey % 3 WHEN 0 THEN 100 WHEN 1 THEN 1000 ELSE 4000 END"
    base = (_read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "CASE WHEN o_custkey % 11 = 5 THEN o_custkey - 1 ELSE o_custkey END AS ck", "CAST(o_orderdate AS DATE) AS d",
        f"CASE WHEN o_orderkey % 33 = 0 THEN CAST(NULL AS BIGINT) "
        f"ELSE {idiv(cents('o_totalprice'), divisor)} END AS ac",
        _variants("o_orderkey", 50, 1)))
    return base.selectExpr(
        "CASE WHEN k % 211 = 0 THEN CAST(NULL AS STRING) ELSE CAST(k AS STRING) END AS transaction_id",
        "CASE WHEN k % 101 = 0 THEN CAST(NULL AS STRING) WHEN k % 307 = 0 THEN concat('X', CAST(k AS STRING)) "
        "ELSE CAST(ck AS STRING) END AS customer_id",
        dec2("CASE WHEN v = 1 THEN ac + 1000 ELSE ac END", 12) + " AS amount",
        "CASE WHEN k % 89 = 88 AND v = 0 THEN CAST(NULL AS STRING) "
        "ELSE concat(CAST(CASE WHEN v = 1 THEN date_add(d, 1) ELSE d END AS STRING), ' 10:15:00') END AS transaction_date",
        "CAST(date_add(d, CASE WHEN k % 40 = 0 THEN 5 ELSE 2 END) AS TIMESTAMP_NTZ) "
        "+ INTERVAL '3' HOUR AS ingested_at")


def src_network_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    duration = (f"CASE WHEN event_id % 50 = 0 THEN -30 WHEN event_id % 53 = 0 THEN 0 "
                f"WHEN event_id % 71 = 0 THEN 60 WHEN event_id % 73 = 0 THEN 300 "
                f"ELSE {idiv(cents('value') + ' * 6', '100')} END")
    base = _read(spark, sf_dir, "events").selectExpr(
        "event_id AS k", "user_id AS u", f"{cents('value')} AS vc", f"{duration} AS dur",
        "date_trunc('SECOND', ts) AS st0", _variants("event_id", 50, 3))
    fmt = "'yyyy-MM-dd HH:mm:ss'"
    return base.selectExpr(
        "k", "u", "vc", "dur", "v",
        "CASE WHEN v = 1 THEN timestampadd(HOUR, 1, st0) ELSE st0 END AS st").selectExpr(
        "CASE WHEN k % 199 = 0 THEN CAST(NULL AS STRING) ELSE CAST(k AS STRING) END AS session_id",
        "CASE WHEN k % 103 = 0 THEN CAST(NULL AS STRING) ELSE CAST(u * 10 + k % 10 AS STRING) END AS customer_id",
        f"CASE WHEN k % 83 = 82 AND v = 0 THEN CAST(NULL AS STRING) ELSE date_format(st, {fmt}) END AS start_time",
        f"CASE WHEN k % 79 = 78 THEN CAST(NULL AS STRING) "
        f"ELSE date_format(timestampadd(SECOND, dur, st), {fmt}) END AS end_time",
        f"CASE WHEN k % 47 = 0 THEN CAST(NULL AS DECIMAL(10,2)) ELSE {dec2('vc * (u % 5)', 10)} END AS data_used_mb",
        f"TIMESTAMP_NTZ'{INGESTED_AT}' AS ingested_at")


_MEMO: dict[tuple[str, str], dict[str, DataFrame]] = {}


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw sources (lazy frames, built once per session and folder)."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    if key not in _MEMO:
        _MEMO[key] = {
            P.SRC_CUSTOMERS: src_customers(spark, sf_dir),
            P.SRC_BILLING: src_billing_transactions(spark, sf_dir),
            P.SRC_SESSIONS: src_network_sessions(spark, sf_dir),
        }
    return dict(_MEMO[key])


def replicate(srcs: dict[str, DataFrame], copies: int) -> dict[str, DataFrame]:
    """Each source repeated ``copies`` times with every identifier offset per copy (suffix
    ``#c``), so copies never collide and every result scales by ``copies`` (copy 0 keeps the
    original ids). Used for the scaled benchmark run."""
    if copies <= 1:
        return dict(srcs)
    id_cols = {P.SRC_CUSTOMERS: ["customer_id"], P.SRC_BILLING: ["transaction_id", "customer_id"],
               P.SRC_SESSIONS: ["session_id", "customer_id"]}
    out = {}
    for name, df in srcs.items():
        df = df.hint("rebalance")   # the copies are generated by all tasks, not the scan's one
        exprs = []
        for c in df.columns:
            if c in id_cols[name]:
                exprs.append(f"CASE WHEN _copy = 0 THEN {c} ELSE concat({c}, '#', CAST(_copy AS STRING)) END AS {c}")
            else:
                exprs.append(c)
        out[name] = df.selectExpr("*", f"explode(sequence(0, {copies - 1})) AS _copy").selectExpr(*exprs)
    return out
