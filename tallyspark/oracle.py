"""DuckDB SQL for every registered query, for the driver's cross-engine check.

Written from the reference's SQL semantics (DISTINCT ON -> row_number, COUNT(*) FILTER,
NULLIF division, ...), not from this package's Spark plans, over the same fixture derivation
(FIXTURES.md section 2) expressed as CTEs. Output typing mirrors ``registry.comparable``:
decimals as DOUBLE, integers as BIGINT, dates/timestamps as ISO text. Decimal roundings use
the exact integer form ``(2*cents + m) // (2*m)`` (DuckDB decimal division returns DOUBLE).
"""

from __future__ import annotations

import re

# --- fixtures -------------------------------------------------------------------------------
SOURCES = r"""
src_customers AS (
  SELECT
    CASE WHEN k % 97 = 96 THEN NULL ELSE CAST(k AS VARCHAR) END AS customer_id,
    CASE v WHEN 1 THEN nm || ' new' WHEN 3 THEN nm || ' null dated' ELSE nm END AS name,
    'User.' || CAST(k AS VARCHAR) || '@MAIL.com' AS email,
    CASE WHEN k % 33 = 0 THEN NULL ELSE 'Country_' || CAST(c_nationkey AS VARCHAR) END AS country,
    CASE WHEN v = 1 THEN CAST(cd + 1 AS VARCHAR) || ' 08:30:00'
         WHEN v = 3 OR k % 61 = 60 THEN NULL
         ELSE CAST(cd AS VARCHAR) || ' 08:30:00' END AS created_at,
    TIMESTAMP '2024-02-01 03:00:00' AS ingested_at
  FROM (
    SELECT c_custkey AS k, c_nationkey,
      CASE c_custkey % 4 WHEN 0 THEN 'ada o''brien ' WHEN 1 THEN 'MARY-JANE okafor '
           WHEN 2 THEN 'dr. john SMITH ' ELSE 'tunde  bello ' END || CAST(c_custkey AS VARCHAR) AS nm,
      DATE '2021-01-01' + CAST((c_custkey * 37) % 1150 AS INTEGER) AS cd,
      UNNEST(CASE WHEN c_custkey % 100 = 7 THEN [0, 1] WHEN c_custkey % 100 = 8 THEN [0, 2]
                  WHEN c_custkey % 100 = 9 THEN [0, 3] ELSE [0] END) AS v
    FROM customer) c
),
src_billing_transactions AS (
  SELECT
    CASE WHEN k % 211 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS transaction_id,
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 307 = 0 THEN 'X' || CAST(k AS VARCHAR)
         ELSE CAST(ck AS VARCHAR) END AS customer_id,
    CAST(CAST(CASE WHEN v = 1 THEN ac + 1000 ELSE ac END AS DECIMAL(18,0))
         * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS amount,
    CASE WHEN k % 89 = 88 AND v = 0 THEN NULL
         ELSE CAST(CASE WHEN v = 1 THEN d + 1 ELSE d END AS VARCHAR) || ' 10:15:00' END AS transaction_date,
    CAST(d + CASE WHEN k % 40 = 0 THEN 5 ELSE 2 END AS TIMESTAMP) + INTERVAL 3 HOUR AS ingested_at
  FROM (
    SELECT o_orderkey AS k, CASE WHEN o_custkey % 11 = 5 THEN o_custkey - 1 ELSE o_custkey END AS ck,
      CAST(o_orderdate AS DATE) AS d,
      CASE WHEN o_orderkey % 33 = 0 THEN NULL
           ELSE CAST(round(o_totalprice * 100) AS BIGINT)
                // (CASE o_custkey % 3 WHEN 0 THEN 100 WHEN 1 THEN 1000 ELSE 4000 END) END AS ac,
      UNNEST(CASE WHEN o_orderkey % 50 = 1 THEN [0, 1] WHEN o_orderkey % 50 = 2 THEN [0, 2]
                  ELSE [0] END) AS v
    FROM orders) o
),
src_network_sessions AS (
  SELECT
    CASE WHEN k % 199 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS session_id,
    CASE WHEN k % 103 = 0 THEN NULL ELSE CAST(u * 10 + k % 10 AS VARCHAR) END AS customer_id,
    CASE WHEN k % 83 = 82 AND v = 0 THEN NULL ELSE strftime(st, '%Y-%m-%d %H:%M:%S') END AS start_time,
    CASE WHEN k % 79 = 78 THEN NULL ELSE strftime(st + to_seconds(dur), '%Y-%m-%d %H:%M:%S') END AS end_time,
    CASE WHEN k % 47 = 0 THEN NULL
         ELSE CAST(CAST(vc * (u % 5) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))
    END AS data_used_mb,
    TIMESTAMP '2024-02-01 03:00:00' AS ingested_at
  FROM (
    SELECT k, u, vc, dur, v, CASE WHEN v = 1 THEN st0 + INTERVAL 1 HOUR ELSE st0 END AS st
    FROM (
      SELECT event_id AS k, user_id AS u, CAST(round(value * 100) AS BIGINT) AS vc,
        date_trunc('second', CAST(ts AS TIMESTAMP)) AS st0,
        CASE WHEN event_id % 50 = 0 THEN -30 WHEN event_id % 53 = 0 THEN 0
             WHEN event_id % 71 = 0 THEN 60 WHEN event_id % 73 = 0 THEN 300
             ELSE CAST(round(value * 100) AS BIGINT) * 6 // 100 END AS dur,
        UNNEST(CASE WHEN event_id % 50 = 3 THEN [0, 1] WHEN event_id % 50 = 4 THEN [0, 2]
                    ELSE [0] END) AS v
      FROM events) e0) e
)"""

# --- staging (DISTINCT ON ... ORDER BY written as row_number) ---------------------------------
TITLE = (r"array_to_string(list_transform(regexp_extract_all(lower({c}), "
         r"'[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), lambda x: upper(x[1]) || x[2:]), '')")

STAGING = r"""
stg_customers AS (
  SELECT customer_id, """ + TITLE.format(c="name") + r""" AS customer_name,
    lower(email) AS email, COALESCE(country, 'Nigeria') AS country,
    CAST(created_at AS TIMESTAMP) AS created_at, TIMESTAMP '__ASOF__' AS staged_at
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
          ORDER BY CAST(created_at AS TIMESTAMP) DESC NULLS FIRST, name ASC NULLS LAST,
                   email ASC NULLS LAST, country ASC NULLS LAST) AS rn
        FROM src_customers WHERE (__CP__) AND customer_id IS NOT NULL) t
  WHERE rn = 1
),
billing_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
      ORDER BY CAST(transaction_date AS TIMESTAMP) DESC NULLS LAST, amount DESC NULLS LAST,
               customer_id ASC NULLS LAST) AS rn
  FROM src_billing_transactions
  WHERE (__BP__) AND transaction_id IS NOT NULL AND customer_id IS NOT NULL
),
stg_billing AS (
  SELECT transaction_id, customer_id, CAST(COALESCE(amount, 0) AS DECIMAL(12,2)) AS amount,
    CAST(transaction_date AS TIMESTAMP) AS transaction_date
  FROM billing_ranked WHERE rn = 1
),
stg_sessions AS (
  SELECT session_id, customer_id, s AS start_time, e AS end_time,
    CAST(COALESCE(data_used_mb, 0) AS DECIMAL(10,2)) AS data_used_mb,
    CAST(start_time AS DATE) AS session_date,
    CASE WHEN e > s THEN CAST(date_diff('second', s, e) AS INTEGER) ELSE 0 END AS session_duration_sec
  FROM (SELECT *, CAST(start_time AS TIMESTAMP) AS s, CAST(end_time AS TIMESTAMP) AS e,
          row_number() OVER (PARTITION BY session_id
            ORDER BY CAST(start_time AS TIMESTAMP) DESC NULLS LAST,
                     CAST(end_time AS TIMESTAMP) DESC NULLS LAST,
                     data_used_mb DESC NULLS LAST, customer_id ASC NULLS LAST) AS rn
        FROM src_network_sessions WHERE (__SP__) AND session_id IS NOT NULL AND customer_id IS NOT NULL) t
  WHERE rn = 1
)"""

def _half_up(num: str, den: str) -> str:
    """num / den in hundredths, halves up; 0 if there is nothing to divide by."""
    return (f"COALESCE(CAST((2 * CAST({num} AS BIGINT) + {den}) // NULLIF(2 * {den}, 0) AS DECIMAL(18,0))"
            " * CAST(0.01 AS DECIMAL(3,2)), 0)")


def _wide(name: str, customers: str, billing: str) -> str:
    """The warehouse straight from staging: billing and session lines in one list, summed once per customer."""
    return f"""{name}_lines AS (
  SELECT customer_id, amount, date_trunc('month', transaction_date) AS in_month FROM {billing}
  UNION ALL BY NAME
  SELECT customer_id, data_used_mb AS mb, session_duration_sec AS secs FROM stg_sessions
),
{name}_sums AS (
  SELECT customer_id, SUM(amount) AS paid, COUNT(amount) AS n_paid, COUNT(DISTINCT in_month) AS n_months,
    SUM(mb) AS mb, SUM(secs) AS secs, COUNT(secs) AS n_sessions,
    list(secs) FILTER (WHERE secs IS NOT NULL) AS each_secs
  FROM {name}_lines GROUP BY customer_id
),
{name} AS (
  SELECT customer_id, customer_name, email, country, created_at AS customer_since, TIMESTAMP '__ASOF__' AS last_updated,
    COALESCE(paid, 0) AS total_revenue, COALESCE(n_paid, 0) AS total_transactions, {_half_up("paid * 100", "n_months")} AS arpu,
    COALESCE(mb, 0) AS total_data_used_mb, COALESCE(n_sessions, 0) AS total_sessions,
    {_half_up("mb * 100", "n_sessions")} AS avg_data_per_session_mb,
    {_half_up("secs * 100", "n_sessions")} AS avg_session_duration_sec,
    COALESCE(len(list_filter(each_secs, lambda x: x < 60)), 0) AS short_sessions,
    COALESCE(len(list_filter(each_secs, lambda x: x >= 60 AND x < 300)), 0) AS medium_sessions,
    COALESCE(len(list_filter(each_secs, lambda x: x >= 300)), 0) AS long_sessions
  FROM {customers} LEFT JOIN {name}_sums USING (customer_id)
)"""


# --- transformations, warehouse ---------------------------------------------------------------
TRANSFORMS = r"""
agg_user_revenue AS (
  SELECT customer_id, COALESCE(SUM(amount), 0) AS total_revenue, COUNT(*) AS total_transactions
  FROM stg_billing WHERE customer_id IS NOT NULL GROUP BY customer_id
),
agg_monthly_revenue AS (
  SELECT customer_id, CAST(date_trunc('month', transaction_date) AS DATE) AS revenue_month,
    COALESCE(SUM(amount), 0) AS monthly_revenue
  FROM stg_billing WHERE customer_id IS NOT NULL
  GROUP BY customer_id, date_trunc('month', transaction_date)
),
agg_arpu AS (
  SELECT customer_id,
    CAST(COALESCE((2 * cents + months) // NULLIF(2 * months, 0), 0) AS DECIMAL(18,0))
      * CAST(0.01 AS DECIMAL(3,2)) AS arpu,
    months AS active_months
  FROM (SELECT c.customer_id, CAST(SUM(b.amount) * 100 AS BIGINT) AS cents,
          COUNT(DISTINCT date_trunc('month', b.transaction_date)) AS months
        FROM stg_customers c LEFT JOIN stg_billing b ON c.customer_id = b.customer_id
        GROUP BY c.customer_id) t
),
agg_user_usage AS (
  SELECT customer_id, SUM(data_used_mb) AS total_data_used_mb,
    CAST((200 * CAST(SUM(session_duration_sec) AS BIGINT) + COUNT(*)) // (2 * COUNT(*)) AS DECIMAL(18,0))
      * CAST(0.01 AS DECIMAL(3,2)) AS avg_session_duration_sec,
    COUNT(*) AS total_sessions
  FROM stg_sessions WHERE customer_id IS NOT NULL GROUP BY customer_id
),
session_buckets AS (
  SELECT session_id, customer_id, CAST(session_duration_sec AS DECIMAL(10,2)) AS duration_sec,
    ['short', 'medium', 'long'][1 + len(list_filter([60, 300], lambda t: session_duration_sec >= t))] AS bucket
  FROM stg_sessions WHERE customer_id IS NOT NULL
),
agg_session_distribution AS (
  SELECT customer_id, COALESCE(n['short'], 0) AS short_sessions, COALESCE(n['medium'], 0) AS medium_sessions,
    COALESCE(n['long'], 0) AS long_sessions
  FROM (SELECT customer_id, histogram(bucket) AS n FROM session_buckets GROUP BY customer_id) h
),
""" + _wide("dw_user_analytics", "stg_customers", "stg_billing")

CHAIN_NAMES = ["stg_customers", "billing_ranked", "stg_billing", "stg_sessions", "agg_user_revenue",
               "agg_monthly_revenue", "agg_arpu", "agg_user_usage", "session_buckets",
               "agg_session_distribution", "dw_user_analytics_lines", "dw_user_analytics_sums",
               "dw_user_analytics"]


def chain(sfx: str = "", customers: str = "TRUE", billing: str = "TRUE", sessions: str = "TRUE",
          as_of: str = "2024-02-01 00:00:00") -> str:
    """The staging -> warehouse CTE chain over filtered sources, CTE names suffixed ``sfx``."""
    text = (STAGING.strip() + ",\n" + TRANSFORMS.strip())
    text = (text.replace("__CP__", customers).replace("__BP__", billing)
            .replace("__SP__", sessions).replace("__ASOF__", as_of))
    if sfx:
        text = re.sub(r"\b(" + "|".join(CHAIN_NAMES) + r")\b", lambda m: m.group(1) + sfx, text)
    return text


PREFIX = "WITH " + ",\n".join([SOURCES.strip(), chain()])

# Output typing shared by every final SELECT: d = DOUBLE, i = BIGINT, t = timestamp text,
# day = date text, s = as is.
_KIND = {
    "d": "CAST({c} AS DOUBLE)", "i": "CAST({c} AS BIGINT)",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')", "day": "strftime({c}, '%Y-%m-%d')", "s": "{c}",
}

COLS = {
    "src_customers": "customer_id s, name s, email s, country s, created_at s, ingested_at t",
    "src_billing_transactions": "transaction_id s, customer_id s, amount d, transaction_date s, ingested_at t",
    "src_network_sessions": "session_id s, customer_id s, start_time s, end_time s, data_used_mb d, ingested_at t",
    "stg_customers": "customer_id s, customer_name s, email s, country s, created_at t, staged_at t",
    "stg_billing": "transaction_id s, customer_id s, amount d, transaction_date t",
    "stg_sessions": "session_id s, customer_id s, start_time t, end_time t, data_used_mb d, "
                    "session_date day, session_duration_sec i",
    "agg_user_revenue": "customer_id s, total_revenue d, total_transactions i",
    "agg_monthly_revenue": "customer_id s, revenue_month day, monthly_revenue d",
    "agg_user_usage": "customer_id s, total_data_used_mb d, avg_session_duration_sec d, total_sessions i",
    "agg_arpu": "customer_id s, arpu d, active_months i",
    "session_buckets": "session_id s, customer_id s, duration_sec d, bucket s",
    "agg_session_distribution": "customer_id s, short_sessions i, medium_sessions i, long_sessions i",
    "dw_user_analytics": "customer_id s, customer_name s, email s, country s, customer_since t, "
                         "total_revenue d, total_transactions i, total_data_used_mb d, "
                         "avg_session_duration_sec d, total_sessions i, arpu d, short_sessions i, "
                         "medium_sessions i, long_sessions i, avg_data_per_session_mb d, last_updated t",
}


def typed(cols: str, source: str, where: str = "", extra_ctes: str = "") -> str:
    """PREFIX + optional extra CTEs + SELECT of ``cols`` ('name kind, ...') from ``source``."""
    items = []
    for spec in cols.split(","):
        name, kind = spec.split()
        items.append(_KIND[kind].format(c=name) + f" AS {name}")
    ctes = PREFIX + ("," + extra_ctes if extra_ctes else "")
    return f"{ctes}\nSELECT {', '.join(items)} FROM {source} {where}".strip()


def _table(name: str) -> str:
    return typed(COLS[name], name)


_DW = "dw_user_analytics"

SQL: dict[str, str] = {name: _table(name) for name in COLS}

SQL["pipeline_audit_log"] = typed(
    "run_date day, billing_rows i, session_rows i, customer_rows i, status s, created_at t",
    "(SELECT DATE '2024-02-01' AS run_date, (SELECT COUNT(*) FROM stg_billing) AS billing_rows, "
    "(SELECT COUNT(*) FROM stg_sessions) AS session_rows, "
    "(SELECT COUNT(*) FROM stg_customers) AS customer_rows, 'SUCCESS' AS status, "
    "TIMESTAMP '2024-02-01 00:00:00' AS created_at) a")

SQL["q1_top_customers"] = typed(
    "customer_id s, customer_name s, country s, total_revenue d, total_transactions i, arpu d, "
    "total_sessions i",
    f"(SELECT * FROM {_DW} ORDER BY total_revenue DESC, customer_id LIMIT 10) t")

SQL["q2_churn_risk"] = typed(
    "customer_id s, customer_name s, email s, total_sessions i, total_revenue d, customer_since t, "
    "days_since_registration i",
    f"(SELECT customer_id, customer_name, email, total_sessions, total_revenue, customer_since, "
    f"date_diff('day', CAST(customer_since AS DATE), DATE '2024-02-01') AS days_since_registration "
    f"FROM {_DW} WHERE total_sessions < 5 AND total_revenue < 1000 "
    f"AND customer_since < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 30 DAY) t")

SQL["q3_revenue_usage_mismatch"] = typed(
    "customer_id s, customer_name s, total_revenue d, total_data_used_mb d, "
    "avg_data_per_session_mb d, revenue_usage_flag s",
    f"(SELECT customer_id, customer_name, total_revenue, total_data_used_mb, avg_data_per_session_mb, "
    f"CASE WHEN total_data_used_mb > 500 AND total_revenue < 3000 THEN 'High usage / low spend' "
    f"WHEN total_data_used_mb < 100 AND total_revenue > 5000 THEN 'Low usage / high spend' "
    f"ELSE 'Normal' END AS revenue_usage_flag FROM {_DW} "
    f"WHERE (total_data_used_mb > 500 AND total_revenue < 3000) "
    f"OR (total_data_used_mb < 100 AND total_revenue > 5000)) t")

SQL["q4_monthly_trend"] = typed(
    "revenue_month day, total_monthly_revenue d, active_customers i",
    "(SELECT revenue_month, SUM(monthly_revenue) AS total_monthly_revenue, "
    "COUNT(DISTINCT customer_id) AS active_customers FROM agg_monthly_revenue "
    "GROUP BY revenue_month) t")

SQL["q5_session_mix"] = typed(
    "customer_id s, customer_name s, short_sessions i, medium_sessions i, long_sessions i, "
    "total_sessions i, pct_long s, pct_short s",
    f"(SELECT customer_id, customer_name, short_sessions, medium_sessions, long_sessions, total_sessions, "
    f"ROUND(100.0 * CAST(long_sessions AS DOUBLE) / NULLIF(total_sessions, 0), 1) AS pct_long, "
    f"ROUND(100.0 * CAST(short_sessions AS DOUBLE) / NULLIF(total_sessions, 0), 1) AS pct_short "
    f"FROM {_DW} WHERE total_sessions > 0) t")

SQL["churn_by_rate"] = typed(
    "customer_id s, customer_name s, total_sessions i, total_revenue d, days_since_registration i",
    f"(SELECT * FROM (SELECT customer_id, customer_name, total_sessions, total_revenue, "
    f"date_diff('day', CAST(customer_since AS DATE), DATE '2024-02-01') AS days_since_registration "
    f"FROM {_DW}) x WHERE days_since_registration > 0 AND total_sessions * 7 < days_since_registration "
    f"AND total_revenue * 7 < days_since_registration * 250) t")


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --- quality ----------------------------------------------------------------------------------
_B, _S, _C = "src_billing_transactions", "src_network_sessions", "src_customers"
_B_NULL = "transaction_id IS NULL OR customer_id IS NULL"
_S_NULL = "session_id IS NULL OR customer_id IS NULL"
_C_NULL = "customer_id IS NULL"


def _dups(table: str, key: str) -> str:
    return (f"(SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} "
            f"HAVING COUNT(*) > 1)")


_B_DUP = f"transaction_id IN {_dups(_B, 'transaction_id')}"
_S_DUP = f"session_id IN {_dups(_S, 'session_id')}"
_C_DUP = f"customer_id IN {_dups(_C, 'customer_id')}"
_ORPHAN = (f"customer_id IS NOT NULL AND customer_id NOT IN "
           f"(SELECT customer_id FROM {_C} WHERE customer_id IS NOT NULL)")

_QUARANTINE_SETS = [  # (source table, issue, predicate) in insert order
    (_B, "NULL transaction_id or customer_id", _B_NULL),
    (_B, "Duplicate transaction_id", _B_DUP),
    (_S, "NULL session_id or customer_id", _S_NULL),
    (_S, "Duplicate session_id", _S_DUP),
    (_C, "NULL customer_id", _C_NULL),
    (_C, "Duplicate customer_id", _C_DUP),
]

SQL["check_billing_null_ids"] = typed(
    "transaction_id s, customer_id s, amount d, transaction_date s, issue s",
    f"(SELECT *, 'NULL transaction_id or customer_id' AS issue FROM {_B} WHERE {_B_NULL}) t")
SQL["check_sessions_null_ids"] = typed(
    "session_id s, customer_id s, start_time s, end_time s, data_used_mb d, issue s",
    f"(SELECT *, 'NULL session_id or customer_id' AS issue FROM {_S} WHERE {_S_NULL}) t")
for _name, _table, _key in [("check_billing_duplicate_ids", _B, "transaction_id"),
                            ("check_sessions_duplicate_ids", _S, "session_id"),
                            ("check_customers_duplicate_ids", _C, "customer_id")]:
    SQL[_name] = typed(f"{_key} s, occurrences i",
                       f"(SELECT {_key}, COUNT(*) AS occurrences FROM {_table} WHERE {_key} IS NOT NULL "
                       f"GROUP BY {_key} HAVING COUNT(*) > 1) t")

_SRC_COLS = {_B: COLS["src_billing_transactions"], _S: COLS["src_network_sessions"],
             _C: COLS["src_customers"]}
for _name, (_table, _issue, _pred) in zip(
        ["quarantine_billing_null_ids", "quarantine_billing_duplicates", "quarantine_sessions_null_ids",
         "quarantine_sessions_duplicates", "quarantine_customers_null_id",
         "quarantine_customers_duplicates"], _QUARANTINE_SETS):
    SQL[_name] = typed(_SRC_COLS[_table] + ", source_table s, issue_type s",
                       f"(SELECT *, '{_table}' AS source_table, '{_issue}' AS issue_type "
                       f"FROM {_table} WHERE {_pred}) t")

SQL["quarantine_billing_orphans"] = typed(
    _SRC_COLS[_B] + ", source_table s, issue_type s",
    f"(SELECT *, '{_B}' AS source_table, 'customer_id not in src_customers' AS issue_type "
    f"FROM {_B} WHERE {_ORPHAN}) t")
SQL["check_billing_orphans"] = typed(
    "transaction_id s, customer_id s, amount d, transaction_date s, issue s",
    f"(SELECT *, 'customer_id not in src_customers' AS issue FROM {_B} WHERE {_ORPHAN}) t")


def _view_part(table: str, issue: str, pred: str) -> str:
    tid = "transaction_id" if table == _B else "NULL"
    sid = "session_id" if table == _S else "NULL"
    return (f"SELECT true AS has_id, '{table}' AS source_table, '{issue}' AS issue_type, "
            f"CAST({tid} AS VARCHAR) AS transaction_id, CAST({sid} AS VARCHAR) AS session_id, "
            f"customer_id, TIMESTAMP '2024-02-01 00:00:00' AS detected_at FROM {table} WHERE {pred}")


SQL["quarantine_all"] = typed(
    "has_id s, source_table s, issue_type s, transaction_id s, session_id s, customer_id s, detected_at t",
    "(" + " UNION ALL ".join(_view_part(*q) for q in _QUARANTINE_SETS) + ") t")

SQL["quarantine_rerun_idempotent"] = typed(
    "source_table s, issue_type s, first_run_rows i, second_run_rows i",
    "(SELECT source_table, issue_type, COUNT(*) AS first_run_rows, 0 AS second_run_rows FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS source_table, '{i}' AS issue_type FROM {t} WHERE {p}"
                         for t, i, p in _QUARANTINE_SETS)
    + ") q GROUP BY source_table, issue_type) t")

# --- monitoring -------------------------------------------------------------------------------
SQL["freshness_check"] = typed(
    "max_transaction_date t, checked_at t, minutes_behind i, is_stale s",
    "(SELECT m AS max_transaction_date, t AS checked_at, "
    "CAST(floor(date_diff('microsecond', m, t) / 60000000.0) AS BIGINT) AS minutes_behind, "
    "(m IS NULL OR date_diff('microsecond', m, t) > CAST(25 AS BIGINT) * 3600000000) AS is_stale "
    "FROM (SELECT MAX(transaction_date) AS m FROM stg_billing) x, "
    "(VALUES (TIMESTAMP '2001-08-02 11:00:00'), (TIMESTAMP '2024-02-01 00:00:00')) v(t)) t")

SQL["row_count_gate"] = typed(
    "window_start day, window_end day, rows i, min_rows i, passed s",
    f"(SELECT DATE '1998-05-01' AS window_start, DATE '1998-06-01' AS window_end, COUNT(*) AS rows, "
    f"100 AS min_rows, COUNT(*) >= 100 AS passed FROM {_B} "
    f"WHERE CAST(transaction_date AS TIMESTAMP) >= TIMESTAMP '1998-05-01' "
    f"AND CAST(transaction_date AS TIMESTAMP) < TIMESTAMP '1998-06-01') t")

_VOLUME = """
daily AS (SELECT CAST(transaction_date AS DATE) AS day, COUNT(*) AS loads FROM stg_billing
          WHERE transaction_date IS NOT NULL GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
          FROM daily),
series AS (SELECT s.day, COALESCE(d.loads, 0) AS loads FROM spine s LEFT JOIN daily d ON s.day = d.day),
moments AS (SELECT day, loads, SUM(CAST(loads AS DOUBLE)) OVER w AS s1,
              SUM(CAST(loads AS DOUBLE) * CAST(loads AS DOUBLE)) OVER w AS s2,
              CAST(COUNT(loads) OVER w AS DOUBLE) AS c
            FROM series WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
volume AS (SELECT day, loads, s1 / c AS mean_prev,
             CASE WHEN c > 1 THEN sqrt(greatest(0.0, (s2 - s1 * s1 / c) / (c - 1))) END AS sd_prev
           FROM moments)"""
SQL["volume_anomaly"] = typed(
    "day day, loads i, mean_prev s, sd_prev s, is_anomaly s",
    "(SELECT *, COALESCE(loads < mean_prev - 2 * sd_prev, false) AS is_anomaly FROM volume UNION ALL "
    "SELECT NULL, COUNT(*), NULL, NULL, false FROM stg_billing WHERE transaction_date IS NULL "
    "OR CAST(transaction_date AS DATE) NOT BETWEEN DATE '1990-01-01' AND DATE '2024-02-01' HAVING COUNT(*) > 0) t",
    extra_ctes=_VOLUME)

SQL["late_arrivals"] = typed(
    "transaction_id s, customer_id s, amount d, transaction_date t, ingested_at t, days_late i",
    "(SELECT transaction_id, customer_id, CAST(COALESCE(amount, 0) AS DECIMAL(12,2)) AS amount, "
    "CAST(transaction_date AS TIMESTAMP) AS transaction_date, ingested_at, "
    "date_diff('day', CAST(CAST(transaction_date AS TIMESTAMP) AS DATE), CAST(ingested_at AS DATE)) AS days_late "
    "FROM billing_ranked WHERE rn = 1) t WHERE days_late > 2")


# --- landing, upserts, incremental loads -------------------------------------------------------
def _landed(name: str) -> str:
    cols = COLS[name].replace("ingested_at t", "").rstrip(", ")
    return typed(cols + ", ingested_at t",
                 f"(SELECT * REPLACE (TIMESTAMP '2024-02-01 00:00:00' AS ingested_at) FROM {name}) t")


for _name in ("src_customers", "src_billing_transactions", "src_network_sessions"):
    SQL[_name] = _landed(_name)

SQL["source_row_counts"] = typed(
    "table_name s, row_count i",
    f"(SELECT '{_C}' AS table_name, COUNT(*) AS row_count FROM {_C} UNION ALL "
    f"SELECT '{_B}', COUNT(*) FROM {_B} UNION ALL SELECT '{_S}', COUNT(*) FROM {_S}) t")


def _ts_lt(col: str, day: str) -> str:
    return f"CAST({col} AS TIMESTAMP) < TIMESTAMP '{day}'"


def _ts_ge(col: str, day: str) -> str:
    return f"CAST({col} AS TIMESTAMP) >= TIMESTAMP '{day}'"


def _merged(table: str, key: str, old: str, new: str, mode: str) -> str:
    """Upsert of two staged variants: update = new wins; ignore = old wins."""
    if mode == "update":
        return (f"(SELECT * FROM {table}{old} WHERE {key} NOT IN (SELECT {key} FROM {table}{new}) "
                f"UNION ALL SELECT * FROM {table}{new}) m")
    return (f"(SELECT * FROM {table}{old} UNION ALL SELECT * FROM {table}{new} "
            f"WHERE {key} NOT IN (SELECT {key} FROM {table}{old})) m")


SQL["stg_billing_upsert"] = typed(
    COLS["stg_billing"], _merged("stg_billing", "transaction_id", "_ex", "_in", "update"),
    extra_ctes=chain("_ex", billing=_ts_lt("transaction_date", "1998-05-01") + " OR transaction_date IS NULL") + ",\n"
    + chain("_in", billing=_ts_ge("transaction_date", "1998-05-01")))

SQL["stg_sessions_upsert"] = typed(
    COLS["stg_sessions"], _merged("stg_sessions", "session_id", "_ex", "_in", "update"),
    extra_ctes=chain("_ex", sessions=_ts_lt("start_time", "2024-01-15") + " OR start_time IS NULL") + ",\n"
    + chain("_in", sessions=_ts_ge("start_time", "2024-01-15")))

_WINDOW = (_ts_ge("transaction_date", "1998-05-01") + " AND " + _ts_lt("transaction_date", "1998-06-01"))
SQL["stg_billing_incremental"] = typed(
    COLS["stg_billing"], _merged("stg_billing", "transaction_id", "_ex", "_w", "ignore"),
    extra_ctes=chain("_ex", billing=_ts_lt("transaction_date", "1998-05-01") + " OR transaction_date IS NULL") + ",\n"
    + chain("_w", billing=_WINDOW))

_BACKFILL = (_ts_ge("transaction_date", "1998-04-01") + " AND " + _ts_lt("transaction_date", "1998-05-01"))
SQL["late_arrival_backfill"] = typed(
    COLS["stg_billing"], _merged("stg_billing", "transaction_id", "_k", "_w", "ignore")
    + " WHERE transaction_date >= TIMESTAMP '1998-04-01' AND transaction_date < TIMESTAMP '1998-05-01'",
    extra_ctes=chain("_k", billing="ingested_at < TIMESTAMP '1998-05-01'") + ",\n"
    + chain("_w", billing=_BACKFILL))

_APRIL_MAY = _ts_ge("transaction_date", "1998-04-01") + " AND " + _ts_lt("transaction_date", "1998-06-01")
SQL["backfill_planned"] = typed(
    COLS["stg_billing"], _merged("stg_billing", "transaction_id", "_a", "_m", "ignore"),
    extra_ctes=chain("_a", billing=_BACKFILL) + ",\n" + chain("_m", billing=_APRIL_MAY + " AND NOT (" + _BACKFILL + ")"))

SQL["dw_upsert"] = typed(
    COLS["dw_user_analytics"], _merged("dw_user_analytics", "customer_id", "_s", "_n", "update"),
    extra_ctes=chain("_s", customers=_ts_lt("created_at", "2022-06-01") + " OR created_at IS NULL",
                     billing=_ts_lt("transaction_date", "2022-06-01") + " OR transaction_date IS NULL",
                     sessions=_ts_lt("start_time", "2022-06-01") + " OR start_time IS NULL",
                     as_of="2022-06-01 00:00:00")
    + ",\n" + chain("_n", customers=_ts_ge("created_at", "2022-01-01")))

SQL["cdc_apply_customers"] = typed(
    COLS["stg_customers"], _merged("stg_customers", "customer_id", "_t", "_f", "update"),
    extra_ctes=chain("_t", customers="NOT (" + _ts_ge("created_at", "2023-06-01") + ") OR created_at IS NULL")
    + ",\n" + chain("_f", customers=_ts_ge("created_at", "2023-06-01")))

SQL["cdc_late_changes"] = typed(
    COLS["stg_customers"],
    "(SELECT unnest(CASE WHEN f.customer_id IS NULL OR t.created_at > f.created_at THEN t ELSE f END) "
    "FROM stg_customers_t t FULL JOIN stg_customers_f f ON t.customer_id = f.customer_id) m",
    extra_ctes=chain("_t", customers=_ts_ge("created_at", "2023-06-01")) + ",\n"
    + chain("_f", customers="NOT (" + _ts_ge("created_at", "2023-06-01") + ") OR created_at IS NULL"))

SQL["dw_missing_inputs"] = typed(
    COLS["dw_user_analytics"],
    "(SELECT * REPLACE (0 AS total_data_used_mb, 0 AS avg_session_duration_sec, 0 AS total_sessions, "
    "0 AS avg_data_per_session_mb) FROM dw_user_analytics) t")

SQL["dw_partitioned"] = typed(
    COLS["dw_user_analytics"] + ", customer_since_date day",
    "(SELECT *, CAST(customer_since AS DATE) AS customer_since_date FROM dw_user_analytics) t")

SQL["agg_reconciliation_window"] = typed(COLS["agg_user_revenue"], "agg_user_revenue")

_UNKNOWN = """
billing_remapped AS (
  SELECT transaction_id, CASE WHEN customer_id IN (SELECT customer_id FROM stg_customers)
    THEN customer_id ELSE 'UNKNOWN' END AS customer_id, amount, transaction_date FROM stg_billing),
customers_u AS (
  SELECT customer_id, customer_name, email, country, created_at FROM stg_customers
  UNION ALL SELECT 'UNKNOWN', 'Unknown Customer', NULL, NULL, NULL),
""" + _wide("dw_u", "customers_u", "billing_remapped").replace("__ASOF__", "2024-02-01 00:00:00")
SQL["dw_with_unknown_customer"] = typed(COLS["dw_user_analytics"], "dw_u", extra_ctes=_UNKNOWN)

SQL["cdc_stream_customers"] = SQL["cdc_apply_customers"]

#: The daily run: billing as loaded incrementally, customers and sessions whole.
_RUN_NAMES = ["stg_billing", *CHAIN_NAMES[4:]]
_RUN = (chain("_ex", billing=_ts_lt("transaction_date", "1998-05-01") + " OR transaction_date IS NULL") + ",\n"
        + chain("_w", billing=_WINDOW) + ",\nstg_billing_run AS (SELECT * FROM "
        + _merged("stg_billing", "transaction_id", "_ex", "_w", "ignore") + "),\n"
        + re.sub(r"\b(" + "|".join(_RUN_NAMES) + r")\b", lambda m: m.group(1) + "_run",
                 TRANSFORMS.strip().replace("__ASOF__", "2024-02-01 00:00:00")))
SQL["pipeline_daily_run"] = typed(COLS["dw_user_analytics"], "dw_user_analytics_run", extra_ctes=_RUN)
for _key, _table in (("second_day_revenue", "agg_user_revenue"), ("second_day_monthly_revenue", "agg_monthly_revenue"),
                     ("second_day_usage", "agg_user_usage")):
    SQL[_key] = typed(COLS[_table], f"{_table}_run", extra_ctes=_RUN)
SQL["pipeline_daily_quarantine"] = typed(
    "source_table s, issue_type s, n_rows i",
    "(SELECT source_table, issue_type, COUNT(*) AS n_rows FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS source_table, '{i}' AS issue_type FROM {t} WHERE {p}"
                         for t, i, p in _QUARANTINE_SETS) + ") q GROUP BY source_table, issue_type) t")

#: Two runs, customers registered since the cutoff unknown to the first: in the end as if they had been there all along.
SQL["second_day_orphans"] = typed(
    COLS["dw_user_analytics"], "dw_u", extra_ctes=_RUN + ",\n" + _UNKNOWN.replace("FROM stg_billing)", "FROM stg_billing_run)"))
SQL["orphan_lines"] = typed(
    "customer_id s, status s, revenue d, n i",
    "(SELECT customer_id, 'open' AS status, SUM(amount) AS revenue, COUNT(*) AS n FROM stg_billing_run "
    "WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM stg_customers) GROUP BY customer_id "
    "UNION ALL SELECT customer_id, 'released', SUM(amount), COUNT(*) FROM stg_billing_ex "
    "WHERE customer_id IN (SELECT customer_id FROM stg_customers) AND customer_id NOT IN (SELECT customer_id FROM stg_customers_k) "
    "GROUP BY customer_id) t",
    extra_ctes=_RUN + ",\n" + chain("_k", customers="NOT (" + _ts_ge("created_at", "2023-06-01") + ") OR created_at IS NULL"))
