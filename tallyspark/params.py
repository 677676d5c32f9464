"""Run parameters and fixed values.

FIXED VALUES (must equal the reference's for identical results): the default country, the
session-bucket thresholds, the quality-issue labels, the source table names, the churn and
mismatch thresholds, the freshness limit and the audit status text.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values -------------------------------------------------------------------------
DEFAULT_COUNTRY = "Nigeria"

SHORT_SESSION_MAX_SEC = 60      # duration < 60  -> short
MEDIUM_SESSION_MAX_SEC = 300    # duration < 300 -> medium, else long

SRC_CUSTOMERS = "src_customers"
SRC_BILLING = "src_billing_transactions"
SRC_SESSIONS = "src_network_sessions"

ISSUE_BILLING_NULL_IDS = "NULL transaction_id or customer_id"
ISSUE_BILLING_DUPLICATE = "Duplicate transaction_id"
ISSUE_SESSIONS_NULL_IDS = "NULL session_id or customer_id"
ISSUE_SESSIONS_DUPLICATE = "Duplicate session_id"
ISSUE_CUSTOMERS_NULL_ID = "NULL customer_id"
ISSUE_CUSTOMERS_DUPLICATE = "Duplicate customer_id"

CHURN_MAX_SESSIONS = 5          # total_sessions < 5
CHURN_MAX_REVENUE = 1000        # total_revenue < 1000
CHURN_MIN_TENURE_DAYS = 30      # customer_since < now - 30 days
CHURN_SESSIONS_PER_WEEK = 1     # tenure-normalised rule: < 1 session per week
CHURN_REVENUE_PER_WEEK = 250    # and < 250 revenue per week

HIGH_USAGE_MB = 500             # 'High usage / low spend': data > 500 and revenue < 3000
LOW_SPEND_REVENUE = 3000
LOW_USAGE_MB = 100              # 'Low usage / high spend': data < 100 and revenue > 5000
HIGH_SPEND_REVENUE = 5000
FLAG_HIGH_USAGE = "High usage / low spend"
FLAG_LOW_USAGE = "Low usage / high spend"
FLAG_NORMAL = "Normal"

FRESHNESS_MAX_HOURS = 25
AUDIT_STATUS_SUCCESS = "SUCCESS"
UNKNOWN_CUSTOMER_ID = "UNKNOWN"
# ------------------------------------------------------------------------------------------

# Labels of checks the reference only describes in prose (our wording).
ISSUE_BILLING_ORPHAN = "customer_id not in src_customers"
ISSUE_MALFORMED_LINE = "malformed line"

# Run parameters of the test fixtures (FIXTURES.md section 2).
AS_OF = _dt.datetime(2024, 2, 1, 0, 0, 0)
T_START = _dt.date(1998, 5, 1)
T_END = _dt.date(1998, 6, 1)
LATE_LAG_DAYS = 2
FRESH_CHECK_AT = _dt.datetime(2001, 8, 2, 11, 0, 0)
BILLING_UPSERT_CUTOFF = _dt.date(1998, 5, 1)
SESSIONS_UPSERT_CUTOFF = _dt.date(2024, 1, 15)
DW_SNAPSHOT_CUTOFF = _dt.date(2022, 6, 1)       # first warehouse load: data before this date
DW_CHANGED_SINCE = _dt.date(2022, 1, 1)         # second load: customers registered since
CDC_CUTOFF = _dt.date(2023, 6, 1)               # change feed: rows created from this date
BACKFILL_START = _dt.date(1998, 4, 1)
RECONCILE_FROM = _dt.date(2001, 7, 2)           # recompute daily partials from this day
RECONCILE_DAYS = 40                             # of the second daily run
ROW_GATE_MIN_ROWS = 100
VOLUME_FIRST_DAY = _dt.date(1990, 1, 1)         # calendar of the volume check
VOLUME_LOOKBACK_DAYS = 7
VOLUME_SIGMAS = 2

# fixed values: CSV fields that stand for a missing value, besides the empty field
MISSING_TOKENS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                  "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
