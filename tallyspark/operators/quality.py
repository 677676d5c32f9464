"""Data-quality checks, quarantine, and the monitoring checks (freshness, volume, gates).

Quarantine semantics (per source, in order): rows with a NULL identifier, then every copy of a
duplicated identifier (the surviving copy too), each as a JSON image of the whole row, skipped
when the same (source_table, [issue_type], row_data) is already quarantined (NOT EXISTS ->
left anti join). Within one run all copies of a duplicate are inserted; a rerun inserts none.
Quarantine never removes rows from the source: staging filters and dedups on its own. Images are
compared by their SHA-256, which the stored quarantine keeps beside them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions import row_json, struct_json
from .ids import dense_ids
from .skew import expand_copies
from .staging import _ts, stage_billing


@dataclass(frozen=True)
class IdRule:
    source_table: str
    key: str
    null_cols: tuple[str, ...]
    null_issue: str
    dup_issue: str
    null_matches_issue_type: bool = True   # the billing NULL-id insert ignores issue_type


RULES = {
    P.SRC_BILLING: IdRule(P.SRC_BILLING, "transaction_id", ("transaction_id", "customer_id"),
                          P.ISSUE_BILLING_NULL_IDS, P.ISSUE_BILLING_DUPLICATE, False),
    P.SRC_SESSIONS: IdRule(P.SRC_SESSIONS, "session_id", ("session_id", "customer_id"),
                           P.ISSUE_SESSIONS_NULL_IDS, P.ISSUE_SESSIONS_DUPLICATE),
    P.SRC_CUSTOMERS: IdRule(P.SRC_CUSTOMERS, "customer_id", ("customer_id",),
                            P.ISSUE_CUSTOMERS_NULL_ID, P.ISSUE_CUSTOMERS_DUPLICATE),
}

CHECK_COLUMNS = {
    P.SRC_BILLING: ["transaction_id", "customer_id", "amount", "transaction_date"],
    P.SRC_SESSIONS: ["session_id", "customer_id", "start_time", "end_time", "data_used_mb"],
}

SOURCE_SCHEMAS = {P.SRC_BILLING: S.SRC_BILLING, P.SRC_SESSIONS: S.SRC_SESSIONS,
                  P.SRC_CUSTOMERS: S.SRC_CUSTOMERS}


def _any_null(cols) -> F.Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


# --- checks (SELECTs whose rows describe the problem) -----------------------------------------
def check_null_ids(src: DataFrame, rule: IdRule) -> DataFrame:
    cols = CHECK_COLUMNS.get(rule.source_table, list(src.columns))
    return src.where(_any_null(rule.null_cols)).select(*cols, F.lit(rule.null_issue).alias("issue"))


def duplicate_ids(src: DataFrame, key: str) -> DataFrame:
    """Ids occurring more than once (NULL ids excluded before the shuffle)."""
    return (src.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def bad_rows(src: DataFrame, rule: IdRule) -> tuple[int, int]:
    """(rows with a NULL identifier or a duplicated id, each once; all rows), in one aggregate. NULL ids are
    counted before the shuffle, so they never meet in one task."""
    per_id = (src.select(F.col(rule.key).alias("k"), _any_null(rule.null_cols).cast("int").alias("bad"))
              .groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")))
    worst = F.when((F.col("n") > 1) | F.col("k").isNull(), F.col("n")).otherwise(F.col("bad"))
    got = per_id.agg(F.sum(worst), F.sum("n")).first()
    return got[0] or 0, got[1] or 0


# --- quarantine --------------------------------------------------------------------------------
def empty_quarantine(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.QUARANTINE)


def _image(rows: DataFrame, exclude_cols: tuple[str, ...]) -> F.Column:
    return row_json([c for c in rows.columns if c not in exclude_cols])


def _problems(src: DataFrame, rule: IdRule, exclude_cols: tuple[str, ...], which: tuple[str, ...]) -> DataFrame:
    """(row_data, issue_type): an image for each issue of ``which`` that a row has. The ids are counted from their column alone; then one scan
    of the rows tags both issues. Rows without an id are dealt out by number in the join that looks up duplicates, so they never meet in a task.
    The join carries the columns, and hashes the duplicated ids so that the rows need no sort; an image is made of the rows that have an issue, never
    of the others."""
    null = F.when(_any_null(rule.null_cols), F.lit(rule.null_issue))
    if which == (rule.null_issue,):
        return src.where(_any_null(rule.null_cols)).select(_image(src, exclude_cols).alias("row_data"), null.alias("issue_type"))
    spread = F.concat(F.lit("\u0000"), (F.monotonically_increasing_id() % 4096).cast("string"))
    dups = duplicate_ids(src, rule.key).select(F.col(rule.key).alias("_k"), F.lit(True).alias("_dup"))
    rows = src.select(F.struct(*(c for c in src.columns if c not in exclude_cols)).alias("_row"), null.alias("_null"), F.coalesce(F.col(rule.key), spread).alias("_k"))
    issues = ([F.col("_null")] if rule.null_issue in which else []) + [F.when(F.col("_dup"), F.lit(rule.dup_issue))]
    return (rows.join(dups.hint("shuffle_hash"), "_k", "left").where(F.col("_dup") | F.col("_null").isNotNull())
            .select(struct_json("_row").alias("row_data"), F.explode(F.array_compact(F.array(*issues))).alias("issue_type")))


def _hash(df: DataFrame) -> F.Column:
    """The stored hash of an image, or its own."""
    own = F.sha2("row_data", 256)
    return F.coalesce(F.col("row_hash"), own) if "row_hash" in df.columns else own


def _not_already(images: DataFrame, existing: DataFrame, source_table: str, ignores_issue: str | None = None) -> DataFrame:
    """Images (row_data, issue_type) not yet in the quarantine (NOT EXISTS -> left anti join), with source table and hash.

    Images meet by their SHA-256, never by their text. Identical ones (exact copies of a retried record) are counted first, so the
    shuffle carries one row per distinct image; the copies are re-expanded afterwards (the reference inserts every
    copy). Images of the issue ``ignores_issue`` are known if they are quarantined under any issue.
    """
    prior = (existing.where(F.col("source_table") == source_table)
             .select(_hash(existing).alias("old_hash"), F.col("issue_type").alias("old_issue")).distinct())
    counted = (images.withColumn("row_hash", F.sha2("row_data", 256)).groupBy("row_hash", "issue_type")
               .agg(F.count(F.lit(1)).alias("_copies"), F.any_value("row_data").alias("row_data")))
    same = F.col("old_issue") == F.col("issue_type")
    if ignores_issue is not None:
        same = same | (F.col("issue_type") == ignores_issue)
    fresh = counted.join(prior, (F.col("row_hash") == F.col("old_hash")) & same, "left_anti")
    return expand_copies(fresh, ["row_hash"], number="copy_no") \
        .select("row_data", F.lit(source_table).alias("source_table"), "issue_type", "row_hash", "copy_no")


def _quarantine(src: DataFrame, rule: IdRule, existing: DataFrame, exclude_cols: tuple[str, ...], which: tuple[str, ...]) -> DataFrame:
    return _not_already(_problems(src, rule, exclude_cols, which), existing, rule.source_table,
                        None if rule.null_matches_issue_type else rule.null_issue)


def quarantine_null_ids(src: DataFrame, rule: IdRule, existing: DataFrame,
                        exclude_cols: tuple[str, ...] = ()) -> DataFrame:
    return _quarantine(src, rule, existing, exclude_cols, (rule.null_issue,))


def quarantine_duplicates(src: DataFrame, rule: IdRule, existing: DataFrame,
                          exclude_cols: tuple[str, ...] = ()) -> DataFrame:
    """Every row whose id is duplicated."""
    return _quarantine(src, rule, existing, exclude_cols, (rule.dup_issue,))


def quarantine_source(src: DataFrame, rule: IdRule, existing: DataFrame,
                      exclude_cols: tuple[str, ...] = ()) -> DataFrame:
    """Both issues of a source, in one pass over its rows."""
    return _quarantine(src, rule, existing, exclude_cols, (rule.null_issue, rule.dup_issue))


def quarantine_malformed(lines: DataFrame, source_table: str, existing: DataFrame) -> DataFrame:
    """Lines (one text column) that could not be read as rows, as {"line": ...}."""
    image = F.to_json(F.struct(F.col(lines.columns[0]).alias("line")))
    return _not_already(lines.select(image.alias("row_data"), F.lit(P.ISSUE_MALFORMED_LINE).alias("issue_type")), existing, source_table)


def quarantine_all(sources: dict[str, DataFrame], existing: DataFrame,
                   exclude_cols: tuple[str, ...] = ()) -> DataFrame:
    """The quarantine inserts of one run (billing, sessions, customers; of each the NULL ids, then the duplicates)."""
    parts = [quarantine_source(sources[name], RULES[name], existing, exclude_cols) for name in RULES]
    return reduce(DataFrame.unionByName, parts)


INSERT_ORDER = [(r.source_table, issue) for r in RULES.values() for issue in (r.null_issue, r.dup_issue)]


def with_quarantine_ids(new_rows: DataFrame, existing: DataFrame,
                        as_of: dt.datetime | None = None, offset: int | None = None) -> DataFrame:
    """Assign BIGSERIAL-like ids and detected_at: dense, after the largest id there is, in the order of the reference's six
    inserts (other issues last)."""
    if offset is None:
        offset = existing.agg(F.coalesce(F.max("quarantine_id"), F.lit(0)).alias("m")).first()["m"]
    place = F.lit(len(INSERT_ORDER))
    for k, (source, issue) in reversed(list(enumerate(INSERT_ORDER))):
        place = F.when((F.col("source_table") == source) & (F.col("issue_type") == issue), F.lit(k)).otherwise(place)
    if "row_hash" not in new_rows.columns:
        new_rows = new_rows.withColumn("row_hash", F.sha2("row_data", 256))
    order = ["_place", "row_hash"] + [c for c in ("copy_no",) if c in new_rows.columns]       # copies of a hot row are many partitions
    numbered = dense_ids(new_rows.withColumn("_place", place), order, "quarantine_id", offset)
    return numbered.select("quarantine_id", "row_data", "source_table", "issue_type", _ts(as_of).alias("detected_at"), "row_hash")


def parse_quarantined(q: DataFrame, source_table: str) -> DataFrame:
    """Quarantined rows of one source back as typed columns (JSON image -> struct)."""
    schema = SOURCE_SCHEMAS[source_table]
    return (q.where(F.col("source_table") == source_table)
            .select(F.from_json("row_data", schema).alias("r"), "source_table", "issue_type")
            .select("r.*", "source_table", "issue_type"))


# --- referential integrity (orphans) ------------------------------------------------------------
def orphan_customer_ids(src_billing: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct billing customer ids absent from the customer master.

    Distinct first: partial aggregation reduces a hot customer to one row per map task before
    the anti join, so skewed ids never pile into one join task.
    """
    ids = src_billing.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    known = customers.where(F.col("customer_id").isNotNull()).select("customer_id")
    return ids.join(known, "customer_id", "left_anti")


def _orphan_rows(src_billing: DataFrame, customers: DataFrame) -> DataFrame:
    """Billing rows of orphan customers: one anti join, one scan of billing. AQE's skew join splits
    a hot customer's partition, as the billing side of an anti join may be split."""
    known = customers.where(F.col("customer_id").isNotNull()).select("customer_id")
    return src_billing.where(F.col("customer_id").isNotNull()).join(known, "customer_id", "left_anti")


def check_billing_orphans(src_billing: DataFrame, customers: DataFrame) -> DataFrame:
    return (_orphan_rows(src_billing, customers)
            .select(*CHECK_COLUMNS[P.SRC_BILLING], F.lit(P.ISSUE_BILLING_ORPHAN).alias("issue")))


def quarantine_billing_orphans(src_billing: DataFrame, customers: DataFrame, existing: DataFrame,
                               exclude_cols: tuple[str, ...] = ()) -> DataFrame:
    rows = _orphan_rows(src_billing, customers).select(*src_billing.columns)
    images = rows.select(_image(rows, exclude_cols).alias("row_data"), F.lit(P.ISSUE_BILLING_ORPHAN).alias("issue_type"))
    return _not_already(images, existing, P.SRC_BILLING)


# --- monitoring checks ----------------------------------------------------------------------------
def freshness_check(stg_billing: DataFrame, checked_at: list[dt.datetime],
                    max_hours: int = P.FRESHNESS_MAX_HOURS, date_col: str = "transaction_date") -> DataFrame:
    """Latest loaded transaction vs each check time: stale when more than ``max_hours`` behind.

    One global max (partial per task); the check times are expanded from that single row. Daily state serves as well as the
    facts, with its ``latest`` as ``date_col``.
    """
    times = F.array(*[_ts(t, ntz=True) for t in checked_at])
    latest = stg_billing.agg(F.max(date_col).cast("timestamp_ntz").alias("latest"))
    behind = (F.unix_micros(F.col("checked_at").cast("timestamp")) -
              F.unix_micros(F.col("latest").cast("timestamp"))) / F.lit(60_000_000)
    return (latest.select("latest", F.explode(times).alias("checked_at"))
            .select(F.col("latest").alias("max_transaction_date"), "checked_at",
                    F.floor(behind).cast("bigint").alias("minutes_behind"),
                    (F.col("latest").isNull() | (behind > max_hours * 60)).alias("is_stale")))


def row_count_gate(src_billing: DataFrame, t_start: dt.date, t_end: dt.date,
                   min_rows: int = 1) -> DataFrame:
    """Does the source hold at least ``min_rows`` rows for the window? (evaluated once)"""
    ts = F.col("transaction_date").cast("timestamp")
    n = (src_billing.where((ts >= _ts(t_start)) & (ts < _ts(t_end)))
         .agg(F.count(F.lit(1)).alias("rows")))
    return n.select(F.lit(t_start).alias("window_start"), F.lit(t_end).alias("window_end"),
                    "rows", F.lit(min_rows).cast("bigint").alias("min_rows"),
                    (F.col("rows") >= min_rows).alias("passed"))


def anomalies(daily: DataFrame, lookback_days: int = P.VOLUME_LOOKBACK_DAYS, sigmas: int = P.VOLUME_SIGMAS) -> DataFrame:
    """``daily``(day, loads) on a calendar without gaps (missing day = 0), against the mean - sigmas * sample sd of the
    ``lookback_days`` days before. The rolling statistics are an expand-and-aggregate (no single-partition window); the sample
    variance comes from exact integer sums, so every engine gets the same doubles."""
    spine = (daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
             .select(F.explode(F.sequence("lo", "hi")).alias("day")))
    series = spine.join(daily, "day", "left").select("day", F.coalesce("loads", F.lit(0)).alias("loads"))
    # Each day contributes to the windows of the next ``lookback_days`` days: expand, then sum
    # per target day (a shuffle-parallel aggregate instead of a single-partition window).
    x = F.col("loads").cast("double")
    prev = (series.select(F.explode(F.sequence(F.lit(1), F.lit(lookback_days))).alias("k"), "day", x.alias("x"))
            .groupBy(F.date_add("day", F.col("k")).alias("day"))
            .agg(F.sum("x").alias("s1"), F.sum(F.col("x") * F.col("x")).alias("s2"),
                 F.count("x").cast("double").alias("c")))
    s1, s2, c = F.col("s1"), F.col("s2"), F.col("c")
    mean = s1 / c
    sd = F.sqrt(F.when(c > 1, F.greatest(F.lit(0.0), (s2 - s1 * s1 / c) / (c - 1))))
    return (series.join(prev, "day", "left")
            .select("day", "loads", mean.alias("mean_prev"), sd.alias("sd_prev"))
            .withColumn("is_anomaly", F.coalesce(F.col("loads") < F.col("mean_prev") - sigmas * F.col("sd_prev"),
                                                 F.lit(False))))


def volume_anomaly(stg_billing: DataFrame, first_day: dt.date, last_day: dt.date,
                   lookback_days: int = P.VOLUME_LOOKBACK_DAYS, sigmas: int = P.VOLUME_SIGMAS) -> DataFrame:
    """Rows of each transaction day vs the days before (see ``anomalies``).

    The calendar has one row per day of the date span within [first_day, last_day], so a mistyped date in the data cannot
    stretch it; rows without a date or dated outside are counted in one more line, whose day is NULL.
    """
    day = F.to_date("transaction_date")
    inside = F.coalesce(day.between(F.lit(first_day), F.lit(last_day)), F.lit(False))
    counts = stg_billing.groupBy(F.when(inside, day).alias("day")).agg(F.count(F.lit(1)).alias("loads"))
    outside = counts.where(F.col("day").isNull()).select("day", "loads", F.lit(None).cast("double").alias("mean_prev"),
                                                         F.lit(None).cast("double").alias("sd_prev"), F.lit(False).alias("is_anomaly"))
    return anomalies(counts.where(F.col("day").isNotNull()), lookback_days, sigmas).unionByName(outside)


def late_arrivals(src_billing: DataFrame, lag_days: int = 1) -> DataFrame:
    """Staged billing rows ingested more than ``lag_days`` after their transaction date, i.e.
    missed by their own daily window. ``stg_billing`` has no ingestion time, so the source's
    latest version of each transaction is used (same dedup order as staging)."""
    latest = stage_billing(src_billing, keep=("ingested_at",))
    days_late = F.datediff(F.to_date("ingested_at"), F.to_date("transaction_date"))
    return (latest.withColumn("days_late", days_late).where(F.col("days_late") > lag_days)
            .select("transaction_id", "customer_id", "amount", "transaction_date", "ingested_at", "days_late"))
