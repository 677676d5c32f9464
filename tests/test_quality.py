import json

from tallyspark import params as P
from tallyspark import schemas as S
from tallyspark.operators import quality as QL

from .conftest import billing_rows


def test_exact_copies_both_quarantined_then_rerun_adds_nothing(spark, make):
    src = make(S.SRC_BILLING, billing_rows(("t1", "1", "1.00", "2024-01-01 00:00:00"),
                                           ("t1", "1", "1.00", "2024-01-01 00:00:00"),
                                           ("t2", None, "2.00", "2024-01-01 00:00:00")))
    rule = QL.RULES[P.SRC_BILLING]
    empty = QL.empty_quarantine(spark)
    first = QL.with_quarantine_ids(QL.quarantine_source(src, rule, empty), empty)
    rows = first.collect()
    assert sorted((r["issue_type"], json.loads(r["row_data"])["transaction_id"]) for r in rows) == [
        ("Duplicate transaction_id", "t1"), ("Duplicate transaction_id", "t1"),
        ("NULL transaction_id or customer_id", "t2")]
    assert len({r["quarantine_id"] for r in rows}) == 3
    assert QL.quarantine_source(src, rule, first).count() == 0


def test_ids_are_dense_over_two_runs_in_insert_order(spark, make):
    from .conftest import customers_rows, sessions_rows
    bill = [("t1", "1", "1.00", "2024-01-01 00:00:00")] * 3 + [("t2", None, "2.00", None), (None, "3", "2.00", None), ("t9", "1", "1.00", None)]
    srcs = {P.SRC_BILLING: make(S.SRC_BILLING, billing_rows(*bill)),
            P.SRC_SESSIONS: make(S.SRC_SESSIONS, sessions_rows((None, "1", None, None, None), ("s", "1", None, None, None), ("s", "1", None, None, None))),
            P.SRC_CUSTOMERS: make(S.SRC_CUSTOMERS, customers_rows((None, "a", "b", None, None), ("c", "a", "b", None, None), ("c", "x", "b", None, None)))}
    empty = QL.empty_quarantine(spark)
    first = QL.with_quarantine_ids(QL.quarantine_all(srcs, empty), empty)
    more = srcs | {P.SRC_BILLING: make(S.SRC_BILLING, billing_rows(*bill, ("t3", None, None, None), ("t9", "1", "5.00", None)))}
    second = QL.with_quarantine_ids(QL.quarantine_all(more, first), first)
    rows = sorted(first.unionByName(second).collect(), key=lambda r: r["quarantine_id"])
    assert [r["quarantine_id"] for r in rows] == list(range(1, len(rows) + 1)) and first.count() == 11 and second.count() == 3
    places = [QL.INSERT_ORDER.index((r["source_table"], r["issue_type"])) for r in rows]
    assert places[:11] == sorted(places[:11]) and places[11:] == [0, 1, 1]


def test_row_images_are_never_a_shuffle_key(spark):
    from tallyspark.sources.fixtures import sources
    from .test_plans import plan
    src = sources(spark, "/root/testdata/sf0.001")[P.SRC_BILLING]
    text = plan(QL.quarantine_source(src, QL.RULES[P.SRC_BILLING], QL.empty_quarantine(spark)))
    keys = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert keys and not any("row_data" in line for line in keys)
    assert text.count("Scan parquet") == 2                          # the id column to count, then the rows once


def test_images_are_made_of_bad_rows_only(spark):
    """The join that finds them carries columns; the image stands above it, and the duplicated ids are hashed, the rows not sorted."""
    from tallyspark.sources.fixtures import sources
    src = sources(spark, "/root/testdata/sf0.001")[P.SRC_BILLING]
    lines = QL.quarantine_source(src, QL.RULES[P.SRC_BILLING], QL.empty_quarantine(spark))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    image = next(k for k, line in enumerate(lines) if "json" in line.lower())
    join = next(k for k, line in enumerate(lines) if "Join LeftOuter" in line)
    assert image < join and not any("json" in line.lower() for line in lines[join:]) and "rightHint=(strategy=shuffle_hash)" in lines[join]


def test_daily_queries_derive_their_sources_once(spark):
    from tallyspark import registry
    from tallyspark.sources.fixtures import sources
    from .conftest import SF_SMALL
    for name, src in registry._delivered(spark, SF_SMALL).items():
        assert "Generate" not in src._jdf.queryExecution().optimizedPlan().toString()
        want = sources(spark, SF_SMALL)[name]
        assert src.dtypes == want.dtypes and sorted(map(str, src.collect())) == sorted(map(str, want.collect()))


def test_null_fields_kept_in_row_data(spark, make):
    src = make(S.SRC_BILLING, billing_rows(("t2", None, None, "2024-01-01 00:00:00")))
    r = QL.quarantine_source(src, QL.RULES[P.SRC_BILLING], QL.empty_quarantine(spark)).first()
    image = json.loads(r["row_data"])
    assert image["customer_id"] is None and image["amount"] is None and "ingested_at" in image


def test_billing_null_insert_ignores_issue_type(spark, make):
    """Billing's NULL-id insert skips a row quarantined under any issue; sessions' does not."""
    src = make(S.SRC_BILLING, billing_rows(("t2", None, "2.00", "2024-01-01 00:00:00")))
    rule = QL.RULES[P.SRC_BILLING]
    image = QL.quarantine_source(src, rule, QL.empty_quarantine(spark)).first()["row_data"]
    other = spark.createDataFrame([(1, image, P.SRC_BILLING, "some other issue", None)], S.QUARANTINE)
    assert QL.quarantine_null_ids(src, rule, other).count() == 0


def test_checks_on_fixture(spark):
    from tallyspark.sources.fixtures import sources
    srcs = sources(spark, "/root/testdata/sf0.001")
    assert QL.check_null_ids(srcs[P.SRC_BILLING], QL.RULES[P.SRC_BILLING]).count() == 24
    assert QL.duplicate_ids(srcs[P.SRC_SESSIONS], "session_id").count() == 40
    late = QL.late_arrivals(srcs[P.SRC_BILLING], P.LATE_LAG_DAYS)
    assert late.count() == 36


def test_freshness(spark):
    import datetime as dt
    from tallyspark.operators.staging import stage_billing
    from tallyspark.sources.fixtures import sources
    stg = stage_billing(sources(spark, "/root/testdata/sf0.01")[P.SRC_BILLING])
    rows = QL.freshness_check(stg, [P.FRESH_CHECK_AT, P.AS_OF]).orderBy("checked_at").collect()
    assert [r["is_stale"] for r in rows] == [False, True]
    assert rows[0]["max_transaction_date"] == dt.datetime(2001, 8, 1, 10, 15)


def test_volume_anomaly_counts(spark):
    from pyspark.sql import functions as F
    from tallyspark.operators.staging import stage_billing
    from tallyspark.sources.fixtures import sources
    stg = stage_billing(sources(spark, "/root/testdata/sf0.01")[P.SRC_BILLING])
    v = QL.volume_anomaly(stg, P.VOLUME_FIRST_DAY, P.AS_OF.date())
    assert v.where("day is not null").count() == 2405 and v.where("day is null").first()["loads"] == stg.where("transaction_date is null").count() and v.where(F.col("is_anomaly")).count() == 111


def test_volume_calendar_is_bounded(spark):
    import datetime as dt
    stg = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(9999, 12, 30),)], "transaction_date timestamp")
    days = QL.volume_anomaly(stg, dt.date(2023, 1, 1), dt.date(2024, 2, 1)).collect()
    assert {(r["day"], r["loads"]) for r in days} == {(dt.date(2024, 1, 1), 1), (None, 1)}
