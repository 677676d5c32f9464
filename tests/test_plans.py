"""Physical-plan properties the design relies on."""

from tallyspark import params as P
from tallyspark.operators.staging import stage_billing, stage_billing_window
from tallyspark.plans.pipeline import build_stages, warehouse
from tallyspark.sources.fixtures import sources


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_reduced_before_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(stage_billing(sources(spark, "/root/testdata/sf0.001")[P.SRC_BILLING]))
        assert "WindowGroupLimit" in p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scans_read_only_needed_columns(spark):
    srcs = sources(spark, "/root/testdata/sf0.001")
    p = plan(stage_billing_window(srcs[P.SRC_BILLING], P.T_START, P.T_END))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:" in p
    assert "PushedFilters" in p


def test_warehouse_joins_add_no_shuffle(spark):
    """6 exchanges: one dedup per source, (customer, month) and customer for billing, customer
    for sessions. The two joins reuse those partitionings: the customer master is partitioned
    on customer_id by its own dedup, the metric frames by their groupBy(customer_id)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(warehouse(build_stages(sources(spark, "/root/testdata/sf0.001"))))
        assert p.count("Exchange hashpartitioning") == 6, p
        assert p.count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_iso_window_reaches_the_parquet_scan(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tallyspark.session import fresh_dir
    from tallyspark.sources.sinks import overwrite
    src = sources(spark, "/root/testdata/sf0.001")[P.SRC_BILLING]
    path = fresh_dir(spark, "landed-billing")
    overwrite(src, path)
    landed = spark.read.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        p = plan(stage_billing_window(landed, P.T_START, P.T_END, iso_text=True))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(transaction_date,1998-05-01)" in p
    assert "LessThan(transaction_date,1998-06-01)" in p
    plain = stage_billing_window(landed, P.T_START, P.T_END)
    iso = stage_billing_window(landed, P.T_START, P.T_END, iso_text=True)
    assert plain.exceptAll(iso).count() == 0 and iso.count() == plain.count() == 32
    assert dt.date(1998, 5, 1) == P.T_START and F is not None
