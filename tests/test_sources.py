import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark.session import fresh_dir
from tallyspark.sources.readers import conform, land, read_or_empty, source_row_counts
from tallyspark import schemas as S


def _write_lines(spark, path, lines):
    """A raw text file written through Spark (works for any URI the work root uses)."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_csv_landing_prunes_casts_stamps_and_keeps_corrupt_lines(spark):
    path = fresh_dir(spark, "raw-billing")
    _write_lines(spark, path, ["transaction_id,customer_id,amount,transaction_date,currency",
                               "t1,7,12.50,2024-01-01 10:00:00,NGN",
                               "t2,,,2024-01-02 10:00:00,NGN",
                               "t3,8,abc,2024-01-03 10:00:00,NGN"])
    df = land(spark, P.SRC_BILLING, path, load_time=dt.datetime(2024, 2, 1), keep_corrupt=True)
    assert df.columns == [f.name for f in S.SRC_BILLING.fields] + ["_corrupt_record"]
    rows = {r["transaction_id"]: r for r in df.collect()}
    assert str(rows["t1"]["amount"]) == "12.50" and rows["t1"]["_corrupt_record"] is None
    assert rows["t2"]["customer_id"] is None and rows["t2"]["amount"] is None
    assert rows["t3"]["amount"] is None and rows["t3"]["_corrupt_record"].startswith("t3,8,abc")
    assert rows["t1"]["ingested_at"] == dt.datetime(2024, 2, 1)


def test_csv_missing_tokens_quotes_and_bad_numbers(spark):
    path = fresh_dir(spark, "raw-billing")
    _write_lines(spark, path, ["transaction_id,customer_id,amount,transaction_date,currency",
                               't1,NA,null,"a ""b"" c",NGN', "t2,8,3.5,N/A,NGN"])
    rows = {r["transaction_id"]: r for r in land(spark, P.SRC_BILLING, path).collect()}
    assert rows["t1"]["customer_id"] is None and rows["t1"]["amount"] is None
    assert rows["t1"]["transaction_date"] == 'a "b" c' and rows["t2"]["transaction_date"] is None
    kept = land(spark, P.SRC_BILLING, path, keep_corrupt=True).collect()
    assert len(kept) == 2 and all(r["_corrupt_record"] is None for r in kept)
    bad = fresh_dir(spark, "raw-billing")
    _write_lines(spark, bad, ["transaction_id,customer_id,amount,transaction_date,currency", "t3,8,abc,x,NGN"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        land(spark, P.SRC_BILLING, bad).collect()


@pytest.mark.parametrize("keep", [False, True])
def test_csv_columns_are_bound_by_name_in_each_file(spark, keep):
    path = fresh_dir(spark, "raw-billing")
    for k, lines in enumerate([["transaction_id,customer_id,amount,transaction_date,currency", "t1,c1,1.50,2024-01-01 10:00:00,NGN"],
                               ["customer_id,transaction_id,transaction_date,amount", "c2,t2,2024-01-02 10:00:00,2.50"],
                               ["transaction_id,customer_id", "t3,c3"], []]):
        _write_lines(spark, f"{path}/f{k}", lines)
    df = land(spark, P.SRC_BILLING, f"{path}/*", keep_corrupt=keep)
    got = {r["transaction_id"]: (r["customer_id"], r["amount"] and str(r["amount"]), r["transaction_date"]) for r in df.collect()}
    assert got == {"t1": ("c1", "1.50", "2024-01-01 10:00:00"), "t2": ("c2", "2.50", "2024-01-02 10:00:00"), "t3": ("c3", None, None)}
    if keep:
        assert df.where("_corrupt_record is not null").count() == 0


def test_bad_lines_are_quarantined_and_counted_by_the_run(spark):
    from tallyspark.__main__ import main
    paths = {n: fresh_dir(spark, f"raw-{n}") for n in ("customers", "billing", "sessions")}
    _write_lines(spark, paths["customers"], ["customer_id,name,email,country,created_at", "c1,a,b,,2024-01-01 00:00:00"])
    _write_lines(spark, paths["billing"], ["transaction_id,customer_id,amount,transaction_date", "t1,c1,1.00,2024-01-01 10:00:00", "t2,c1,abc,2024-01-01 11:00:00"])
    _write_lines(spark, paths["sessions"], ["session_id,customer_id,start_time,end_time,data_used_mb"])
    out = fresh_dir(spark, "bad-lines")
    args = [x for n, p in paths.items() for x in (f"--{n}", p)] + ["--out", out, "--mode", "full", "--as-of", "2024-01-02 03:00:00", "--keep-bad-lines"]
    for turn in range(2):                                    # a rerun adds no line twice
        report = main(args, spark=spark)
        assert all(v == "ok" for v in report["status"].values()), report["status"]
        assert report["metrics"][P.SRC_BILLING] == {"bad_lines": 1}
        rows = spark.read.parquet(f"{out}/quarantine").collect()
        assert [(r["issue_type"], "t2,c1,abc" in r["row_data"]) for r in rows] == [(P.ISSUE_MALFORMED_LINE, True)]
        assert [r["transaction_id"] for r in spark.read.parquet(f"{out}/stg_billing").collect()] == ["t1"]


def test_nan_becomes_null_before_decimal_cast(spark):
    raw = spark.createDataFrame([("t1", "1", float("nan"), "2024-01-01 00:00:00"),
                                 ("t2", "1", 3.25, "2024-01-01 00:00:00")],
                                "transaction_id string, customer_id string, amount double, transaction_date string")
    got = {r[0]: r[1] for r in conform(raw, P.SRC_BILLING).select("transaction_id", "amount").collect()}
    assert got["t1"] is None and str(got["t2"]) == "3.25"


def test_missing_table_reads_empty_and_counts(spark):
    empty = read_or_empty(spark, fresh_dir(spark, "nothing-here"), S.AGG_USER_USAGE)
    assert empty.count() == 0 and empty.schema == S.AGG_USER_USAGE
    counts = {r[0]: r[1] for r in source_row_counts({"a": spark.range(3), "b": empty}).collect()}
    assert counts == {"a": 3, "b": 0}


def test_cluster_settings_scale_with_input():
    from tallyspark.session import cluster_settings
    big = cluster_settings(100 * 2**40)
    small = cluster_settings(10 * 2**30)
    assert big["spark.sql.shuffle.partitions"] == "409600"
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
