import datetime as dt

from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark import schemas as S
from tallyspark.operators import quality as QL
from tallyspark.plans.pipeline import run_pipeline
from tallyspark.session import fresh_dir
from tallyspark.sources.fixtures import sources

from .conftest import billing_rows


def test_pipeline_runs_and_reruns_idempotently(spark):
    srcs = sources(spark, "/root/testdata/sf0.001")
    out = fresh_dir(spark, "pipeline")
    first = run_pipeline(spark, srcs, out, billing_mode="full", as_of=P.AS_OF)
    assert all(v == "ok" for v in first.status.values()), first.status
    q1 = first.read(spark, "quarantine").count()
    dw1 = first.read(spark, "dw_user_analytics")
    assert dw1.count() == 149
    second = run_pipeline(spark, srcs, out, billing_mode="full", as_of=P.AS_OF)
    assert all(v == "ok" for v in second.status.values()), second.status
    assert second.read(spark, "quarantine").count() == q1
    dw2 = second.read(spark, "dw_user_analytics")
    assert dw2.exceptAll(dw1).count() == 0 and dw1.exceptAll(dw2).count() == 0
    audit = second.read(spark, "pipeline_audit_log").collect()
    assert len(audit) == 2 and audit[0]["billing_rows"] == second.read(spark, "stg_billing").count() and audit[0]["customer_rows"] == 149


def test_failed_branch_skips_dependants_only(spark):
    srcs = sources(spark, "/root/testdata/sf0.001")
    bad = dict(srcs)
    bad[P.SRC_SESSIONS] = srcs[P.SRC_SESSIONS].withColumn("start_time", F.lit("not a time"))
    res = run_pipeline(spark, bad, fresh_dir(spark, "pipeline-bad"), billing_mode="full")
    assert res.status["stage_sessions"].startswith("failed")
    assert res.status["agg_user_usage"].startswith("skipped")
    assert res.status["load_dw_user_analytics"].startswith("skipped")
    assert res.status["agg_user_revenue"] == "ok" and res.status["agg_arpu"] == "ok"


def test_incremental_window_runs_append_only(spark):
    srcs = sources(spark, "/root/testdata/sf0.01")
    out = fresh_dir(spark, "pipeline-inc")
    res = run_pipeline(spark, srcs, out, t_start=P.T_START, t_end=P.T_END)
    assert res.status["stage_billing"] == "ok"
    assert res.read(spark, "stg_billing").count() == 185            # as DuckDB counts it
    nxt = run_pipeline(spark, srcs, out, t_start=P.T_END, t_end=dt.date(1998, 7, 1))
    again = run_pipeline(spark, srcs, out, t_start=P.T_END, t_end=dt.date(1998, 7, 1))
    assert nxt.stored["stg_billing"].files() == again.stored["stg_billing"].files()    # the rerun wrote no file
    assert again.refreshed["_billing_daily"] == []
    got = again.read(spark, "stg_billing")
    assert got.count() == got.select("transaction_id").distinct().count()
    assert nxt.read(spark, "stg_billing").count() == got.count()    # the rerun added nothing


def test_default_window_is_the_day_before(spark, make):
    rows = billing_rows(("a", "1", "1.00", "2024-05-17 10:00:00"), ("b", "1", "2.00", "2024-05-18 01:00:00"))
    srcs = {"src_customers": make(S.SRC_CUSTOMERS, []), "src_network_sessions": make(S.SRC_SESSIONS, []),
            "src_billing_transactions": make(S.SRC_BILLING, rows)}
    res = run_pipeline(spark, srcs, fresh_dir(spark, "pipeline-day"), as_of=dt.datetime(2024, 5, 18, 3))
    assert [r["transaction_id"] for r in res.read(spark, "stg_billing").collect()] == ["a"]


def test_bad_ratio_gate_stops_only_that_source(spark):
    srcs = sources(spark, "/root/testdata/sf0.001")
    out = fresh_dir(spark, "pipeline-gate")
    shares = {n: QL.bad_rows(df, QL.RULES[n]) for n, df in srcs.items()}
    bad, total = shares["src_billing_transactions"]
    limit = (bad / total + shares["src_customers"][0] / shares["src_customers"][1]) / 2
    assert shares["src_customers"][0] / shares["src_customers"][1] < limit < bad / total
    res = run_pipeline(spark, srcs, out, billing_mode="full", max_bad_ratio=limit)
    again = run_pipeline(spark, srcs, out, billing_mode="full", max_bad_ratio=limit)
    assert again.status["quality_billing"].startswith("failed")         # a retry does not open the gate
    assert res.status["quality_billing"].startswith("failed")
    assert res.status["stage_billing"].startswith("skipped")
    assert res.status["agg_arpu"].startswith("skipped")
    assert res.status["quality_customers"] == "ok" and res.status["stage_customers"] == "ok"


def test_replicated_sources_scale_results(spark):
    from tallyspark.plans.pipeline import build_stages, warehouse
    from tallyspark.sources.fixtures import replicate
    srcs = sources(spark, "/root/testdata/sf0.001")
    dw1 = warehouse(build_stages(srcs))
    dw3 = warehouse(build_stages(replicate(srcs, 3)))
    assert dw3.count() == 3 * dw1.count()
    s1 = dw1.agg(F.sum("total_revenue"), F.sum("total_sessions")).first()
    s3 = dw3.agg(F.sum("total_revenue"), F.sum("total_sessions")).first()
    assert s3[0] == 3 * s1[0] and s3[1] == 3 * s1[1]


def test_command_line_run_from_csv(spark):
    from tallyspark.__main__ import main
    srcs = sources(spark, "/root/testdata/sf0.001")
    paths = {}
    for name, df in srcs.items():
        paths[name] = fresh_dir(spark, f"csv-{name}")
        df.drop("ingested_at").write.option("header", "true").csv(paths[name])
    report = main(["--customers", paths[P.SRC_CUSTOMERS], "--billing", paths[P.SRC_BILLING],
                   "--sessions", paths[P.SRC_SESSIONS], "--out", fresh_dir(spark, "cli-out"),
                   "--mode", "full", "--as-of", "2024-02-01 00:00:00"], spark=spark)
    assert all(v == "ok" for v in report["status"].values()), report["status"]
    assert spark.read.parquet(report["tables"]["dw_user_analytics"]).count() == 149


def test_second_day_reads_and_rewrites_only_what_changed(spark, make):
    """Aggregates of a second day equal those of a full rebuild; months without change keep their files."""
    from .conftest import customers_rows, sessions_rows
    bill = [(f"t{k}", str(k % 5), f"{k}.10", f"2024-0{1 + k % 4}-{10 + k % 9} 10:00:00") for k in range(40)]
    new = [("n1", "1", "5.00", "2024-05-17 09:00:00"), ("n2", "9", "7.00", "2024-05-17 23:59:59"), ("n3", "1", "9.00", "2024-05-18 00:00:00")]
    sess = [(f"s{k}", str(k % 5), f"2024-0{1 + k % 4}-10 10:00:00", f"2024-0{1 + k % 4}-10 10:0{k % 7}:30", "1.50") for k in range(30)]
    moved = [("s0", "0", "2024-05-17 01:00:00", "2024-05-17 01:09:00", "2.00")]
    cust = make(S.SRC_CUSTOMERS, customers_rows(*((str(k), "a b", "x@y", None, f"202{k % 3}-01-01 00:00:00") for k in range(6))))
    day = lambda b, s: {"src_customers": cust, "src_billing_transactions": make(S.SRC_BILLING, billing_rows(*b)),
                        "src_network_sessions": make(S.SRC_SESSIONS, sessions_rows(*s))}
    out, as_of = fresh_dir(spark, "two-days"), dt.datetime(2024, 5, 18, 3)
    first = run_pipeline(spark, day(bill, sess), out, billing_mode="full", as_of=as_of, stamp_changed_only=True)
    before = {t: first.stored[t].files() for t in ("stg_billing", "stg_sessions", "dw_user_analytics")}
    later = dt.datetime(2024, 5, 19, 3)
    second = run_pipeline(spark, day(bill + new, sess[1:] + moved), out, dt.date(2024, 5, 17), dt.date(2024, 5, 18), as_of=later, stamp_changed_only=True)
    assert all(v == "ok" for v in second.status.values()), second.status
    assert second.refreshed["_billing_daily"] == ["2024-05"] and second.refreshed["_session_daily"] == ["2024-01", "2024-05"]
    assert second.refreshed["stg_sessions"] == ["2024-01", "2024-05"]
    for t, changed in (("stg_billing", {"2024-05"}), ("stg_sessions", {"2024-01", "2024-05"})):
        after = second.stored[t].files()
        assert {p for p in after if after[p] != before[t].get(p)} == changed
    fresh = run_pipeline(spark, day(bill + new[:2], sess[1:] + moved), fresh_dir(spark, "one-day"), billing_mode="full", as_of=later)
    for t in ("agg_user_revenue", "agg_monthly_revenue", "agg_arpu", "agg_user_usage", "agg_session_distribution"):
        a, b = second.read(spark, t), fresh.read(spark, t)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t
    # customers 0 and 1 changed; the others keep their stamp, and their partitions their files
    stamps = {r["customer_id"]: r["last_updated"] for r in second.read(spark, "dw_user_analytics").collect()}
    assert {c for c, t in stamps.items() if t == later} == {"0", "1"}
    after = second.stored["dw_user_analytics"].files()
    assert {p for p in after if after[p] != before["dw_user_analytics"][p]} == {"2020-01", "2021-01"}


def test_reconciliation_repairs_recent_days_only(spark, make):
    from tallyspark.operators import daily_state as DS
    from tallyspark.operators.staging import stage_billing
    from tallyspark.sources.partitioned import PartitionedTable
    rows = [("a", "1", "1.00", "2024-03-01 10:00:00"), ("b", "1", "2.00", "2024-04-01 10:00:00"), ("c", "2", "4.00", None)]
    table = PartitionedTable(spark, fresh_dir(spark, "facts"), S.STG_BILLING, "transaction_id", "transaction_date", "day")
    table.upsert(stage_billing(make(S.SRC_BILLING, billing_rows(*rows))))
    root = fresh_dir(spark, "state")
    state = DS.DailyState(spark, root, table, DS.BILLING_STATE, DS.billing_days)
    assert state.refresh() == ["2024-03-01", "2024-04-01", "none"] and state.refresh() == []
    wrong = state.read().withColumn("revenue", (F.col("revenue") * 10).cast("decimal(22,2)"))
    drifted = [tuple(r) for r in wrong.select("*", table.part_of(F.col("day")).alias("part")).collect()]
    spark.createDataFrame(drifted, "customer_id string, day date, revenue decimal(22,2), n bigint, latest timestamp, part string").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(root)
    assert state.refresh(3, dt.date(2024, 4, 2)) == ["2024-04-01"]
    got = {(r["customer_id"], str(r["day"])): float(r["revenue"]) for r in state.read().collect()}
    assert got == {("1", "2024-03-01"): 10.0, ("1", "2024-04-01"): 2.0, ("2", "None"): 40.0}
    files = [r[0] for r in table.read(["2024-04-01"]).select(F.input_file_name()).collect()]
    assert files and all("part=2024-04-01" in f for f in files)
