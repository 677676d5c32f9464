"""The whole daily pipeline as lazily composed DataFrames.

quality (checks + quarantine) -> staging -> aggregates -> warehouse + audit -> queries.
Nothing is materialised unless the caller writes a stage; shared inputs (the staged tables,
the billing customer-month pre-aggregate, the session rollup) are built once and reused, so
Spark plans them once and reuses their exchanges.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import params as P
from ..operators import aggregates as A
from ..operators import staging as ST
from ..operators.warehouse import audit_row, dw_user_analytics, pipeline_audit_log


@dataclass
class Stages:
    stg_customers: DataFrame
    stg_billing: DataFrame
    stg_sessions: DataFrame
    customer_month: DataFrame
    session_rollup: DataFrame
    extra: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def agg_user_revenue(self) -> DataFrame:
        return A.agg_user_revenue(self.customer_month)

    @property
    def agg_monthly_revenue(self) -> DataFrame:
        return A.agg_monthly_revenue(self.customer_month)

    @property
    def agg_arpu(self) -> DataFrame:
        return A.agg_arpu(self.stg_customers, self.customer_month)

    @property
    def agg_user_usage(self) -> DataFrame:
        return A.usage_from_rollup(self.session_rollup)

    @property
    def session_buckets(self) -> DataFrame:
        return A.session_buckets(self.stg_sessions)

    @property
    def agg_session_distribution(self) -> DataFrame:
        return A.distribution_from_rollup(self.session_rollup)


def build_stages(sources: dict[str, DataFrame], stg_billing: DataFrame | None = None,
                 as_of: dt.datetime | None = None) -> Stages:
    stg_customers = ST.stage_customers(sources[P.SRC_CUSTOMERS], as_of)
    billing = stg_billing if stg_billing is not None else ST.stage_billing(sources[P.SRC_BILLING])
    stg_sessions = ST.stage_sessions(sources[P.SRC_SESSIONS])
    return Stages(stg_customers, billing, stg_sessions,
                  A.billing_customer_month(billing), A.session_rollup(stg_sessions))


def warehouse(st: Stages, as_of: dt.datetime | None = None) -> DataFrame:
    """dw_user_analytics from two fused metric frames: billing (revenue + ARPU) and sessions
    (usage + bucket mix); three-way join on customer_id instead of five."""
    billing = A.billing_metrics(st.customer_month)
    sessions = A.session_metrics(st.session_rollup)
    return dw_user_analytics(st.stg_customers, billing, sessions, as_of=as_of)


def audit(st: Stages, as_of: dt.datetime | None = None) -> DataFrame:
    return pipeline_audit_log(st.stg_billing, st.stg_sessions, st.stg_customers, as_of=as_of)


# --- the daily run ----------------------------------------------------------------------------
@dataclass
class RunResult:
    tables: dict[str, str]                       # table name -> folder (versioned: table root)
    status: dict[str, str]                       # step -> "ok" | "failed: ..." | "skipped"
    seconds: dict[str, float] = field(default_factory=dict)   # step -> wall time
    stored: dict[str, object] = field(default_factory=dict)   # table name -> its VersionedTable or PartitionedTable
    refreshed: dict[str, list[str]] = field(default_factory=dict)   # table -> partitions that this run rewrote
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)   # table -> counts taken while it was written

    def read(self, spark, name: str) -> DataFrame:
        if name in self.stored:
            return self.stored[name].read()
        return spark.read.parquet(self.tables[name])


def run_pipeline(spark, sources: dict[str, DataFrame], out: str, t_start: dt.date | None = None,
                 t_end: dt.date | None = None, as_of: dt.datetime | None = None,
                 billing_mode: str = "incremental", max_bad_ratio: float | None = None,
                 land: bool = False, iso_text_dates: bool = False, reconcile_days: int = 0,
                 stamp_changed_only: bool = False, grain: str = "month", gate_min_rows: int | None = None,
                 monitor: bool = False, unknown_customer: bool = False) -> RunResult:
    """quality -> staging -> aggregates -> audit + warehouse, each stage written under ``out``.

    Written stages cut the lineage (a lost executor recomputes from the last written stage, not
    from raw files) and are what the next run upserts into. Steps follow the reference's data
    edges: a failed step marks its dependants skipped while independent branches still run.
    ``billing_mode``: "incremental" loads [t_start, t_end) insert-if-absent, "full" upserts all.
    ``max_bad_ratio``: optional gate; a source whose bad rows (a NULL id or a duplicated one, each row
    once) exceed this share of its rows fails its quality step, so its staging and everything downstream is skipped.
    ``land``: first write the sources as ``src_*`` tables under ``out`` (full refresh) and run
    on those, so sources given as expensive plans (raw CSV, derivations) are computed once.
    ``iso_text_dates``: the sources' date texts are ISO formatted, so the billing window is also
    pushed to the scan as a string range (see ``staging.stage_billing_window``).
    Billing, sessions and the warehouse lie in partitions (``grain``: "month" or "day") of their dates, of which a run rewrites
    those it changes; aggregates come from daily state, which is recomputed for changed partitions and for those of the last
    ``reconcile_days`` days before ``t_end``. ``stamp_changed_only``: warehouse rows whose values stay keep their
    ``last_updated`` (else every row gets the run's time, as in the reference, and every partition is rewritten).
    ``gate_min_rows``: the source must hold as many billing rows for the window, else billing is not loaded. ``monitor``: backfill late
    rows of windows that were loaded before, quarantine billing rows of unknown customers, and write ``check_freshness`` and
    ``check_volume``. ``unknown_customer``: revenue of customers that are not staged yet counts for a placeholder row of the warehouse and goes
    to the customer in the run that stages them (see ``operators.orphans``). Freshness, volume and audit read the state, the load ledger and counts taken while writing, not the facts.
    """
    import time
    import traceback
    from concurrent.futures import ThreadPoolExecutor

    from ..operators import daily_state as DS
    from ..operators import load_ledger as LL
    from ..operators import quality as QL
    from ..operators.orphans import OrphanRevenue
    from ..operators.warehouse import with_unknown_customer
    from ..session import fresh_dir
    from ..sources.readers import CORRUPT
    from ..sources.partitioned import PartitionedTable
    from ..sources.sinks import VersionedTable, append, observed, overwrite, write_counted
    from .. import schemas as S

    out = out.rstrip("/")
    t_start = t_start or ((as_of or dt.datetime.now()).date() - dt.timedelta(days=1))
    t_end = t_end or (t_start + dt.timedelta(days=1))
    tables: dict[str, str] = {}
    status: dict[str, str] = {}
    seconds: dict[str, float] = {}
    refreshed: dict[str, list[str]] = {}
    metrics: dict[str, dict[str, int]] = {}
    ledger = LL.LoadLedger(spark, f"{out}/load_ledger")
    vt = {"stg_customers": VersionedTable(spark, f"{out}/stg_customers", S.STG_CUSTOMERS)}
    vt |= {name: PartitionedTable(spark, f"{out}/{name}", schema, key, date, grain) for name, schema, key, date in [
        ("stg_billing", S.STG_BILLING, "transaction_id", "transaction_date"),
        ("stg_sessions", S.STG_SESSIONS, "session_id", "session_date"),
        ("dw_user_analytics", S.DW_USER_ANALYTICS, "customer_id", "customer_since")]}
    states = {"billing": DS.DailyState(spark, f"{out}/_billing_daily", vt["stg_billing"], DS.BILLING_STATE, DS.billing_days),
              "sessions": DS.DailyState(spark, f"{out}/_session_daily", vt["stg_sessions"], DS.SESSION_STATE, DS.session_days)}
    orphan_revenue = OrphanRevenue(spark, f"{out}/orphan_revenue", states["billing"])

    def step(name: str, deps: tuple[str, ...], fn) -> None:
        blocked = [d for d in deps if status.get(d) != "ok"]
        if blocked:
            status[name] = f"skipped: {', '.join(blocked)} not ok"
            return
        started = time.perf_counter()
        try:
            fn()
            status[name] = "ok"
        except Exception as exc:  # noqa: BLE001 - isolate the branch, report, continue
            status[name] = f"failed: {type(exc).__name__}: {str(exc).splitlines()[0][:300]}"
            traceback.print_exc()
        finally:
            seconds[name] = round(time.perf_counter() - started, 3)

    def together(*steps: tuple) -> None:
        """Steps that don't depend on each other, at the same time: Spark runs their jobs side by side."""
        with ThreadPoolExecutor(len(steps)) as pool:
            list(pool.map(lambda s: step(*s), steps))

    # Stage 0: optional landing of the sources as tables.
    if land:
        landed = {}
        for src_name, df in sources.items():
            path = f"{out}/{src_name}"
            overwrite(df.hint("rebalance"), path)
            tables[src_name] = path
            landed[src_name] = spark.read.parquet(path)
        sources = landed

    # Lines that landing could not read become a quarantine set of their own; only good lines go on.
    malformed = {name: df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT) for name, df in sources.items() if CORRUPT in df.columns}
    sources = {name: df.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if name in malformed else df for name, df in sources.items()}

    # Stage 1: quality. Each source's new bad rows are written aside, side by side; the quarantine step numbers those of
    # all sources that passed and appends them once.
    qpath = f"{out}/quarantine"
    aside: dict[str, str] = {}

    def stored_quarantine() -> DataFrame:
        from ..sources.readers import read_or_empty
        return read_or_empty(spark, qpath, S.QUARANTINE_STORED)

    def quality(src_name: str):
        def run():
            if max_bad_ratio is not None:        # before anything is appended: a retry fails again
                bad, total = QL.bad_rows(sources[src_name], QL.RULES[src_name])
                if total and bad / total > max_bad_ratio:
                    raise ValueError(f"{src_name}: {bad} of {total} rows are bad (> {max_bad_ratio:.2%})")
            path = fresh_dir(spark, f"bad-{src_name}")
            new = QL.quarantine_source(sources[src_name], QL.RULES[src_name], stored_quarantine())
            if src_name in malformed:
                lines = fresh_dir(spark, f"bad-lines-{src_name}")
                metrics[src_name] = {"bad_lines": write_counted(malformed[src_name], lines)}
                new = new.unionByName(QL.quarantine_malformed(spark.read.parquet(lines), src_name, stored_quarantine()))
            new.write.parquet(path)
            aside[src_name] = path
        return run

    def write_quarantine():
        tables["quarantine"] = qpath
        if not aside:
            return
        rows = spark.read.parquet(*(aside[name] for name in QL.RULES if name in aside))
        # partitioned by (source_table, issue_type): the anti join reads only a source's part of the ever-growing quarantine
        append(QL.with_quarantine_ids(rows, stored_quarantine(), as_of), qpath, partition_by=["source_table", "issue_type"])

    together(*((step_name, (), quality(src_name)) for src_name, step_name in [
        (P.SRC_BILLING, "quality_billing"), (P.SRC_SESSIONS, "quality_sessions"), (P.SRC_CUSTOMERS, "quality_customers")]))

    # Stage 2: staging.
    def row_gate():
        got = QL.row_count_gate(sources[P.SRC_BILLING], t_start, t_end, gate_min_rows).first()
        if not got["passed"]:
            raise ValueError(f"{got['rows']} billing rows for {t_start} to {t_end}, of {gate_min_rows} at least")

    if gate_min_rows is not None:
        step("row_gate", (), row_gate)
    before_billing = ("quality_billing",) + (("row_gate",) if gate_min_rows is not None else ())

    def stage_customers():
        seen = Observation("customers")
        vt["stg_customers"].commit(ST.stage_customers(sources[P.SRC_CUSTOMERS], as_of).observe(seen, F.count(F.lit(1)).alias("rows")))
        metrics["stg_customers"] = {"rows": observed(seen, "rows")}
        tables["stg_customers"] = vt["stg_customers"].root

    def stage_billing():
        if billing_mode == "incremental":   # insert-only: write just the window's new rows
            if monitor:
                refreshed["backfill"] = [f"{a}/{b}" for a, b in LL.run_backfill(vt["stg_billing"], ledger, sources[P.SRC_BILLING], as_of, iso_text_dates)]
            metrics["stg_billing"] = LL.load_window(vt["stg_billing"], ledger, sources[P.SRC_BILLING], t_start, t_end, as_of, iso_text_dates)
        else:
            refreshed["stg_billing"] = vt["stg_billing"].upsert(ST.stage_billing(sources[P.SRC_BILLING]))
        tables["stg_billing"] = vt["stg_billing"].root

    def stage_sessions():
        refreshed["stg_sessions"] = vt["stg_sessions"].upsert(ST.stage_sessions(sources[P.SRC_SESSIONS]))
        tables["stg_sessions"] = vt["stg_sessions"].root

    together(("quarantine", (), write_quarantine),
             ("stage_customers", ("quality_customers",), stage_customers),
             ("stage_billing", before_billing, stage_billing),
             ("stage_sessions", ("quality_sessions",), stage_sessions))

    # Stage 3: aggregates. The daily state of changed partitions is recomputed from their facts; the shared pre-aggregates
    # (billing per customer-month, sessions per customer) roll up from the state, and the reference's aggregate tables
    # are small roll-ups / projections of them.
    read = {k: (lambda k=k: vt[k].read()) for k in vt}

    def write_table(name: str, build):
        def run():
            path = f"{out}/{name}"
            overwrite(build(), path)
            tables[name] = path
        return run

    def written(name: str) -> DataFrame:
        return spark.read.parquet(tables[name])

    def from_state(name: str, state: DS.DailyState, roll_up):
        def build() -> DataFrame:
            refreshed[name] = state.refresh(reconcile_days, t_end)
            return roll_up(state.read())
        return build

    together(("billing_customer_month", ("stage_billing",),
              write_table("_billing_customer_month", from_state("_billing_daily", states["billing"], DS.customer_months))),
             ("session_rollup", ("stage_sessions",),
              write_table("_session_rollup", from_state("_session_daily", states["sessions"], DS.session_totals))),
             ("session_buckets", ("stage_sessions",),
              write_table("session_buckets", lambda: A.session_buckets(read["stg_sessions"]()))))
    def follow_orphans():
        known = read["stg_customers"]()
        refreshed["orphans_released"] = orphan_revenue.release(known, as_of)
        refreshed["orphan_revenue"] = orphan_revenue.book(known, as_of)
        tables["orphan_revenue"] = orphan_revenue.root

    if unknown_customer:
        step("orphan_revenue", ("billing_customer_month", "stage_customers"), follow_orphans)
    together(("agg_user_revenue", ("billing_customer_month",),
              write_table("agg_user_revenue", lambda: A.agg_user_revenue(written("_billing_customer_month")))),
             ("agg_monthly_revenue", ("billing_customer_month",),
              write_table("agg_monthly_revenue", lambda: A.agg_monthly_revenue(written("_billing_customer_month")))),
             ("agg_arpu", ("billing_customer_month", "stage_customers"),
              write_table("agg_arpu", lambda: A.agg_arpu(read["stg_customers"](), written("_billing_customer_month")))),
             ("agg_user_usage", ("session_rollup",),
              write_table("agg_user_usage", lambda: A.usage_from_rollup(written("_session_rollup")))),
             ("agg_session_distribution", ("session_rollup",),
              write_table("agg_session_distribution", lambda: A.distribution_from_rollup(written("_session_rollup")))))

    # Stage 4: audit row and warehouse upsert, after every aggregate.
    all_aggs = ("agg_user_revenue", "agg_monthly_revenue", "agg_arpu", "agg_user_usage",
                "agg_session_distribution")

    def write_audit():
        path = f"{out}/pipeline_audit_log"
        counts = [states[k].read().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for k in ("billing", "sessions")]
        append(audit_row(spark, *counts, metrics["stg_customers"]["rows"], as_of=as_of), path)
        tables["pipeline_audit_log"] = path

    def load_warehouse():
        aggs = [spark.read.parquet(tables[n]) for n in
                ("agg_user_revenue", "agg_user_usage", "agg_arpu", "agg_session_distribution")]
        customers = read["stg_customers"]()
        if unknown_customer:
            revenue, usage, arpu, mix = aggs
            placeholder = A.billing_metrics(orphan_revenue.placeholder_months())
            aggs = [revenue.unionByName(placeholder.select("customer_id", "total_revenue", "total_transactions")), usage,
                    arpu.select("customer_id", "arpu").unionByName(placeholder.select("customer_id", "arpu")), mix]
            customers = with_unknown_customer(customers, as_of)
        dw = dw_user_analytics(customers, *aggs, as_of=as_of)
        refreshed["dw_user_analytics"] = vt["dw_user_analytics"].upsert(dw, "last_updated" if stamp_changed_only else None)
        tables["dw_user_analytics"] = vt["dw_user_analytics"].root

    together(("audit_pipeline_run", all_aggs, write_audit),
             ("load_dw_user_analytics", all_aggs + (("orphan_revenue",) if unknown_customer else ()), load_warehouse))
    if monitor:
        def orphans():
            known = read["stg_customers"]()
            new = QL.quarantine_billing_orphans(sources[P.SRC_BILLING], known, stored_quarantine())
            append(QL.with_quarantine_ids(new, stored_quarantine(), as_of), qpath, partition_by=["source_table", "issue_type"])

        now = as_of or dt.datetime.now()
        together(("quarantine_orphans", ("quarantine", "stage_customers"), orphans),
                 ("check_freshness", ("billing_customer_month",), write_table(
                     "check_freshness", lambda: QL.freshness_check(states["billing"].read(), [now], date_col="latest"))),
                 ("check_volume", ("stage_billing",), write_table("check_volume", lambda: LL.load_volume(ledger))))
    return RunResult(tables, status, seconds, vt, refreshed, metrics)
