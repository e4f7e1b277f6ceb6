from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.data import CONTRACTS, changed, text_frame, tuples
from wardlake.contracts import GOLD, HOSPITAL, SILVER
from wardlake.operators import audit
from wardlake.operators.validate import ValidationError
from wardlake.plans import jobs, kpis, marts, views
from wardlake.sources import tables


def land(spark, ctx, **rows):
    jobs.land_extracts(ctx, {n: text_frame(spark, n, rows.get(n)) for n in CONTRACTS})


def all_rows(spark, ctx):
    silver = {t: tuples(tables.read_silver(spark, ctx, t)) for t in SILVER}
    gold = {m: tuples(df) for m, df in tables.external_gold_tables(spark, ctx).items()}
    return silver, gold


def test_full_run_twice_gives_the_same_tables(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    first = all_rows(spark, ctx)
    assert first[0]["dim_insurance"] == {("INS1", "Alpha"), ("INS2", "Beta")}
    assert len(first[1]["gold_finance_weekly"]) == 2
    jobs.run_medallion(spark, replace(ctx, run_id="run2"))
    assert all_rows(spark, ctx) == first

    log = spark.table(ctx.audit_table)
    assert log.count() == 32
    assert tuples(log.filter("run_id = 'run2'"), "layer", "source", "record_count", "status") == {
        ("Init", "ALL", 0, "RUNNING"),
        ("raw", "Hospital", 9, "Success"), ("raw", "Device", 7, "Success"),
        ("raw", "Pharma", 8, "Success"),
        ("silver", "Hospital", 5, "Success"), ("silver", "Device", 7, "Success"),
        ("silver", "Pharma", 5, "Success"), ("reject", "Hospital", 4, "Success"),
        ("reject", "Pharma", 3, "Success"),
        ("gold", "gold_medicine_availability", 5, "Success"),
        ("gold", "gold_device_availability", 6, "Success"),
        ("gold", "gold_finance_weekly", 2, "Success"),
        ("gold", "gold_weekly_admissions", 3, "Success"),
        ("gold", "gold_claim_status_summary", 4, "Success"),
        ("gold", "gold_rejected_claims", 1, "Success"),
        ("gold", "gold_patient_status", 2, "Success"),
    }
    assert tuples(audit.audit_run_health(log)) == {
        (1, "run1", "COMPLETE", "gold", 15, True), (2, "run2", "COMPLETE", "gold", 15, True)
    }
    newest = [(r.run_id, r.layer, r.source) for r in audit.audit_recent(log).collect()]
    assert newest[0] == ("run2", "gold", "gold_claim_status_summary") and newest[-1] == ("run1", "Init", "ALL")
    assert [layer for run, layer, _ in newest if run == "run1"] == ["gold"] * 7 + ["reject"] * 2 + ["silver"] * 3 + ["raw"] * 3 + ["Init"]
    assert audit.audit_by(log, layer="raw", run_id="run1").count() == 3
    assert tuples(audit.raw_balance(log).filter("run_id = 'run2'")) == {
        ("run2", "Hospital", 9, 5, 4, True), ("run2", "Pharma", 8, 5, 3, True)
    }
    kept = spark.read.parquet(ctx.reject_path("Hospital"))
    assert {r.event_id: r.failed_rules for r in kept.collect()} == {
        "T4": ["gender"], "T5": ["dob"], "T6": ["stay"], "T7": ["billing"]
    }


def test_views_are_queryable_by_name(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    jobs.register_views(spark, ctx)
    for view in views.VIEWS:
        assert spark.sql(f"SELECT * FROM {view}").count() > 0
    ranked = spark.sql("SELECT insurance_name, rejection_rank FROM vw_rejected_claims_ranking")
    assert tuples(ranked) == {("Beta", 1)}


def test_reconciliation_matches_and_notices_a_loss(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    silver = lambda table: tables.read_silver(spark, ctx, table)
    gold = tables.external_gold_tables(spark, ctx)
    assert audit.layer_reconciliation(silver, gold).filter("NOT matches").count() == 0
    gold["gold_patient_status"] = gold["gold_patient_status"].filter("patient_count > 2")
    wrong = audit.layer_reconciliation(silver, gold).filter("NOT matches")
    assert tuples(wrong) == {("gold_patient_status", 5, 3, False)}


def test_a_failing_gate_is_audited_and_keeps_the_last_good_bronze(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    before = all_rows(spark, ctx)
    bad = replace(ctx, run_id="bad")
    land(spark, bad, Hospital=changed("Hospital", 0, billed_amount="bad"))
    with pytest.raises(ValidationError, match=r"Hospital: castable_int\(billed_amount\): 1"):
        jobs.run_medallion(spark, bad)
    failed = spark.table(ctx.audit_table).filter("run_id = 'bad' AND layer = 'Any'")
    assert tuples(failed, "notebook_name", "source", "record_count", "status") == {
        ("Pipeline_Fail", "ALL", 0, "FAILED: Hospital: castable_int(billed_amount): 1")
    }
    assert all_rows(spark, ctx) == before
    assert tables.read_bronze(spark, ctx.bronze_path(HOSPITAL)).count() == 9
    log = spark.table(ctx.audit_table)
    assert tuples(audit.audit_run_health(log).filter("run_id = 'bad'")) == {(2, "bad", "FAILED", "Any", 0, False)}


@pytest.mark.parametrize("broken, buckets", [("dim_device", None), ("fact_billing", 2), ("hospital_dimensions", None)])
def test_a_run_that_fails_in_one_table_leaves_all_at_the_last_version(spark, ctx, monkeypatch, buckets, broken):
    ctx = replace(ctx, fact_buckets=buckets)
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    before, by_name = all_rows(spark, ctx), {t: tuples(spark.table(ctx.silver_table(t))) for t in SILVER}
    second = replace(ctx, run_id="run2", as_of=ctx.as_of.replace(year=2025))
    write = (tables, "write_dimensions") if broken == "hospital_dimensions" else (tables, "write_version")
    original = getattr(*write)

    def failing(df, run, version, *table):
        if broken == "hospital_dimensions" or table == (broken,):
            raise OSError("disk is gone")
        original(df, run, version, *table)

    with monkeypatch.context() as patch:
        patch.setattr(*write, failing)
        with pytest.raises(OSError):
            jobs.run_medallion(spark, second)
    assert all_rows(spark, ctx) == before
    assert {t: tuples(spark.table(ctx.silver_table(t))) for t in SILVER} == by_name
    assert len(list(Path(ctx.silver_folder("")).iterdir())) == 1  # nothing is left of the failed version
    # The same run succeeds later, and all tables move together.
    jobs.run_medallion(spark, second)
    assert not any(by_name[t] == tuples(spark.table(ctx.silver_table(t))) for t in ("dim_patient", "fact_admission", "fact_billing"))


def published(spark, ctx):
    return tables.database_properties(spark, ctx.database)[tables.PUBLISHED]


def test_a_switch_that_fails_shows_the_last_version_again(spark, ctx, monkeypatch):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    before, version = all_rows(spark, ctx), published(spark, ctx)
    snapshot = tables.silver_snapshot(spark, ctx)
    calls, refresh = [], type(spark.catalog).refreshTable

    def seventh_fails(self, name):
        calls.append(name)
        if len(calls) == 7:
            raise OSError("catalog is gone")
        refresh(self, name)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark.catalog), "refreshTable", seventh_fails)
        with pytest.raises(OSError):
            jobs.run_silver(spark, replace(ctx, as_of=ctx.as_of.replace(year=2025)))
    assert (all_rows(spark, ctx), published(spark, ctx)) == (before, version)
    # A reader that began before two more versions still has its own after the first of them.
    jobs.run_silver(spark, replace(ctx, as_of=ctx.as_of.replace(year=2025)))
    assert {t: tuples(df) for t, df in snapshot.items()} == before[0]
    assert published(spark, ctx) != version
    jobs.run_silver(spark, ctx)
    assert len(list(Path(ctx.silver_folder("")).iterdir())) == 2


def test_a_driver_lost_in_the_switch_is_recovered(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    after = all_rows(spark, ctx)[0]
    old = replace(ctx, as_of=ctx.as_of.replace(year=2025))
    jobs.run_silver(spark, old)
    props = tables.database_properties(spark, ctx.database)
    # As left by a driver that had moved one table of the version before when it was lost.
    tables._set_properties(spark, ctx.database, moving=props[tables.PREVIOUS])
    path = tables.version_path(ctx, props[tables.PREVIOUS], "fact_billing")
    spark.sql(f"ALTER TABLE {ctx.silver_table('fact_billing')} SET LOCATION '{path}'")
    tables.recover_silver(spark, ctx)
    assert all_rows(spark, ctx)[0] == after
    assert tables.database_properties(spark, ctx.database)[tables.MOVING] == ""


def test_layers_run_alone_are_in_the_audit_in_order(spark, ctx):
    land(spark, ctx)
    jobs.run_raw(spark, ctx)
    jobs.run_silver(spark, ctx)
    health = audit.audit_run_health(spark.table(ctx.audit_table))
    assert {r.state for r in health.collect()} == {"INCOMPLETE"} and not health.filter("healthy").count()
    first = audit.audit_recent(spark.table(ctx.audit_table)).first()
    assert (first.layer, first.source) == ("reject", "Hospital")


def test_content_notices_what_totals_do_not(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    silver = tables.silver_snapshot(spark, ctx)
    rebuilt = {m: marts.build_mart(m, silver.__getitem__, ctx.report_month) for m in GOLD}
    gold = dict(tables.external_gold_tables(spark, ctx))
    assert audit.content_reconciliation(rebuilt, gold).filter("NOT matches").isEmpty()
    mart, amount = "gold_finance_weekly", F.col("total_billed_amount")
    low, high = gold[mart].agg(F.min(amount), F.max(amount)).first()
    gold[mart] = gold[mart].withColumn("total_billed_amount", F.when(amount == low, high).otherwise(low))
    assert audit.layer_reconciliation(silver.__getitem__, gold).filter("NOT matches").isEmpty()
    assert tuples(audit.content_reconciliation(rebuilt, gold).filter("NOT matches")) == {(mart, "total_billed_amount", False)}
    # A mart stored twice cancels out in the xor, and one that is gone has no checksum.
    twice = {**gold, mart: rebuilt[mart], "gold_patient_status": gold["gold_patient_status"].union(gold["gold_patient_status"])}
    gone = {**gold, mart: rebuilt[mart], "gold_patient_status": gold["gold_patient_status"].limit(0)}
    for wrong in (twice, gone):
        found = audit.content_reconciliation(rebuilt, wrong).filter("NOT matches")
        assert tuples(found) == {("gold_patient_status", "patient_count", False)}


def test_empty_extract(spark, ctx):
    land(spark, ctx, Hospital=[])
    jobs.run_medallion(spark, ctx)
    counts = tuples(spark.table(ctx.audit_table).filter("layer = 'raw'"), "source", "record_count")
    assert counts == {("Hospital", 0), ("Device", 7), ("Pharma", 8)}
    assert tables.external_gold_tables(spark, ctx)["gold_finance_weekly"].count() == 0


def test_history_keeps_other_months(spark, ctx):
    january = replace(ctx, history=True)
    february = replace(january, input_date="20260301", run_id="run2")
    for run in (january, february, january):
        land(spark, run)
        jobs.run_medallion(spark, run)
    gold = tables.external_gold_tables(spark, january)
    found = gold["gold_patient_status"].select(
        "report_year", "report_month", "patient_status", "patient_count"
    )
    assert sorted(tuple(r) for r in found.collect()) == [
        (2026, "February", "Currently Admitted", 2), (2026, "February", "Discharged", 3),
        (2026, "January", "Currently Admitted", 2), (2026, "January", "Discharged", 3),
    ]
    assert set(gold) == set(GOLD)
    silver = lambda table: tables.read_silver(spark, january, table)
    assert audit.layer_reconciliation(silver, gold, january).filter("NOT matches").count() == 0


def test_views_and_measures_keep_months_apart(spark, ctx):
    one, two = replace(ctx, history=True), replace(ctx, history=True, input_date="20260301", run_id="run2")
    for run in (one, two):
        land(spark, run)
        jobs.run_medallion(spark, run)
    both = tables.external_gold_tables(spark, one)
    month = {mart: df.filter("report_month = 'January'").drop("report_year") for mart, df in both.items()}
    for view, mart in views.VIEWS.values():
        whole, single = view(both[mart]), view(month[mart])
        for name in ("January", "February"):
            part = whole.filter(F.col("report_month") == name).drop("report_year", "report_month")
            assert tuples(part, *sorted(part.columns)) == tuples(single.drop("report_month"), *sorted(part.columns))
    for measure, mart in (
        (kpis.kpi_finance_totals, "gold_finance_weekly"), (kpis.kpi_leakage_by_insurer, "gold_finance_weekly"),
        (kpis.kpi_claim_distribution, "gold_claim_status_summary"),
        (kpis.kpi_units_by_device_type, "gold_device_availability"),
        (kpis.kpi_utilization_bands, "gold_device_availability"),
        (lambda mart: kpis.matrix_text(kpis.kpi_utilization_matrix(mart)), "gold_device_availability"),
    ):
        single = measure(month[mart])
        whole = measure(both[mart])
        assert set(whole.columns) == {*single.columns, "report_year", "report_month"}
        for name in ("January", "February"):
            part = whole.filter(F.col("report_month") == name)
            assert tuples(part, *single.columns) == tuples(single, *single.columns)


def test_a_repeated_id_is_not_bucketed(spark, ctx):
    rows = changed("Hospital", 1, event_id="T1")
    bucketed = replace(ctx, fact_buckets=2)
    land(spark, bucketed, Hospital=rows)
    with pytest.raises(ValidationError, match="admission_id is not unique"):
        jobs.run_medallion(spark, bucketed)


def test_drop_run_leaves_nothing(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    jobs.drop_run(spark, ctx)
    assert not Path(ctx.base_path).exists()
    names = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert not names & {ctx.database, ctx.gold_database, ctx.audit_database}


def test_bucketed_facts_join_without_a_shuffle_of_the_facts(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    plain = all_rows(spark, ctx)
    bucketed = replace(
        ctx, fact_buckets=4, database=f"{ctx.database}_b", gold_database=f"{ctx.gold_database}_b",
        base_path=f"{ctx.base_path}/bucketed", audit_database=f"{ctx.audit_database}_b",
    )
    land(spark, bucketed)
    jobs.run_medallion(spark, bucketed)
    assert all_rows(spark, bucketed) == plain

    def shuffles(run):
        silver = lambda table: tables.read_silver(spark, run, table)
        mart = marts.build_mart("gold_finance_weekly", silver, "January")
        return mart._jdf.queryExecution().executedPlan().toString().count(
            "Exchange hashpartitioning(admission_id"
        )

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert (shuffles(ctx), shuffles(bucketed)) == (4, 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
