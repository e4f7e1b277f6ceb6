"""What a run leaves on disk, and what it needs of it on the way."""

import re
import time

from tests.data import CONTRACTS, text_frame, tuples
from wardlake.contracts import GOLD, PHARMA, SILVER, ddl
from wardlake.operators import audit
from wardlake.plans import jobs, marts
from wardlake.sources import landing, tables


def shuffles_on_disk(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {int(found[1]) for found in (re.match(r"shuffle_(\d+)_", name) for name in names) if found}


def left_by(spark, work):
    """The shuffles on disk after ``work`` that were not there before; their files go in the background."""
    before = shuffles_on_disk(spark)
    work()
    for _ in range(50):
        left = shuffles_on_disk(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def land(spark, ctx):
    jobs.land_extracts(ctx, {n: text_frame(spark, n) for n in CONTRACTS})


def test_landing_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(landing.WRITE_OPTIONS, "maxRecordsPerFile", 1000)
    rows = [(f"MED{i}", None if i % 7 == 0 else 'a "b", c', "Painkiller", "H01", str(i), "", "2026-01-01") for i in range(3500)]
    df = spark.createDataFrame(rows, PHARMA.text_schema).coalesce(1)
    path = tmp_path / "Pharma_events_January_2026.csv"
    landing.write_landing_csv(df, str(path))
    files = list(path.glob("part-*"))
    assert len(files) == 4 and all(f.name.endswith(".csv.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < sum(len(",".join(map(str, r))) for r in rows) / 2
    read = landing.read_landing_csv(spark, str(path), PHARMA, bad_records=True)
    assert tuples(read, *PHARMA.columns, "bad_record") == {(*r[:5], None, r[6], None) for r in rows}
    assert {r.lines for r in landing.line_counts(spark, str(path)).collect()} == {1001, 501}
    assert tuples(landing.header_report(spark, str(path), PHARMA), "passed") == {(True,)}


def test_a_run_leaves_no_shuffle_and_no_staged_rows(spark, ctx, tmp_path):
    def run():
        land(spark, ctx)
        jobs.run_medallion(spark, ctx)

    assert left_by(spark, run) == set()
    assert not list((tmp_path / "silver_stage").glob("*"))


def test_slices_of_a_mart_have_its_rows(spark, ctx, tmp_path, monkeypatch):
    usage = [(f"DEV{i % 9}", None if i % 11 == 0 else f"H{0 if i % 3 else i % 40}", f"W{i}", i, i % 5, i - i % 5) for i in range(600)]
    devices = [(f"DEV{d}", kind, h) for d in range(8) for h in (None, *(f"H{i}" for i in range(40))) for kind in {f"T{d % 3}", "Pump"}]
    frames = {
        "fact_device_usage": spark.createDataFrame(usage, ddl(SILVER["fact_device_usage"])),
        "dim_device": spark.createDataFrame(devices, ddl(SILVER["dim_device"])),
    }
    mart = "gold_device_availability"
    whole = sorted(marts.build_mart(mart, frames.__getitem__, "January").collect())
    parts = [part.collect() for part in marts.slices(mart, frames.__getitem__, "January", jobs.SLICES)]
    assert len(parts) > 1 and all(parts) and sorted(row for part in parts for row in part) == whole

    monkeypatch.setattr(jobs, "SLICE_FROM", 0)
    sliced = []
    monkeypatch.setattr(marts, "slices", lambda *a, f=marts.slices: sliced.append(a[0]) or f(*a))
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    silver = tables.silver_snapshot(spark, ctx)
    expected = sorted(marts.build_mart(mart, silver.__getitem__, ctx.report_month).collect())
    assert sliced == [mart] and sorted(tables.external_gold_tables(spark, ctx)[mart].collect()) == expected
    assert not list((tmp_path / "silver_stage").glob("*"))


def test_reconciliation_holds_no_shuffle_of_the_marts(spark, ctx):
    land(spark, ctx)
    jobs.run_medallion(spark, ctx)
    silver, gold = tables.silver_snapshot(spark, ctx), tables.external_gold_tables(spark, ctx)
    rebuilt = {m: marts.build_mart(m, silver.__getitem__, ctx.report_month) for m in GOLD}
    found = []
    assert left_by(spark, lambda: found.append(audit.content_reconciliation(rebuilt, gold))) == set()
    plan = found[0]._jdf.queryExecution().toString()
    assert "FileScan" not in plan and tuples(found[0], "mart", "matches") == {(m, True) for m in GOLD}
