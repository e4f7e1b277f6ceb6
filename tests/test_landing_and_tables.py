from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF
from tests.data import CONTRACTS, changed, text_frame, tuples
from wardlake.contracts import DEVICE, GOLD, HOSPITAL, PHARMA, SILVER
from wardlake.operators import cleanse, star, validate
from wardlake.operators.validate import ValidationError
from wardlake.plans import jobs, kpis
from wardlake.sources import bindings, jdbc, landing, tables


def test_csv_round_trip_keeps_quotes_commas_and_nulls(spark, tmp_path):
    rows = changed("Pharma", 0, medicine_name='Aspa "forte", 5 mg', category=None)
    path = str(tmp_path / "Pharma_events_January_2026.csv")
    landing.write_landing_csv(text_frame(spark, "Pharma", rows).repartition(3), path)
    back = landing.read_landing_csv(spark, path, PHARMA)
    assert back.columns == PHARMA.landing_columns
    assert tuples(back.drop("file_path")) == set(rows)


def test_typed_rows_land_as_plain_text(spark, tmp_path):
    typed = text_frame(spark, "Hospital").withColumn(
        "admission_time", F.col("admission_time").cast("timestamp_ntz")
    )
    path = str(tmp_path / "Hospital_events_January_2026.csv")
    landing.write_landing_csv(typed, path)
    back = landing.read_landing_csv(spark, path, HOSPITAL)
    assert ("2025-12-01 08:00:00",) in tuples(back, "admission_time")


def _write_csv(folder, name, header, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_wrong_header_fails_before_any_row_is_read(spark, tmp_path):
    header = ",".join(DEVICE.columns)
    for i, bad in enumerate([
        header.replace("hospital_id,device_id", "device_id,hospital_id"),
        header.removesuffix(",week"),
        header + ",extra",
    ]):
        folder = tmp_path / str(i)
        _write_csv(folder, "a.csv", bad, "H1,DEV001,Monitor,1,1,2026-M01")
        with pytest.raises(ValidationError):
            landing.read_landing_csv(spark, str(folder), DEVICE)


def test_a_wrong_header_in_any_later_file_fails_the_scan(spark, tmp_path):
    header = ",".join(DEVICE.columns)
    folder = tmp_path / "many"
    _write_csv(folder, "a.csv", header, "H1,DEV001,Monitor,1,1,2026-M01")
    swapped = header.replace("hospital_id,device_id", "device_id,hospital_id")
    _write_csv(folder, "b.csv", swapped, "DEV002,H1,Monitor,1,1,2026-M01")
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_landing_csv(spark, str(folder), DEVICE).collect()


def test_a_wrong_header_fails_whatever_is_read(spark, tmp_path):
    header = ",".join(PHARMA.columns)
    line = "MED001,Aspa,Painkiller,H01,1,1,2026-01-01"
    for i, bad in enumerate([
        header.replace("medicine_id,medicine_name", "medicine_name,medicine_id"),
        header.replace("expiry_date", "expires"), header + ",extra",
    ]):
        folder = tmp_path / f"p{i}"
        _write_csv(folder, "a.csv", header, *[line] * 9)
        _write_csv(folder, "b.csv", bad, line)
        with pytest.raises(Exception, match="(?i)header"):
            landing.read_landing_csv(spark, str(folder), PHARMA).agg(F.count("*")).collect()
        report = landing.header_report(spark, str(folder), PHARMA)
        assert tuples(report, "header", "passed") == {(header, True), (bad, False)}


def test_blanks_survive_and_line_breaks_are_refused(spark, tmp_path):
    rows = changed("Pharma", 0, medicine_name="  Aspa ", total_stock=" 7 ")
    path = str(tmp_path / "Pharma_events_January_2026.csv")
    landing.write_landing_csv(text_frame(spark, "Pharma", rows), path)
    assert tuples(landing.read_landing_csv(spark, path, PHARMA).drop("file_path")) == set(rows)
    broken = text_frame(spark, "Pharma", changed("Pharma", 0, medicine_name="As\npa"))
    with pytest.raises(Exception, match="line break"):
        landing.write_landing_csv(broken, str(tmp_path / "broken.csv"))


def test_any_type_that_can_hold_a_line_break_is_searched(spark, tmp_path):
    for i, (value, kind) in enumerate([("a\rb", "string"), (bytearray(b"a\nb"), "binary"), (["a\nb"], "array<string>")]):
        with pytest.raises(Exception, match="line break"):
            landing.write_landing_csv(spark.createDataFrame([(value,)], f"x {kind}"), str(tmp_path / str(i)))


def test_bronze_takes_the_period_out_of_the_path_once(spark, ctx, monkeypatch):
    landing.write_landing_csv(text_frame(spark, "Pharma"), ctx.landing_path(PHARMA))
    written, write = [], tables.write_parquet
    monkeypatch.setattr(jobs.tables, "write_parquet", lambda df, path: (written.append(df), write(df, path)))
    assert jobs.raw_to_bronze(spark, ctx, PHARMA) == 8
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and "CollectMetrics" in plan
    assert tuples(tables.read_bronze(spark, ctx.bronze_path(PHARMA)), "Month", "Year") == {("January", "2026")}


def test_short_and_long_records_fail_the_gate(spark, ctx):
    header = ",".join(PHARMA.columns)
    good = "MED001,Aspa,Painkiller,H01,1,1,2026-01-01"
    folder = Path(ctx.landing_path(PHARMA))
    folder.mkdir(parents=True)
    _write_csv(folder, "a.csv", header, good, good.removesuffix(",2026-01-01"), good + ",more", good)
    with pytest.raises(ValidationError, match=r"record_shape\(bad_record\): 2"):
        jobs.raw_to_bronze(spark, ctx, PHARMA)


def test_unreadable_dates_fail_the_gate(spark, ctx):
    rows = changed("Hospital", 0, patient_dob="31/12/1980", admission_time="garbage", discharge_time="junk")
    landing.write_landing_csv(text_frame(spark, "Hospital", rows), ctx.landing_path(HOSPITAL))
    with pytest.raises(ValidationError, match=r"readable_date\(patient_dob\): 1; readable_time\(admission_time\): 1; readable_time\(discharge_time\): 1"):
        jobs.raw_to_bronze(spark, ctx, HOSPITAL)


def test_a_file_with_only_a_header_is_present(spark, ctx):
    landing.write_landing_csv(text_frame(spark, "Pharma"), ctx.landing_path(PHARMA))
    folder = Path(ctx.landing_path(DEVICE))
    folder.mkdir(parents=True)
    _write_csv(folder, "part-0.csv", ",".join(DEVICE.columns))
    found = landing.landing_manifest(spark, ctx.landing_folder, [ctx.landing_file(s) for s in (PHARMA, DEVICE, HOSPITAL)])
    assert tuples(found) == {
        (ctx.landing_file(PHARMA), 8, True), (ctx.landing_file(DEVICE), 0, True), (ctx.landing_file(HOSPITAL), 0, False)
    }


def test_a_large_pair_keeps_its_whole_stock(spark, tmp_path):
    """More than an INT holds, for one part and supplier."""
    part = spark.createDataFrame([(1, "Aspa", "BOX")], "p_partkey long, p_name string, p_type string")
    part.write.parquet(str(tmp_path / "part.parquet"))
    lines = spark.range(60).selectExpr(
        "1L as l_partkey", "2L as l_suppkey", "double(2000000) as l_quantity", "timestamp'2026-05-01' as l_shipdate"
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    row = bindings.pharma_events(spark, str(tmp_path)).head()
    assert (row.total_stock, row.issued_stock) == (2_400_000_000, 240_000_000)
    landed = spark.createDataFrame([tuple(map(str, row))], PHARMA.text_schema)
    kept = star.fact_medicine_inventory(cleanse.clean_pharma(landed, AS_OF)).head()
    assert (kept.total_stock, kept.available_stock) == (2_400_000_000, 2_160_000_000)
    assert validate.quality_report(landed, validate.gate_checks(PHARMA)).filter("NOT passed").count() == 0


def test_an_unlisted_device_type_is_not_left_out(spark):
    cells = spark.createDataFrame(
        [("H1", "Monitor", 50.0), ("H1", "New", 99.0)], "hospital_id string, device_type string, utilization_pct double"
    )
    assert kpis.kpi_utilization_matrix(cells).columns == ["hospital_id", "utilization"]
    assert kpis.kpi_utilization_matrix(cells).first().utilization == {"Monitor": 50.0, "New": 99.0}


def test_the_matrix_needs_no_job_and_takes_missing_types(spark):
    rows = [("H1", None, 12.0625), ("H1", "Monitor", None), ("H2", "Monitor", 0.0005)]
    cells = spark.createDataFrame(rows, "hospital_id string, device_type string, utilization_pct double")
    spark.sparkContext.setJobGroup("matrix", "matrix")
    try:
        matrix = kpis.kpi_utilization_matrix(cells)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("matrix")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.hospital_id: r.utilization for r in matrix.collect()} == {
        "H1": {kpis.NO_TYPE: 12.0625, "Monitor": None}, "H2": {"Monitor": 0.0005}
    }
    assert tuples(kpis.matrix_text(matrix)) == {("H1", f"{kpis.NO_TYPE},Monitor", "12.063,-"), ("H2", "Monitor", "0.001")}


def test_manifest_lists_every_expected_file(spark, ctx):
    for name in ("Hospital", "Device"):
        df = text_frame(spark, name).repartition(3)
        landing.write_landing_csv(df, ctx.landing_path(CONTRACTS[name]))
    folder = Path(ctx.landing_folder)
    _write_csv(folder, "Pharma_events_December_2025.csv",
               ",".join(PHARMA.columns), "MED001,Aspa,Painkiller,H01,1,1,2026-01-01")
    found = landing.landing_manifest(
        spark, str(folder), [ctx.landing_file(c) for c in CONTRACTS.values()]
    )
    assert tuples(found) == {
        ("Hospital_events_January_2026.csv", 9, True),
        ("Device_events_January_2026.csv", 7, True),
        ("Pharma_events_January_2026.csv", 0, False),
    }


def test_jdbc_splits_cover_every_bucket_once():
    for source in (
        jdbc.mysql_hospital("h", "db"), jdbc.azure_sql_device("h", "db"),
        jdbc.postgresql_pharma("h", "db"),
    ):
        predicates = source.predicates(4)
        assert len(set(predicates)) == 4
        assert [p.rsplit(" = ", 1)[1] for p in predicates] == ["0", "1", "2", "3"]
        assert all("4" in p.rsplit(" = ", 1)[0] for p in predicates)


def test_jdbc_ranges_cover_every_row_once(spark):
    source = jdbc.mysql_hospital("h", "db")
    keys = [None, "", "A", "EV1", "EV5", "EV5x", "O'Neil", "Z"]
    rows = spark.createDataFrame([(k,) for k in keys], "event_id string")
    for cuts in ([], ["EV5"], ["EV1", "EV5", "O'Neil"]):
        splits = source.ranges("event_id", cuts)
        assert len(splits) == len(cuts) + 1
        found = [r.event_id for split in splits for r in rows.filter(split).collect()]
        assert sorted(found, key=repr) == sorted(keys, key=repr)
    assert source.ranges("n", [10, 20]) == ["n < 10 OR n IS NULL", "n >= 10 AND n < 20", "n >= 20"]


def test_jdbc_options():
    hospital = jdbc.mysql_hospital("db.example", "hospital")
    assert hospital.url == "jdbc:mysql://db.example:3306/hospital"
    assert hospital.table == "hospital_events"
    device = jdbc.azure_sql_device("db.example", "device")
    assert device.table == "dbo.device_events"
    assert device.properties("u", "p")["encrypt"] == "true"
    pharma = jdbc.postgresql_pharma("db.example", "pharma").properties("u", "p", fetch_size=5)
    assert pharma == {
        "driver": "org.postgresql.Driver", "user": "u", "password": "p", "fetchsize": "5",
        "sslmode": "require",
    }


def test_silver_tables_are_typed_and_replaced(spark, ctx):
    tables.create_silver(spark, ctx)
    tables.create_silver(spark, ctx)
    for table, contract in SILVER.items():
        assert spark.table(ctx.silver_table(table)).dtypes == list(contract.items())
    name, contract = ctx.silver_table("dim_insurance"), SILVER["dim_insurance"]
    for rows in ([("INS1", "A"), ("INS2", "B")], [("INS3", "C")]):
        tables.replace_table(spark.createDataFrame(rows, tables.ddl(contract)), name, contract)
        assert tuples(spark.table(name)) == set(rows)
    tables.create_silver(spark, ctx, recreate=True)
    assert spark.table(name).count() == 0


def test_replace_casts_to_the_contract(spark, ctx):
    tables.create_silver(spark, ctx)
    text = spark.createDataFrame(
        [("A", "INS1", "10", "7", "APPROVED")],
        "admission_id string, insurance_id string, billed_amount string, approved_amount string, "
        "claim_status string",
    )
    name = ctx.silver_table("fact_billing")
    tables.replace_table(text, name, SILVER["fact_billing"])
    assert tuples(spark.table(name)) == {("A", "INS1", 10, 7, "APPROVED")}


def test_external_table_survives_its_own_drop(spark, ctx):
    mart = "gold_patient_status"
    df = spark.createDataFrame([("Discharged", 3, "January")], tables.ddl(GOLD[mart]))
    tables.write_gold(df, mart, ctx)
    tables.create_database(spark, ctx, ctx.gold_database)
    name = f"{ctx.gold_database}.patient_status"
    for _ in range(2):
        found = tables.external_table(spark, name, ctx.gold_path(mart), GOLD[mart])
        assert tuples(found) == {("Discharged", 3, "January")}


def test_single_file_is_an_option(spark, tmp_path):
    df = spark.range(100).repartition(4)
    for single, files in ((False, 4), (True, 1)):
        path = tmp_path / str(single)
        tables.write_parquet(df, str(path), single_file=single)
        assert len(list(path.glob("*.parquet"))) == files


def test_preview_and_counts(spark):
    df = spark.range(10).withColumn("k", -F.col("id"))
    assert [r.id for r in tables.preview(df, 3, "k").collect()] == [9, 8, 7]


def test_counts_come_from_footers(spark, tmp_path):
    df = spark.range(10).withColumn("k", -F.col("id"))
    paths = {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}
    df.repartition(3).write.parquet(paths["a"])
    df.limit(0).write.parquet(paths["b"])
    counts = tables.row_counts(spark, paths, dict.fromkeys(paths, "id long, k long"))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert tuples(counts) == {("a", 10), ("b", 0)}
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<count(*)" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as it was


def bytes_read(spark, work):
    def total():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = total()
    work()
    return total() - before


def test_headers_are_read_without_the_files(spark, tmp_path):
    header, line = ",".join(PHARMA.columns), "MED001,Aspa,Painkiller,H01,1,1,2026-01-01"
    read = {}
    for name, lines in (("small", 200_000), ("large", 2_000_000)):
        folder = tmp_path / name
        _write_csv(folder, "a.csv", header, *[line] * lines)
        _write_csv(folder, "b.csv", header + ",extra", line)
        report = landing.header_report(spark, str(folder), PHARMA)
        found = []
        read[name] = bytes_read(spark, lambda: found.append(tuples(report, "header", "passed")))
        assert found == [{(header, True), (header + ",extra", False)}]
    assert read["large"] < 2 * read["small"] + 1_000_000
    assert read["large"] < (tmp_path / "large" / "a.csv").stat().st_size / 4
    counts = landing.line_counts(spark, str(tmp_path / "small"))
    assert {r.lines for r in counts.collect()} == {200_001, 2}
