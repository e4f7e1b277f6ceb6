from datetime import date

from pyspark.sql import functions as F

from tests.conftest import AS_OF
from tests.data import changed, text_frame, tuples
from wardlake.functions.scalars import normalize_hospital_id
from wardlake.operators import cleanse


def clean(spark, rows=None):
    return cleanse.clean_hospital(text_frame(spark, "Hospital", rows), AS_OF)


def test_hospital_rules_compare_amounts_as_numbers(spark):
    assert tuples(clean(spark), "event_id") == {("T1",), ("T2",), ("T3",), ("T8",), ("T9",)}


def test_types_after_cleansing(spark):
    types = dict(clean(spark).dtypes)
    assert types["patient_dob"] == "date"
    assert types["admission_time"] == types["discharge_time"] == "timestamp_ntz"
    assert types["billed_amount"] == types["approved_amount"] == "bigint"


def test_rejected_rows_name_their_rule(spark):
    rejected = cleanse.rejected_rows(text_frame(spark, "Hospital"), cleanse.hospital_rules(AS_OF))
    assert tuples(rejected.select("event_id", F.array_join("failed_rules", ","))) == {
        ("T4", "gender"), ("T5", "dob"), ("T6", "stay"), ("T7", "billing"),
    }


def test_one_row_can_break_every_rule(spark):
    rows = changed(
        "Hospital", 0, patient_gender=None, patient_dob="2030-01-01", billed_amount="1",
        approved_amount="2", discharge_time="2025-11-01 00:00:00",
    )
    rejected = cleanse.rejected_rows(
        text_frame(spark, "Hospital", rows), cleanse.hospital_rules(AS_OF)
    )
    found = {r.event_id: r.failed_rules for r in rejected.collect()}
    assert found["T1"] == ["gender", "dob", "stay", "billing"]


def test_unreadable_text_is_rejected_not_taken_as_missing(spark):
    for column, value, rule in [
        ("discharge_time", "tomorrow", "stay"),
        ("patient_dob", "31/12/1980", "dob"),
        ("billed_amount", "many", "billing"),
    ]:
        rows = changed("Hospital", 0, **{column: value})
        source = text_frame(spark, "Hospital", rows)
        rejected = cleanse.rejected_rows(source, cleanse.hospital_rules(AS_OF))
        found = {r.event_id: r.failed_rules for r in rejected.collect()}
        assert found["T1"] == [rule]
        assert clean(spark, rows).filter("event_id = 'T1'").count() == 0


def test_unreadable_admission(spark):
    rows = changed("Hospital", 1, admission_time="?")
    rejected = cleanse.rejected_rows(
        text_frame(spark, "Hospital", rows), cleanse.hospital_rules(AS_OF)
    )
    assert {r.event_id: r.failed_rules for r in rejected.collect()}["T2"] == ["admission_format"]


def test_clean_and_rejected_partition_the_input(spark):
    source = text_frame(spark, "Pharma")
    kept = cleanse.clean_pharma(source, AS_OF)
    dropped = cleanse.rejected_rows(source, cleanse.pharma_rules(AS_OF))
    key = ("medicine_id", "hospital_id")
    assert kept.count() + dropped.count() == source.count()
    assert not tuples(kept, *key) & tuples(dropped, *key)


def test_pharma_rules(spark):
    source = text_frame(spark, "Pharma")
    kept = cleanse.clean_pharma(source, AS_OF)
    assert tuples(kept, "medicine_id", "hospital_id", "available_stock") == {
        ("MED001", "H01", 199), ("MED001", "H02", 200), ("MED002", "H01", 499),
        ("MED002", "H02", 500), ("MED004", "H01", 600),
    }
    rejected = cleanse.rejected_rows(source, cleanse.pharma_rules(AS_OF))
    assert tuples(rejected.select("hospital_id", F.array_join("failed_rules", ","))) == {
        ("H01", "expiry"), ("H02", "issued_within_total"), ("H03", "total_stock,issued_within_total"),
    }


def test_expiry_status_depends_on_as_of_only(spark):
    source = text_frame(spark, "Pharma")
    assert cleanse.enrich_pharma(source, AS_OF).filter("expiry_status = 'EXPIRED'").count() == 1
    later = cleanse.enrich_pharma(source, date(2027, 1, 1))
    assert later.filter("expiry_status = 'EXPIRED'").count() == 7


def test_provenance_at_any_depth(spark):
    paths = [
        ("/a/Hospital_events_January_2026.csv",),
        ("s3a://bucket/x_y/deep/er/Device_events_May_2025.csv",),
        ("/a/something_else.csv",),
    ]
    found = cleanse.add_provenance(spark.createDataFrame(paths, "file_path string"))
    assert tuples(found, "file_name_last", "Month", "Year") == {
        ("Hospital_events_January_2026.csv", "January", "2026"),
        ("Device_events_May_2025.csv", "May", "2025"),
        (None, None, None),
    }


def test_normalize_hospital_id(spark):
    ids = spark.createDataFrame([("H01",), ("H1",), ("H10",), ("H010",), ("H0",)], "i string")
    found = [r[0] for r in ids.select(normalize_hospital_id(F.col("i"))).collect()]
    assert found == ["H1", "H1", "H10", "H10", "H0"]


def test_rejected_rows_are_found_without_making_their_reasons(spark):
    rows = spark.createDataFrame([(1, None), (2, 5), (9, 9), (None, 1)], "a int, b int")
    rules = {"small": F.col("a") < 5, "there": F.col("b").isNotNull(), "even": F.col("a") % 2 == 0}
    rejected = cleanse.rejected_rows(rows, rules)
    assert {(r.a, r.b, tuple(r.failed_rules)) for r in rejected.collect()} == {
        (1, None, ("there", "even")), (9, 9, ("small", "even")), (None, 1, ("small", "even"))
    }
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    found = next(line for line in plan.splitlines() if "Filter" in line)
    assert "lambda" not in plan and "size(" not in found
