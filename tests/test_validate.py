import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF
from tests.data import CONTRACTS, HOSPITAL_ROWS, changed, text_frame, tuples
from wardlake.contracts import DEVICE, HOSPITAL, PHARMA
from wardlake.operators import validate as v


def failing(df, checks):
    report = v.quality_report(df, checks)
    return tuples(report.filter("NOT passed"), "check", "column", "violations")


def test_clean_text_passes_every_gate(spark):
    for name, contract in CONTRACTS.items():
        assert failing(text_frame(spark, name), v.gate_checks(contract)) == set()


@pytest.mark.parametrize(
    "source, values, expected",
    [
        ("Hospital", {"insurance_id": None}, ("not_null", "insurance_id", 1)),
        ("Hospital", {"patient_gender": "Male"}, ("max_length", "patient_gender", 1)),
        ("Hospital", {"billed_amount": "bad"}, ("castable_int", "billed_amount", 1)),
        ("Hospital", {"approved_amount": "12.5"}, ("castable_int", "approved_amount", 1)),
        ("Hospital", {"approved_amount": ""}, ("castable_int", "approved_amount", 1)),
        ("Hospital", {"approved_amount": "3000000000"}, ("castable_int", "approved_amount", 1)),
        ("Device", {"device_id": "DEV0001"}, ("max_length", "device_id", 1)),
        ("Device", {"hospital_id": None}, ("not_null", "hospital_id", 1)),
        ("Pharma", {"total_stock": "1e3"}, ("castable_int", "total_stock", 1)),
    ],
)
def test_one_violation_each(spark, source, values, expected):
    df = text_frame(spark, source, changed(source, 0, **values))
    assert failing(df, v.gate_checks(CONTRACTS[source])) == {expected}


def test_padded_and_missing_numbers_are_castable(spark):
    df = text_frame(spark, "Pharma", changed("Pharma", 0, total_stock=" 7 ", issued_stock=None))
    assert failing(df, v.gate_checks(PHARMA)) == set()


def test_empty_input_counts_zero_not_null(spark):
    empty = text_frame(spark, "Hospital", [])
    assert v.null_counts(empty, HOSPITAL.not_null).first() == (0, 0, 0, 0)
    assert failing(empty, v.hospital_checks(HOSPITAL, AS_OF)) == set()


def test_row_rules_find_their_row_each(spark):
    df = text_frame(spark, "Hospital")
    assert failing(df, v.hospital_checks(HOSPITAL, AS_OF)) == {
        ("gender", "patient_gender", 1),
        ("dob", "patient_dob", 1),
        ("admission_before_discharge", "admission_time", 1),
        ("at_least", "billed_amount", 1),
    }


def test_malformed_text_raises_nowhere(spark):
    rows = changed(
        "Hospital", 0, patient_dob="soon", admission_time="?", discharge_time="?",
        billed_amount="x", approved_amount="y",
    )
    report = v.quality_report(text_frame(spark, "Hospital", rows), v.hospital_checks(HOSPITAL, AS_OF))
    assert report.count() == 14


def test_key_uniqueness(spark):
    df = text_frame(spark, "Hospital", [*HOSPITAL_ROWS, HOSPITAL_ROWS[0], HOSPITAL_ROWS[0]])
    assert tuples(v.duplicate_keys(df, ["event_id"])) == {("T1", 3)}
    unique, empty = text_frame(spark, "Device"), text_frame(spark, "Pharma", [])
    kept = F.col("patient_gender").isin("M", "F", "O")
    report = v.key_uniqueness([
        (df, [
            v.KeyRule("Hospital", ("event_id",)),
            v.KeyRule("dim_doctor", ("doctor_id",), (F.col("department"), F.col("hospital_id")), kept),
            v.KeyRule("no rows", ("event_id",), None, F.lit(False)),
        ]),
        (unique, [v.KeyRule("Device", DEVICE.key)]),
        (empty, [v.KeyRule("Pharma", ("hospital_id", "medicine_id"))]),
    ])
    assert tuples(report) == {
        # D1 works in two departments; the copies of T1 are one tuple.
        ("Hospital", "event_id", 1, 2), ("dim_doctor", "doctor_id", 1, 1), ("no rows", "event_id", 0, 0),
        ("Device", "hospital_id,device_id,week", 0, 0), ("Pharma", "hospital_id,medicine_id", 0, 0),
    }


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, None), ("x", "a")], "k string, o string")
    report = v.key_uniqueness([(df, [v.KeyRule("rows", ("k",)), v.KeyRule("tuples", ("k",), (F.col("o"),))])])
    assert tuples(report) == {("rows", "k", 1, 2), ("tuples", "k", 1, 1)}


def test_column_contract():
    expected = DEVICE.landing_columns
    v.check_columns(expected, expected)
    swapped = [expected[1], expected[0], *expected[2:]]
    for found in (swapped, expected[1:], [*expected, "extra"]):
        with pytest.raises(v.ValidationError, match="column mismatch"):
            v.check_columns(found, expected)


def test_enforce_names_every_failing_check():
    checks = v.gate_checks(DEVICE)
    v.enforce("Device", checks, {f"check_{i}": 0 for i in range(len(checks))})
    with pytest.raises(v.ValidationError, match=r"not_null\(device_id\): 2; castable_int"):
        v.enforce(
            "Device", checks, {**{f"check_{i}": 0 for i in range(len(checks))}, "check_1": 2, "check_3": 1}
        )
    with pytest.raises(KeyError):
        v.enforce("Device", checks, {})


def test_require_hands_the_rows_back_or_raises(spark):
    df = text_frame(spark, "Hospital")
    assert v.require(df, "Hospital", v.gate_checks(HOSPITAL)) is df
    with pytest.raises(v.ValidationError, match=r"Hospital: gender\(patient_gender\): 1"):
        v.require(df, "Hospital", [v.gender_check(), v.dob_check(AS_OF.replace(year=2031))])
