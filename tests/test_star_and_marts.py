from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF
from tests.data import text_frame, tuples
from wardlake.contracts import GOLD, HOSPITAL_DIMENSIONS, SILVER
from wardlake.functions.scalars import percentage, week_number
from wardlake.operators import cleanse, star
from wardlake.plans import kpis, marts, views


@pytest.fixture(scope="module")
def clean(spark):
    return {
        "Hospital": cleanse.clean_hospital(text_frame(spark, "Hospital"), AS_OF),
        "Pharma": cleanse.clean_pharma(text_frame(spark, "Pharma"), AS_OF),
        "Device": cleanse.type_device(text_frame(spark, "Device")),
    }


@pytest.fixture(scope="module")
def silver(clean):
    built = {t: build(clean[source]) for t, (build, source) in star.TABLES.items()}
    return built.__getitem__


@pytest.fixture(scope="module")
def gold(silver):
    return {m: marts.build_mart(m, silver, "January") for m in GOLD}


def test_schemas_follow_the_contracts(silver, gold):
    for table, contract in SILVER.items():
        assert silver(table).dtypes == list(contract.items())
    for mart, contract in GOLD.items():
        assert gold[mart].dtypes == list(contract.items())


def test_dimensions(silver):
    assert tuples(silver("dim_doctor")) == {
        ("D1", "Cardiology", "H1"), ("D1", "Neurology", "H1"), ("D2", "Cardiology", "H2"),
        ("D3", "Oncology", "H2"),
    }
    assert silver("dim_bed").count() == 4
    assert silver("dim_medicine").count() == 3
    assert tuples(silver("dim_insurance")) == {("INS1", "Alpha"), ("INS2", "Beta")}
    assert silver("dim_patient").count() == 5
    assert silver("dim_device").count() == 7


def test_length_of_stay_counts_days(silver):
    stay = tuples(
        silver("fact_admission"), "admission_id", "length_of_stay_hrs", "is_currently_admitted"
    )
    assert stay == {
        ("T1", 48, False), ("T2", None, True), ("T3", 0, False), ("T8", 24, False),
        ("T9", None, True),
    }


def test_finance_weekly(gold):
    assert tuples(gold["gold_finance_weekly"]) == {
        (date(2025, 12, 1), "INS1", "Alpha", 2, 12435.0, 4469.0, 7966.0, 35.94, "January"),
        (date(2025, 12, 8), "INS2", "Beta", 1, 500.0, 500.0, 0.0, 100.0, "January"),
    }


def test_finance_keeps_an_unknown_insurer(silver):
    known = silver("dim_insurance").filter("insurance_id = 'INS1'")
    mart = marts.gold_finance_weekly(
        silver("fact_billing"), silver("fact_admission"), known, "January"
    )
    assert tuples(mart, "insurance_id", "insurance_name", "total_claims") == {
        ("INS1", "Alpha", 2), ("INS2", None, 1),
    }
    summary = marts.gold_claim_status_summary(silver("fact_billing"), known, "January")
    assert (None, "REJECTED", 1, "January") in tuples(summary)
    rejected = marts.gold_rejected_claims(silver("fact_billing"), known, "January")
    assert tuples(rejected) == {(None, 1, "January")}


def test_weekly_admissions_and_status(gold):
    assert [tuple(r)[:2] for r in gold["gold_weekly_admissions"].collect()] == [
        (date(2025, 12, 1), 2), (date(2025, 12, 8), 1), (date(2025, 12, 15), 2),
    ]
    assert tuples(gold["gold_patient_status"], "patient_status", "patient_count") == {
        ("Discharged", 3), ("Currently Admitted", 2),
    }


def test_claim_breakdown(gold):
    view = views.vw_claim_status_breakdown(gold["gold_claim_status_summary"])
    columns = ("insurance_name", "claim_status", "claim_count", "total_claims_per_insurer",
               "claim_status_pct")
    assert tuples(view, *columns) == {
        ("Alpha", "APPROVED", 2, 3, 66.7), ("Alpha", "PENDING", 1, 3, 33.3),
        ("Beta", "APPROVED", 1, 2, 50.0), ("Beta", "REJECTED", 1, 2, 50.0),
    }


def test_device_availability_and_status(gold):
    view = views.vw_device_utilization(gold["gold_device_availability"])
    assert tuples(view, "hospital_id", "device_type", "utilization_pct", "utilization_status") == {
        ("H01", "Ventilator", 90.0, "OVERLOADED"), ("H01", "Monitor", 70.0, "HIGH"),
        ("H02", "Ventilator", 50.0, "MODERATE"), ("H02", "Monitor", 12.5, "AVAILABLE"),
        ("H03", "Ventilator", None, "AVAILABLE"), ("H03", "Monitor", 91.0, "OVERLOADED"),
    }
    over = kpis.kpi_overloaded_devices(gold["gold_device_availability"])
    assert tuples(over, "hospital_id", "device_type") == {("H03", "Monitor")}
    bands = tuples(
        kpis.kpi_utilization_bands(gold["gold_device_availability"]), "utilization_pct", "band"
    )
    assert bands == {
        (90.0, "Yellow"), (70.0, "Yellow"), (50.0, "Green"), (12.5, "Green"), (None, None),
        (91.0, "Red"),
    }


def test_utilization_matrix(gold):
    found = kpis.kpi_utilization_matrix(gold["gold_device_availability"])
    assert {r.hospital_id: r.utilization for r in found.collect()} == {
        "H01": {"Monitor": 70.0, "Ventilator": 90.0}, "H02": {"Monitor": 12.5, "Ventilator": 50.0},
        "H03": {"Monitor": 91.0, "Ventilator": None},
    }


def test_hospital_dimensions_in_one_pass(spark, clean, silver):
    rows = clean["Hospital"]
    tagged = star.hospital_dimensions(rows)
    for name in HOSPITAL_DIMENSIONS:
        assert tuples(tagged.filter(F.col("dimension") == name), *SILVER[name]) == tuples(silver(name))
        others = [c for c in tagged.columns if c not in {"dimension", *SILVER[name]}]
        assert tagged.filter(F.col("dimension") == name).select(*others).dropna("all").isEmpty()
    assert tagged.count() == sum(silver(name).count() for name in HOSPITAL_DIMENSIONS)
    assert {r.dimension for r in star.hospital_dimensions(rows.limit(0)).collect()} == set()


def test_stock_alert_and_categories(silver, gold):
    alert = views.vw_medicine_stock_alert(gold["gold_medicine_availability"])
    assert tuples(alert, "available_stock", "stock_alert_level") == {
        (199, "CRITICAL"), (200, "LOW"), (499, "LOW"), (500, "ADEQUATE"), (600, "ADEQUATE"),
    }
    assert kpis.kpi_low_stock(alert).count() == 3
    categories = marts.category_distribution(
        silver("fact_medicine_inventory"), silver("dim_medicine"), "January"
    )
    assert tuples(categories) == {
        ("Antibiotic", 600, "January"), ("Cardiac", 999, "January"), ("Painkiller", 399, "January"),
    }
    stock = kpis.kpi_stock_by_medicine(silver("fact_medicine_inventory"), silver("dim_medicine"))
    assert tuples(stock) == {
        ("MED001", "Aspa", 2000, 399), ("MED002", "Beto", 2000, 999), ("MED004", "Delo", 600, 600),
    }


def test_measures(spark, clean, silver, gold):
    assert tuples(kpis.kpi_admissions(silver("fact_admission"))) == {(5, 2, 3)}
    assert tuples(kpis.kpi_admissions_by_department(clean["Hospital"])) == {
        ("Cardiology", 3), ("Neurology", 1), ("Oncology", 1),
    }
    totals = kpis.kpi_finance_totals(gold["gold_finance_weekly"]).first()
    assert tuple(totals) == (12935.0, 4969.0, 7966.0, 67.97)
    assert tuples(kpis.kpi_leakage_by_insurer(gold["gold_finance_weekly"])) == {
        ("Alpha", 7966.0), ("Beta", 0.0),
    }
    assert tuples(kpis.kpi_claim_distribution(gold["gold_claim_status_summary"])) == {
        ("APPROVED", 3, 60.0), ("PENDING", 1, 20.0), ("REJECTED", 1, 20.0),
    }
    assert tuples(kpis.expiry_status_summary(text_frame(spark, "Pharma"), AS_OF)) == {(1, 7)}


def test_rejection_rank_shares_and_skips(spark):
    mart = spark.createDataFrame(
        [("A", 5, "m"), ("B", 7, "m"), ("C", 5, "m"), (None, 1, "m"), ("D", 7, "m")],
        "insurance_name string, rejected_claim_count bigint, report_month string",
    )
    ranks = tuples(views.vw_rejected_claims_ranking(mart), "insurance_name", "rejection_rank")
    assert ranks == {("B", 1), ("D", 1), ("A", 3), ("C", 3), (None, 5)}


def test_week_number_starts_on_sunday(spark):
    days = [
        (date(2025, 12, 29), 53), (date(2026, 1, 1), 1), (date(2026, 1, 3), 1),
        (date(2026, 1, 4), 2), (date(2024, 12, 31), 53), (date(2023, 1, 1), 1),
        (date(2023, 1, 8), 2),
    ]
    df = spark.createDataFrame(days, "d date, w int")
    assert df.filter(week_number(F.col("d")) != F.col("w")).count() == 0


def test_percentage_rounds_half_up_and_survives_large_sums(spark):
    rows = [(1, 3, 33.33), (2, 3, 66.67), (1, 800, 0.13), (0, 5, 0.0), (5, 0, None),
            (-1, 800, -0.13), (4 * 10**18, 8 * 10**18, 50.0)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, expected double")
    wrong = ~percentage(F.col("a"), F.col("b"), 2).eqNullSafe(F.col("expected"))
    assert df.filter(wrong).collect() == []
