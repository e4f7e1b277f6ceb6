"""Hot keys: right results against join-first brute force, and plans that can split them."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.data import tuples
from wardlake.contracts import SILVER
from wardlake.plans import marts, views
from wardlake.sources import bindings
from wardlake.sources.tables import ddl

N = 600


def _frame(spark, table, rows):
    return spark.createDataFrame(rows, ddl(SILVER[table]))


@pytest.fixture(scope="module")
def silver(spark):
    """A third of all rows share one admission id, insurer, medicine and device."""
    hot = lambda i, cold: 0 if i % 3 == 0 else cold
    start = datetime(2025, 11, 3)
    statuses = ("APPROVED", "REJECTED", "PENDING")
    frames = {
        "fact_billing": _frame(spark, "fact_billing", [
            (f"E{hot(i, i)}", f"INS{hot(i, i % 7)}", 1000 + i, i, statuses[i % 5 % 3])
            for i in range(N)
        ]),
        "fact_admission": _frame(spark, "fact_admission", [
            (f"E{hot(i, i)}", "P", "D", "B", "H", start + timedelta(hours=11 * i), None, None, True)
            for i in range(N)
        ]),
        # INS0 has two names, INS6 none.
        "dim_insurance": _frame(spark, "dim_insurance", [
            ("INS0", "Alpha"), ("INS0", "Alpha Ltd"), *[(f"INS{k}", f"N{k % 3}") for k in range(1, 6)]
        ]),
        "fact_medicine_inventory": _frame(spark, "fact_medicine_inventory", [
            (f"M{hot(i, i % 11)}", f"H{i % 13}", 50 + i, i % 50, date(2026, 5, 1), 50 + i - i % 50)
            for i in range(N)
        ]),
        "dim_medicine": _frame(spark, "dim_medicine", [
            ("M0", "Aspa", "A"), ("M0", "Aspa", "B"), *[(f"M{k}", f"X{k}", "C") for k in range(1, 9)]
        ]),
        "fact_device_usage": _frame(spark, "fact_device_usage", [
            (f"DEV{hot(i, i % 9)}", f"H{hot(i, i % 4)}", f"W{i}", 10 + i % 5, i % 10, 10 + i % 5 - i % 10)
            for i in range(N)
        ]),
        "dim_device": _frame(spark, "dim_device", [
            ("DEV0", "Pump", "H0"), ("DEV0", "Monitor", "H0"),
            *[(f"DEV{k}", f"T{k % 2}", f"H{h}") for k in range(1, 9) for h in range(4)]
        ]),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(f"skew_{name}")
    return frames.__getitem__


def test_finance_weekly(spark, silver):
    brute = spark.sql("""
        SELECT CAST(date_trunc('week', admission_time) AS DATE), b.insurance_id, insurance_name,
               count(*), CAST(sum(billed_amount) AS DOUBLE), CAST(sum(approved_amount) AS DOUBLE),
               CAST(sum(billed_amount - approved_amount) AS DOUBLE)
        FROM skew_fact_billing b JOIN skew_fact_admission a ON a.admission_id = b.admission_id
        LEFT JOIN skew_dim_insurance i ON i.insurance_id = b.insurance_id
        WHERE claim_status = 'APPROVED' GROUP BY 1, 2, 3""")
    mart = marts.build_mart("gold_finance_weekly", silver, "January")
    assert tuples(mart.drop("approval_percentage", "report_month")) == tuples(brute)


def test_finance_weekly_never_pairs_the_rows_of_a_hot_id(spark, silver):
    """The join sees distinct (id, insurer) and (id, week) rows only."""
    mart = marts.build_mart("gold_finance_weekly", silver, "January")
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    inner = plan[plan.index("Join Inner"):]
    assert inner.count("Aggregate [admission_id") == 2


def test_claims(spark, silver):
    joined = """FROM skew_fact_billing b LEFT JOIN skew_dim_insurance i
                ON i.insurance_id = b.insurance_id"""
    summary = marts.build_mart("gold_claim_status_summary", silver, "January").drop("report_month")
    assert tuples(summary) == tuples(spark.sql(
        f"SELECT insurance_name, claim_status, count(b.admission_id) {joined} GROUP BY 1, 2"
    ))
    rejected = marts.build_mart("gold_rejected_claims", silver, "January")
    brute = spark.sql(f"""SELECT insurance_name, count(b.admission_id) AS n {joined}
                          WHERE claim_status = 'REJECTED' GROUP BY 1""")
    assert tuples(rejected.drop("report_month")) == tuples(brute)
    ranked = views.vw_rejected_claims_ranking(rejected)
    brute.createOrReplaceTempView("skew_rejected")
    assert tuples(ranked.drop("report_month")) == tuples(spark.sql(
        "SELECT insurance_name, n, rank() OVER (ORDER BY n DESC) FROM skew_rejected"
    ))


def test_devices(spark, silver):
    mart = marts.build_mart("gold_device_availability", silver, "January")
    assert tuples(mart.drop("utilization_pct", "report_month")) == tuples(spark.sql("""
        SELECT u.hospital_id, device_type, sum(total_units), sum(in_use_units), sum(available_units)
        FROM skew_fact_device_usage u JOIN skew_dim_device d
          ON d.device_id = u.device_id AND d.hospital_id = u.hospital_id
        GROUP BY 1, 2"""))


def test_medicine(spark, silver):
    joined = "FROM skew_fact_medicine_inventory f JOIN skew_dim_medicine d USING (medicine_id)"
    mart = marts.build_mart("gold_medicine_availability", silver, "January")
    brute = spark.sql(f"SELECT hospital_id, medicine_name, category, available_stock, expiry_date {joined}")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(mart.drop("report_month")) == rows(brute)
    categories = marts.category_distribution(
        silver("fact_medicine_inventory"), silver("dim_medicine"), "January"
    )
    assert tuples(categories.drop("report_month")) == tuples(
        spark.sql(f"SELECT category, sum(available_stock) {joined} GROUP BY 1")
    )


def test_a_hot_customer_is_split_over_tasks(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    hot = orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
    )
    hot.repartition(16).write.parquet(str(tmp_path / "orders.parquet"))
    for table in ("customer", "nation"):
        spark.read.parquet(f"{sf}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = bindings.hospital_events(spark, str(tmp_path)).select("event_id", "insurance_id")
        assert len(joined.collect()) == orders.count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in plan
