"""The star schema: six dimensions and four facts.

Dimensions are distinct tuples, as the marts expect; whether their ids are unique
is reported by ``validate.duplicate_keys``. ``distinct`` combines on the map side,
so a hot id reaches the shuffle at most once per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlake.contracts import HOSPITAL_DIMENSIONS, SILVER, conform


def _dimension(df: DataFrame, name: str) -> DataFrame:
    return conform(df.select(*SILVER[name]).distinct(), SILVER[name])


def dim_medicine(valid_pharma: DataFrame) -> DataFrame:
    return _dimension(valid_pharma, "dim_medicine")


def dim_device(device: DataFrame) -> DataFrame:
    return _dimension(device, "dim_device")


def dim_insurance(clean_hospital: DataFrame) -> DataFrame:
    return _dimension(clean_hospital, "dim_insurance")


def dim_patient(clean_hospital: DataFrame) -> DataFrame:
    return _dimension(clean_hospital, "dim_patient")


def dim_doctor(clean_hospital: DataFrame) -> DataFrame:
    return _dimension(clean_hospital, "dim_doctor")


def dim_bed(clean_hospital: DataFrame) -> DataFrame:
    return _dimension(clean_hospital, "dim_bed")


def hospital_dimensions(clean_hospital: DataFrame) -> DataFrame:
    """The tuples of all four hospital dimensions, told apart by ``dimension``, in one pass.

    A row becomes one tagged tuple per dimension, with NULL in the columns of the others, and one
    ``distinct`` serves all of them. Written by ``dimension``, each partition holds a whole table.
    """
    types = {c: t for name in HOSPITAL_DIMENSIONS for c, t in SILVER[name].items()}
    tuples = [
        F.struct(
            F.lit(name).alias("dimension"),
            *[(F.col(c) if c in SILVER[name] else F.lit(None)).cast(t).alias(c) for c, t in types.items()],
        )
        for name in HOSPITAL_DIMENSIONS
    ]
    return clean_hospital.select(F.inline(F.array(*tuples))).distinct()


def fact_medicine_inventory(valid_pharma: DataFrame) -> DataFrame:
    return conform(
        valid_pharma.withColumn("available_stock", F.col("total_stock") - F.col("issued_stock")),
        SILVER["fact_medicine_inventory"],
    )


def fact_device_usage(device: DataFrame) -> DataFrame:
    return conform(
        device.withColumn("available_units", F.col("total_units") - F.col("in_use_units")),
        SILVER["fact_device_usage"],
    )


def fact_admission(clean_hospital: DataFrame) -> DataFrame:
    """``length_of_stay_hrs`` counts calendar days times 24; NULL while admitted."""
    stay_days = F.datediff("discharge_time", "admission_time")
    return conform(
        clean_hospital.withColumns({
            "admission_id": F.col("event_id"),
            "length_of_stay_hrs": stay_days * 24,
            "is_currently_admitted": F.col("discharge_time").isNull(),
        }),
        SILVER["fact_admission"],
    )


def fact_billing(clean_hospital: DataFrame) -> DataFrame:
    return conform(
        clean_hospital.withColumnRenamed("event_id", "admission_id"), SILVER["fact_billing"]
    )


# silver table -> (function, cleansed source it reads)
TABLES = {
    "dim_medicine": (dim_medicine, "Pharma"),
    "dim_device": (dim_device, "Device"),
    "dim_insurance": (dim_insurance, "Hospital"),
    "dim_patient": (dim_patient, "Hospital"),
    "dim_doctor": (dim_doctor, "Hospital"),
    "dim_bed": (dim_bed, "Hospital"),
    "fact_medicine_inventory": (fact_medicine_inventory, "Pharma"),
    "fact_device_usage": (fact_device_usage, "Device"),
    "fact_admission": (fact_admission, "Hospital"),
    "fact_billing": (fact_billing, "Hospital"),
}
