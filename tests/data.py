"""Small invented rows: one bad row per rule."""

from wardlake.contracts import DEVICE, HOSPITAL, PHARMA

_INSURERS = {"INS1": "Alpha", "INS2": "Beta"}


def _event(n, gender, dob, insurer, department, doctor, bed, hospital, admitted, discharged,
           billed, approved, status):
    bed_id, bed_type = bed.split()
    return (
        f"T{n}", f"P{n}", gender, dob, insurer, _INSURERS[insurer], department, doctor, bed_id,
        bed_type, hospital, f"{admitted}:00", discharged and f"{discharged}:00", str(billed),
        str(approved), status,
    )


HOSPITAL_ROWS = [
    _event(1, "M", "1980-01-01", "INS1", "Cardiology", "D1", "B1 ICU", "H1",
           "2025-12-01 08:00", "2025-12-03 07:00", 1000, 900, "APPROVED"),
    _event(2, "F", "1990-06-15", "INS1", "Neurology", "D1", "B2 General", "H1",
           "2025-12-07 23:00", None, 11435, 3569, "APPROVED"),
    _event(3, "O", "2000-02-29", "INS2", "Cardiology", "D2", "B1 ICU", "H2",
           "2025-12-08 00:00", "2025-12-08 17:00", 500, 500, "APPROVED"),
    _event(4, "X", "1980-01-01", "INS1", "Cardiology", "D1", "B1 ICU", "H1",
           "2025-12-01 08:00", "2025-12-02 08:00", 50, 40, "APPROVED"),
    _event(5, "M", "2030-01-01", "INS1", "Cardiology", "D1", "B1 ICU", "H1",
           "2025-12-01 08:00", "2025-12-02 08:00", 50, 40, "APPROVED"),
    _event(6, "M", "1980-01-01", "INS1", "Cardiology", "D1", "B1 ICU", "H1",
           "2025-12-02 08:00", "2025-12-01 08:00", 50, 40, "APPROVED"),
    _event(7, "M", "1980-01-01", "INS1", "Cardiology", "D1", "B1 ICU", "H1",
           "2025-12-01 08:00", "2025-12-02 08:00", 100, 200, "APPROVED"),
    _event(8, "F", "1975-03-03", "INS2", "Oncology", "D3", "B3 Private", "H2",
           "2025-12-15 10:00", "2025-12-16 10:00", 700, 0, "REJECTED"),
    _event(9, "M", "2026-02-01", "INS1", "Cardiology", "D1", "B1 ICU", "H1",
           "2025-12-15 11:00", None, 300, 0, "PENDING"),
]

DEVICE_ROWS = [
    (hospital, device, kind, str(total), str(used), "2026-M01")
    for hospital, device, kind, total, used in [
        ("H01", "DEV001", "Ventilator", 10, 9),
        ("H01", "DEV002", "Ventilator", 10, 9),
        ("H01", "DEV003", "Monitor", 10, 7),
        ("H02", "DEV001", "Ventilator", 20, 10),
        ("H02", "DEV003", "Monitor", 8, 1),
        ("H03", "DEV001", "Ventilator", 0, 0),
        ("H03", "DEV003", "Monitor", 100, 91),
    ]
]

PHARMA_ROWS = [
    (medicine, name, category, hospital, str(total), str(issued), expiry)
    for medicine, name, category, hospital, total, issued, expiry in [
        ("MED001", "Aspa", "Painkiller", "H01", 1000, 801, "2026-02-01"),
        ("MED001", "Aspa", "Painkiller", "H02", 1000, 800, "2026-06-01"),
        ("MED002", "Beto", "Cardiac", "H01", 1000, 501, "2026-06-01"),
        ("MED002", "Beto", "Cardiac", "H02", 1000, 500, "2026-06-01"),
        ("MED003", "Gamo", "Antibiotic", "H01", 100, 10, "2026-01-31"),
        ("MED003", "Gamo", "Antibiotic", "H02", 100, 101, "2026-06-01"),
        ("MED003", "Gamo", "Antibiotic", "H03", -1, 0, "2026-06-01"),
        ("MED004", "Delo", "Antibiotic", "H01", 600, 0, None),
    ]
]

ROWS = {"Hospital": HOSPITAL_ROWS, "Device": DEVICE_ROWS, "Pharma": PHARMA_ROWS}
CONTRACTS = {"Hospital": HOSPITAL, "Device": DEVICE, "Pharma": PHARMA}


def text_frame(spark, source, rows=None):
    return spark.createDataFrame(
        ROWS[source] if rows is None else rows, CONTRACTS[source].text_schema
    )


def changed(source, index, **values):
    """The rows of a source with some fields of one row replaced."""
    columns = CONTRACTS[source].columns
    rows = [list(r) for r in ROWS[source]]
    for column, value in values.items():
        rows[index][columns.index(column)] = value
    return [tuple(r) for r in rows]


def tuples(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
