"""Parameters of one run and everything derived from them on the driver."""

from __future__ import annotations

import calendar
import uuid
from dataclasses import dataclass, field
from datetime import date, datetime

from wardlake.contracts import SourceContract


@dataclass(frozen=True)
class RunContext:
    """Parameters of one run.

    ``as_of`` replaces the wall clock in every rule that compares with "today",
    so a rerun with the same context gives the same tables. ``base_path`` must be
    a folder that driver and executors share.

    ``fact_buckets`` stores both hospital facts bucketed by ``admission_id``: one
    shuffle of each when it is written, and none when the finance mart joins them.
    Ids must then be unique, as the source's key promises, and the run fails where
    they are not; without buckets a repeated id is no problem.

    ``run_seq`` is the run's number in the audit table; a run takes the next one when it starts.
    """

    input_date: str
    base_path: str
    as_of: date = field(default_factory=date.today)
    run_date: date = field(default_factory=date.today)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    pipeline_name: str = "healthcare_ingest"
    database: str = "silver"
    gold_database: str = "gold"
    audit_database: str = "audit"
    history: bool = False
    fact_buckets: int | None = None
    run_seq: int | None = None

    @property
    def report_period(self) -> date:
        """The month before ``input_date``; the day is clamped to the month's end."""
        day = datetime.strptime(self.input_date, "%Y%m%d").date()
        year, month = (day.year, day.month - 1) if day.month > 1 else (day.year - 1, 12)
        return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))

    @property
    def report_month(self) -> str:
        return calendar.month_name[self.report_period.month]

    @property
    def report_year(self) -> int:
        return self.report_period.year

    @property
    def landing_folder(self) -> str:
        return f"{self.base_path}/landing/Raw_Data"

    def landing_file(self, source: SourceContract) -> str:
        return f"{source.name}_events_{self.report_month}_{self.report_year}.csv"

    def landing_path(self, source: SourceContract) -> str:
        return f"{self.landing_folder}/{self.landing_file(source)}"

    def bronze_path(self, source: SourceContract) -> str:
        """One directory per run: a run whose gate fails leaves the last good one alone."""
        return f"{self.base_path}/bronze/Staging_Data/{source.name}_Data/{self.run_id}"

    def stage_path(self, name: str) -> str:
        return f"{self.base_path}/silver_stage/{name}"

    def reject_path(self, source: str) -> str:
        """Rows that silver's rules drop, kept per run with the rules they break."""
        return f"{self.base_path}/silver_reject/{source}/{self.run_id}"

    def silver_folder(self, version: str) -> str:
        """The files of all silver tables of one version."""
        return f"{self.base_path}/silver/{version}"

    def gold_path(self, mart: str) -> str:
        return f"{self.base_path}/gold/Gold_Data/{mart}"

    def database_path(self, database: str) -> str:
        return f"{self.base_path}/catalog/{database}"

    def silver_table(self, table: str) -> str:
        return f"{self.database}.{table}"

    @property
    def audit_table(self) -> str:
        return f"{self.audit_database}.audit_log"
