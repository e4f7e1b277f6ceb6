"""The three operational databases as JDBC reads.

None of the source keys is a number, so a read is split by a hash of the key: the
splits are even whatever the values look like, and together cover every row. Each of them scans
the source, though; with cut points of an indexed column a split is a range of that index instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str
    table: str
    bucket: str
    """SQL that maps a row to 0 .. ``{n}`` - 1 in the source's dialect."""
    options: dict[str, str] = field(default_factory=dict)

    def predicates(self, partitions: int) -> list[str]:
        return [f"{self.bucket.format(n=partitions)} = {i}" for i in range(partitions)]

    def ranges(self, column: str, cuts: Sequence[str | int]) -> list[str]:
        """One more split than cut points, which ascend in the database's own order; NULLs are in the first."""
        if any("\\" in c for c in cuts if isinstance(c, str)):
            raise ValueError("databases read a backslash in a text differently")
        texts = [str(c) if isinstance(c, int) else "'" + c.replace("'", "''") + "'" for c in cuts]
        if not texts:
            return ["1 = 1"]
        between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(texts, texts[1:])]
        return [f"{column} < {texts[0]} OR {column} IS NULL", *between, f"{column} >= {texts[-1]}"]

    def properties(self, user: str, password: str, fetch_size: int = 10_000) -> dict[str, str]:
        return {
            "driver": self.driver,
            "user": user,
            "password": password,
            "fetchsize": str(fetch_size),
            **self.options,
        }


def mysql_hospital(host: str, database: str) -> JdbcSource:
    return JdbcSource(
        url=f"jdbc:mysql://{host}:3306/{database}",
        driver="com.mysql.cj.jdbc.Driver",
        table="hospital_events",
        bucket="MOD(CRC32(event_id), {n})",
        # The MySQL driver streams rows only through a server-side cursor.
        options={"useCursorFetch": "true"},
    )


def azure_sql_device(host: str, database: str) -> JdbcSource:
    return JdbcSource(
        url=f"jdbc:sqlserver://{host}:1433;databaseName={database}",
        driver="com.microsoft.sqlserver.jdbc.SQLServerDriver",
        table="dbo.device_events",
        bucket="ABS(CAST(CHECKSUM(hospital_id, device_id, week) AS BIGINT)) % {n}",
        options={"encrypt": "true", "loginTimeout": "30"},
    )


def postgresql_pharma(host: str, database: str) -> JdbcSource:
    return JdbcSource(
        url=f"jdbc:postgresql://{host}:5432/{database}",
        driver="org.postgresql.Driver",
        table="pharma_events",
        bucket="MOD(ABS(hashtext(hospital_id || medicine_id)::bigint), {n})",
        options={"sslmode": "require"},
    )


def read_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    user: str,
    password: str,
    partitions: int = 1,
    ranges: tuple[str, Sequence[str | int]] | None = None,
) -> DataFrame:
    """Split by the key's hash into ``partitions``, or by ``ranges``: an indexed column and its cut points."""
    return spark.read.jdbc(
        source.url,
        source.table,
        predicates=source.ranges(*ranges) if ranges else source.predicates(partitions),
        properties=source.properties(user, password),
    )
