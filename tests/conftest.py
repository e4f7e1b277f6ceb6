import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardlake.context import RunContext  # noqa: E402
from wardlake.session import build_session  # noqa: E402

AS_OF = date(2026, 2, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "local[8]",
        8,
        **{
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ctx(tmp_path):
    """A run of its own: databases and folders no other test uses."""
    name = f"t{abs(hash(str(tmp_path)))}"
    return RunContext(
        input_date="20260201", base_path=str(tmp_path), as_of=AS_OF, run_date=AS_OF, run_id="run1",
        database=f"silver_{name}", gold_database=f"gold_{name}", audit_database=f"audit_{name}",
    )
