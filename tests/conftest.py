import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from threadlens import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "threadlens-tests", master="local[4]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Text of a frame's physical plan."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
