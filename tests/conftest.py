import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tickloom import AsOf, build_session  # noqa: E402

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tickloom-tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return AsOf("2024-01-30 12:00:00")


@pytest.fixture(scope="session")
def make_ticks(spark):
    """Ticks from (ticker, sector, time, open, close, volume) rows."""
    columns = "ticker STRING, sector STRING, timestamp STRING, open DOUBLE, close DOUBLE, volume BIGINT"

    def make(rows):
        return spark.createDataFrame(rows, columns).selectExpr(
            "ticker",
            "sector",
            "CAST(timestamp AS TIMESTAMP) AS timestamp",
            "CAST(timestamp AS TIMESTAMP) AS fetch_ts",
            "open",
            "greatest(open, close) AS high",
            "least(open, close) AS low",
            "close",
            "volume",
        )

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
