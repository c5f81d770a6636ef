import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tickloom.session import build_session

    session = build_session(
        "tickloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bars(spark):
    """Builder: bars('A', [(minute, close), ...]) with one row per minute."""
    from datetime import datetime, timedelta

    def build(series, volume=1.0):
        rows = []
        for symbol, points in series.items():
            for minute, close in points:
                at = datetime(2024, 1, 1) + timedelta(minutes=minute)
                rows.append(("1m", symbol, at, close, close, close, close, volume))
        return spark.createDataFrame(
            rows,
            "screener string, symbol string, time timestamp_ntz, open double, high double, "
            "low double, close double, volume double",
        )

    return build
