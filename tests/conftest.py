import datetime as dt

import pytest

from starloom import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "starloom-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def as_of():
    return dt.date(2025, 11, 11)


SMALL = "/root/testdata/sf0.001"
