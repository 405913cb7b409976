import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillhouse.functions.casts import moment
from tillhouse.session import build_session
from tillhouse.sources.testdata import AS_OF


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.log.level": "ERROR"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return moment(AS_OF)


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test."""
    before = {}

    def put(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
