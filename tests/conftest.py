import os
import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
              "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    return Path(os.environ.get("FLEET_TESTDATA", "/root/testdata"))


@pytest.fixture()
def settings(spark):
    """`with settings(**conf):` sets session options, dots written as double underscores."""
    @contextmanager
    def override(**conf):
        conf = {key.replace("__", "."): str(value) for key, value in conf.items()}
        before = {key: spark.conf.get(key, None) for key in conf}
        for key, value in conf.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return override
