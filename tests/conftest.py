import os
import tempfile

import pytest

from logweave.session import build_session


@pytest.fixture(scope="session")
def spark():
    spark = build_session("local[4]", "logweave-tests",
                          {"spark.sql.shuffle.partitions": "8",
                           "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="logweave-test-", dir="/tmp")


SF001 = os.environ.get("LOGWEAVE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF001
