import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from factloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture(scope="session")
def sf(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
