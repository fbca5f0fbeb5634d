import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from meterlake.session import local_session

    home = tmp_path_factory.mktemp("spark")
    return local_session(
        8, 8, **{"spark.sql.warehouse.dir": str(home / "warehouse"), "spark.checkpoint.dir": str(home / "checkpoint")}
    )


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def rows():
    def collect(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]

    return collect
