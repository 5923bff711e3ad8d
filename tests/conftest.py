import pytest

from propense.plans.roles import Roles
from propense.session import get_spark
from tests.oracle import connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return get_spark("tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="session")
def roles(spark):
    return Roles(spark, SF_DIR)
