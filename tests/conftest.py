import pytest

from tests.oracle_check import database, session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session("4")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def con():
    return database(SMALL)
