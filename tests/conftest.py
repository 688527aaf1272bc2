import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
