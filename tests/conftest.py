import os

import pytest

from gramlark.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, spark__driver__memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def raw(spark, sf_dir):
    from gramlark.schema import NUMERIC, TARGET, CATEGORY
    from gramlark.session import stage
    from gramlark.sources.listing import listing

    return stage(listing(spark, sf_dir, NUMERIC + [TARGET, CATEGORY, "row_key"], fold=True), "raw")
