import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fareline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="fareline-tests", memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """A DataFrame from tuples and DDL."""
    return lambda data, ddl: spark.createDataFrame(data, ddl)
