import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsflow.session import build_session  # noqa: E402


def test_session():
    spark = build_session(
        "opsflow-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="5000",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="opsflow-tests-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="opsflow-warehouse-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


test_session.__test__ = False


@pytest.fixture(scope="session")
def spark():
    session = test_session()
    yield session
    session.stop()
