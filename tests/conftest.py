import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)


@pytest.fixture(scope="session")
def spark():
    from fieldcast.session import build_session

    session = build_session(
        "tests", master="local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
