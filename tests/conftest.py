"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import session

    s = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no driver tables")
    return str(path)
