import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
