import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roadflux import session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    made = session.build("tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
    })
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(frame, *order):
    """Rows as tuples in a fixed order."""
    got = [tuple(r) for r in frame.collect()]
    return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))
