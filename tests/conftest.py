import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from faregauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=8, app_name="tests")


@pytest.fixture
def make(spark):
    """Frame from rows and a schema string, the smallest way to state a case."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


def values(frame, *columns):
    """Rows as plain tuples, in the given column order."""
    return [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
