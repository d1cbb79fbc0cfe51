from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from signalmill.schemas import struct  # noqa: E402
from signalmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, "4g")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw rows of a signal from dicts; absent columns are NULL."""

    def make(signal: str, rows: list[dict]):
        schema = struct(signal)
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    return make
