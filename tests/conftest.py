import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorflow.schemas import ENVELOPE  # noqa: E402
from sensorflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="sensorflow-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def envelope(spark):
    """Build envelope rows from ``[value, ...]`` or ``[(value, offset[, partition[, ts]])]``."""
    def make(values, topic="t"):
        rows = []
        for i, v in enumerate(values):
            if isinstance(v, tuple):
                value, offset = v[0], v[1]
                part = v[2] if len(v) > 2 else 0
                ts = v[3] if len(v) > 3 else dt.datetime(2024, 1, 1)
            else:
                value, offset, part, ts = v, i, 0, dt.datetime(2024, 1, 1)
            rows.append((None, value.encode() if value is not None else None, topic, part, offset, ts, 0))
        return spark.createDataFrame(rows, ENVELOPE)
    return make
