import json
from datetime import datetime

import pytest

from reelstat.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """``"02 10:30"`` as day and time of January 2024."""
    return datetime.fromisoformat(f"2024-01-{text.replace(' ', 'T')}")


@pytest.fixture(scope="session")
def raw(spark):
    """Raw events from (event, params, time) tuples."""

    def build(*rows):
        data = [(e, json.dumps(p) if isinstance(p, dict) else p, at(t)) for e, p, t in rows]
        return spark.createDataFrame(data, "event string, params string, timestamp timestamp_ntz")

    return build


def rows(df, *order):
    """Rows as dicts, sorted by the given columns."""
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
