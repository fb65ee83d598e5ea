import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barsmith.session import local_session
    s = local_session(4, shuffle_partitions=4, app="barsmith-tests")
    yield s
    s.stop()


def minute_bars(spark, symbol, start, highs, lows=None, closes=None, step_min=1):
    """Hand-made bars: one per ``step_min`` minutes from ``start``."""
    from barsmith.schema import BAR_SCHEMA
    lows = lows if lows is not None else [h - 1.0 for h in highs]
    closes = closes if closes is not None else [(h + l) / 2 for h, l in zip(highs, lows)]
    rows = []
    for i, (h, l, c) in enumerate(zip(highs, lows, closes)):
        t = start + dt.timedelta(minutes=i * step_min)
        rows.append((symbol, t, c, float(h), float(l), float(c), 100))
    return spark.createDataFrame(rows, BAR_SCHEMA)
