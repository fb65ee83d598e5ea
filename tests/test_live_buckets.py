"""Waiting bars in buckets: what a release reads, and that nothing is lost or told apart by arrival."""

import random

import numpy as np
import pandas as pd

from barsmith.streaming.live import IndicatorProcessor

DAY = 86_400_000_000


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, v):
        self.held = v

    def clear(self):
        self.held = None


class Map:
    """In-memory map state that counts the values read."""

    def __init__(self):
        self.held, self.reads = {}, []

    def containsKey(self, k):
        return k in self.held

    def getValue(self, k):
        self.reads.append(k[0])
        return self.held[k]

    def updateValue(self, k, v):
        self.held[k] = v

    def removeKey(self, k):
        self.held.pop(k, None)

    def iterator(self):
        return iter(list(self.held.items()))


class Handle:
    def __init__(self):
        self.values, self.maps, self.timers = {}, {}, []

    def getValueState(self, name, schema):
        return self.values.setdefault(name, Value())

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, Map())

    def registerTimer(self, ms):
        self.timers.append(ms)


class Watermark:
    def __init__(self, us):
        self.us = us

    def getCurrentWatermarkInMs(self):
        return self.us // 1000


def processor():
    p, h = IndicatorProcessor(), Handle()
    p.init(h)
    return p, h


def feed(p, times, rng):
    for k in range(0, len(times), 5000):
        us = np.array(times[k:k + 5000])
        close = 100 + (us // 60_000_000) % 17
        pdf = pd.DataFrame({"datetime": pd.to_datetime(us, unit="us"), "open": close, "high": close + 1.0, "low": close - 1.0, "close": close.astype(float), "volume": 5})
        list(p.handleInputRows(("a",), iter([pdf]), None))


def test_a_release_reads_only_the_buckets_it_reaches():
    """40 days of delay and 100,000 waiting bars."""
    rng = random.Random(1)
    p, h = processor()
    times = [k * (40 * DAY // 100_000) for k in range(100_000)]
    shuffled = times[:]
    rng.shuffle(shuffled)
    feed(p, shuffled, rng)
    assert len(h.maps["waiting"].held) == 40
    out = []
    for day in (1, 2, 3, 3.5):
        h.maps["waiting"].reads.clear()
        out += list(p.handleExpiredTimer(("a",), Watermark(int(day * DAY) - 1), None))
        # the bucket released, once more if part of it goes on waiting
        assert set(h.maps["waiting"].reads) <= {int(day) - 1, int(day)} and len(h.maps["waiting"].reads) <= 2
    got = pd.concat(out)
    assert len(got) == sum(t <= 3.5 * DAY - 1 for t in times) and got.datetime.is_monotonic_increasing
    assert h.timers[-1] == -(-min(t for t in times if t > 3.5 * DAY - 1) // 1000)
    out = list(p.handleExpiredTimer(("a",), Watermark(41 * DAY), None))
    assert len(out) > 1 and len(got) + sum(map(len, out)) == len(times) and not h.maps["waiting"].held and not h.maps["first"].held


def test_buckets_do_not_change_the_result():
    rng = random.Random(2)
    times = [k * 3_600_000_000 for k in range(300)]
    results = []
    for bucket in ("1 hour", "7 hours", "30 days"):
        p, h = IndicatorProcessor(bucket=bucket), Handle()
        p.init(h)
        shuffled = times + times[10:40]
        rng.shuffle(shuffled)
        feed(p, shuffled, rng)
        parts = []
        for passed in (50.5, 51, 190, 400):
            parts += list(p.handleExpiredTimer(("a",), Watermark(int(passed * 3_600_000_000)), None))
        results.append(pd.concat(parts).reset_index(drop=True))
    assert len(results[0]) == 300
    for other in results[1:]:
        pd.testing.assert_frame_equal(results[0], other, rtol=1e-10)
