"""Moving means on a stream from sums of panes, instead of window rows and join buffers.

A window is a whole number of panes (one slide wide).  Each bar adds to the sum
of its own pane; once the watermark has reached a bar, the panes before it are
complete, and its mean is the sum of theirs.  So a bar is one addition and, until it
is emitted, one waiting row; a window aggregate and a self-join keep a row for each
of the bar's windows and two buffers.

The key is (symbol, stripe of time): bars of the last window of a stripe are also
given to the next one, so a stripe needs nothing of its neighbours, a symbol's
history is several tasks, and a stripe's state ends with it.  Rows behind the watermark
are dropped, and Spark counts them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barsmith.functions.timefns import interval_micros

PANE_SCHEMA = T.StructType([T.StructField("pane", T.LongType())])
#: Sums and counts of the panes of a stripe, from its first looked-at pane on.
SUMS_SCHEMA = T.StructType([T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("counts", T.ArrayType(T.LongType()))])


def _plain(s: pd.Series) -> list:
    """Values of a column as Python objects, missing ones as None."""
    return s.astype(object).where(s.notna(), None).tolist()


class PaneMeans(StatefulProcessor):
    """Bars with the mean of the window before them, when the watermark reaches them."""

    def __init__(self, schema: T.StructType, time_col: str, value_col: str, out: str, window: int, slide: int, stripe: int, scale: float | None):
        self.schema, self.time_col, self.value_col, self.out = schema, time_col, value_col, out
        self.slide, self.n, self.scale = slide, window // slide, scale
        self.panes = stripe // slide
        self.names = schema.names
        self.waiting_schema = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema.fields])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", SUMS_SCHEMA)
        self.waiting = handle.getMapState("waiting", PANE_SCHEMA, self.waiting_schema)

    def _held(self):
        if self.sums.exists():
            sums, counts = self.sums.get()
            return np.array(sums, dtype=float), np.array(counts, dtype=np.int64)
        return np.zeros(self.panes + self.n), np.zeros(self.panes + self.n, dtype=np.int64)

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None or key[1] is None:
            return iter([])
        first = key[1] * self.panes - self.n
        sums, counts = self._held()
        for pdf in rows:
            us = pdf[f"pane_us_{self.time_col}"].to_numpy(dtype=np.int64)
            pane = us // self.slide
            value = pdf[self.value_col].to_numpy(dtype=float, na_value=np.nan)
            there = ~np.isnan(value)
            np.add.at(sums, (pane - first)[there], value[there])
            np.add.at(counts, (pane - first)[there], 1)
            # bars of the stripe itself that sit on the slide grid get a mean
            asked = pdf["pane_own"].to_numpy(dtype=bool) & (us % self.slide == 0)
            cols = [_plain(pdf[f"pane_us_{c}" if f"pane_us_{c}" in pdf else c]) for c in self.names]
            for p in np.unique(pane[asked]).tolist():
                at = np.flatnonzero(asked & (pane == p))
                new = [[c[i] for i in at] for c in cols]
                if self.waiting.containsKey((p,)):
                    new = [list(old) + more for old, more in zip(self.waiting.getValue((p,)), new)]
                else:
                    self.handle.registerTimer(p * self.slide // 1000)
                self.waiting.updateValue((p,), tuple(new))
        self.sums.update((sums.tolist(), counts.tolist()))
        # the stripe's state goes once its last pane is over
        self.handle.registerTimer((key[1] + 1) * self.panes * self.slide // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        p = expiredTimerInfo.getExpiryTimeInMs() * 1000 // self.slide
        if p == (key[1] + 1) * self.panes:
            self.sums.clear()
            return
        if not self.waiting.containsKey((p,)):
            return
        rows = self.waiting.getValue((p,))
        self.waiting.removeKey((p,))
        sums, counts = self._held()
        end = p - (key[1] * self.panes - self.n)
        n = int(counts[end - self.n:end].sum())
        if n:
            mean = sums[end - self.n:end].sum() / n
            out = pd.DataFrame({c: list(v) for c, v in zip(self.names, rows)})
            out[self.out] = mean if self.scale is None else mean / self.scale
            yield out

    def close(self) -> None:
        pass


def sma_panes(bars: DataFrame, window: str = "20 minutes", slide: str = "1 minute", key: str = "symbol", time_col: str = "datetime",
              value: str = "close", out: str = "sma_20", exact_decimals: int | None = None, stripe: str | None = None) -> DataFrame:
    """Streaming bars with the mean of ``value`` over ``[t - window, t)``, as ``sma_join`` (inner) gives them.

    ``bars`` has a watermark on its event time and columns of plain types.  ``window``
    is a multiple of ``slide``, and ``slide`` of a millisecond; ``stripe`` (four
    windows) is the time that a key holds, a multiple of ``slide``.  With
    ``exact_decimals`` the sums are of integers, exact below 2^53.
    """
    import sys

    from pyspark import cloudpickle

    from barsmith.session import ship_package

    w, s = interval_micros(window), interval_micros(slide)
    stripe_us = interval_micros(stripe) if stripe else 4 * w
    if w % s or s % 1000 or stripe_us % s or stripe_us < w:
        raise ValueError("a window is a multiple of the slide, a stripe of both kinds at least a window")
    ship_package(bars.sparkSession)
    cloudpickle.register_pickle_by_value(sys.modules["barsmith"])
    # times travel as micros, so that no session time zone matters in Python; names that begin with _ would not reach it
    times = {f.name: f.dataType for f in bars.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    micros = {f"pane_us_{c}": F.unix_micros(F.col(c).cast("timestamp")) for c in times}
    us = micros[f"pane_us_{time_col}"]
    scale = None if exact_decimals is None else 10.0 ** exact_decimals
    v = F.col(value).cast("double") if scale is None else F.round(F.col(value) * F.lit(scale)).cast("double")
    # rows without a symbol stay until the processor: a filter would be moved before the watermark, which heartbeats move
    rows = bars.withColumns({**micros, "pane_value": v, "pane_first": F.floor(us / F.lit(stripe_us)).cast("long")})
    last = F.floor((us + F.lit(w)) / F.lit(stripe_us)).cast("long")
    rows = rows.withColumn("pane_stripe", F.explode(F.sequence("pane_first", last))).withColumn("pane_own", F.col("pane_first") == F.col("pane_stripe")).drop("pane_first")
    plain = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in bars.schema.fields])
    proc = PaneMeans(plain, time_col, "pane_value", out, w, s, stripe_us, scale)
    got = rows.groupBy(key, "pane_stripe").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=T.StructType([*plain.fields, T.StructField(out, T.DoubleType())]), outputMode="Append", timeMode="EventTime")
    return got.withColumns({c: F.timestamp_micros(c).cast(t) for c, t in times.items()})
