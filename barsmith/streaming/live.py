"""Live continuation of the recursive indicators, in event-time order per symbol.

A keyed ``transformWithStateInPandas`` processor holds, per symbol, the EMA of
every span, the signal line, the bar count and the last ``left + right``
highs/lows.  It can start from the end-of-history snapshot of the batch
operators (``warm_state``), so batch history + live stream equals one batch
run over the whole series.

A recursion cannot be rewound, so bars wait in keyed state until the watermark
has passed them and are then processed in time order, however the input was
split into files and micro-batches.  They wait in buckets of time: an arrival
rewrites its own bucket, a release reads the buckets that the watermark has
reached, so the cost does not grow with all that waits.  The watermark's delay is the disorder that
is tolerated, and bounds what waits.  Only bars behind the watermark are
dropped, and Spark counts them (``dropped_by_watermark``).  Of several bars of
one symbol and time, the one with the largest volume is used, then the largest
close, high, low and open; the choice does not depend on the split either.
Bars at or before the last bar of a warm state are part of it already.

A row without a symbol is a heartbeat: it only moves the watermark to its time,
which releases the bars that wait at the end of a bounded stream.

Python sees only *new* bars: the history is done by the batch block scan.  A
symbol's released bars are processed with numpy (blocked closed-form EMA runs
continuing from the state, sliding-window pivots over the carried tail).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barsmith.functions.timefns import interval_micros
from barsmith.operators.bars import indicator_state
from barsmith.operators.sequence import ema_decay
from barsmith.schema import EMA_SPANS, LONG_SPAN, MIN_PRIOR, PIVOT_LEFT, PIVOT_RIGHT, SIGNAL_SPAN

STATE_SCHEMA = T.StructType([
    T.StructField("ema", T.ArrayType(T.DoubleType())),
    T.StructField("signal", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("last_us", T.LongType()),
    T.StructField("tail_high", T.ArrayType(T.DoubleType())),
    T.StructField("tail_low", T.ArrayType(T.DoubleType())),
])

#: What decides between bars of one time, the most telling first.
DECIDES = ("volume", "close", "high", "low", "open")
BUCKET_SCHEMA = T.StructType([T.StructField("bucket", T.LongType())])
#: The waiting bars of a bucket, column by column.
WAITING_SCHEMA = T.StructType([
    T.StructField("us", T.ArrayType(T.LongType())), T.StructField("volume", T.ArrayType(T.LongType())),
    *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in DECIDES[1:]],
])
FIRST_SCHEMA = T.StructType([T.StructField("us", T.LongType())])
#: Bars that are released at a time; one bucket at least.
RELEASE_ROWS = 20_000
TIMER_SCHEMA = T.StructType([T.StructField("ms", T.LongType())])


def output_schema(spans: list[int]) -> T.StructType:
    f = [T.StructField("symbol", T.StringType()), T.StructField("datetime", T.TimestampType()),
         *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")],
         T.StructField("volume", T.LongType())]
    f += [T.StructField(f"ema_{n}", T.DoubleType()) for n in spans]
    f += [T.StructField(c, T.DoubleType()) for c in ("macd", "signal", "support", "resistance")]
    return T.StructType(f)


def _ema_run(x: np.ndarray, alpha: float, prev: float, block: int = 256) -> np.ndarray:
    """EMA over ``x`` continuing from ``prev``, in closed form per block:
    ``y_i = b^(i+1) prev + sum_{j<=i} b^(i-j) a x_j``; blocks keep ``b^-i``
    finite, the carry links them."""
    b = 1.0 - alpha
    out = np.empty(len(x))
    if b <= 0.0:
        out[:] = x
        return out
    step = max(1, min(block, int(500.0 / -np.log(b)) if b < 1.0 else block))
    carry = prev
    for s0 in range(0, len(x), step):
        seg = x[s0:s0 + step]
        i = np.arange(len(seg))
        loc = b ** i * np.cumsum(b ** (-i) * (alpha * seg))
        y = loc + b ** (i + 1) * carry
        out[s0:s0 + len(seg)] = y
        carry = y[-1]
    return out


def _micros(s: pd.Series) -> np.ndarray:
    return pd.to_datetime(s).astype("datetime64[us]").astype("int64").to_numpy()


class IndicatorProcessor(StatefulProcessor):
    """EMA / MACD / signal / support-resistance, continued bar by bar."""

    def __init__(self, spans=tuple(EMA_SPANS), long_span=LONG_SPAN, signal_span=SIGNAL_SPAN,
                 left=PIVOT_LEFT, right=PIVOT_RIGHT, min_prior=MIN_PRIOR, bucket: str = "1 day"):
        self.bucket = interval_micros(bucket)
        self.macd_spans = list(spans)
        self.spans = list(spans) + ([long_span] if long_span else [])
        self.alpha = [1.0 - ema_decay(n) for n in self.spans]
        self.sig_alpha = 1.0 - ema_decay(signal_span)
        self.i_short = self.spans.index(min(self.macd_spans))
        self.i_long = self.spans.index(max(self.macd_spans))
        self.left, self.right, self.min_prior = left, right, min_prior
        self.width = left + right + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("indicators", STATE_SCHEMA)
        self.waiting = handle.getMapState("waiting", BUCKET_SCHEMA, WAITING_SCHEMA)
        self.first = handle.getMapState("first", BUCKET_SCHEMA, FIRST_SCHEMA)
        self.timer = handle.getValueState("timer", TIMER_SCHEMA)

    def _load(self):
        if self.state.exists():
            s = self.state.get()
            return (list(s[0]), s[1], int(s[2]), int(s[3]), list(s[4] or []), list(s[5] or []))
        return None

    def _wake_at(self, us: int) -> None:
        """Wake up once the watermark has reached a time, unless an earlier call is due."""
        ms = -(-us // 1000)
        if not self.timer.exists() or self.timer.get()[0] > ms:
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleInputRows(self, key, rows, timerValues):
        st = self._load()
        for pdf in rows:
            pdf = pdf[pdf["close"].notna() & pdf["datetime"].notna()]
            if key[0] is None or pdf.empty:
                continue
            us = _micros(pdf["datetime"])
            if st is not None:
                pdf, us = pdf[us > st[3]], us[us > st[3]]
            if len(us):
                volume = pdf["volume"].fillna(0).astype("int64")
                cols = [us, volume.to_numpy(), *[pdf[c].astype(float).to_numpy() for c in DECIDES[1:]]]
                bucket = us // self.bucket
                for b in np.unique(bucket).tolist():
                    self._wait(b, [c[bucket == b].tolist() for c in cols])
        return iter([])

    def _wait(self, b: int, cols: list[list]) -> None:
        """Add bars to a bucket."""
        least = min(cols[0])
        if self.first.containsKey((b,)):
            least = min(least, self.first.getValue((b,))[0])
            cols = [list(old) + new for old, new in zip(self.waiting.getValue((b,)), cols)]
        self.waiting.updateValue((b,), tuple(cols))
        self.first.updateValue((b,), (least,))
        self._wake_at(least)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = int(timerValues.getCurrentWatermarkInMs()) * 1000
        self.timer.clear()
        first = sorted((row[0], b[0]) for b, row in self.first.iterator())
        due: list[tuple] = []
        for least, b in first:
            if least > passed:
                self._wake_at(least)
                break
            rows = list(zip(*self.waiting.getValue((b,))))
            later = [r for r in rows if r[0] > passed]
            self.waiting.removeKey((b,))
            self.first.removeKey((b,))
            if later:
                self._wait(b, [list(c) for c in zip(*later)])
            due += [r for r in rows if r[0] <= passed]
            if len(due) >= RELEASE_ROWS:
                yield self._release(key, due)
                due = []
        if due:
            yield self._release(key, due)

    def _release(self, key, due: list[tuple]) -> pd.DataFrame:
        """The bars that are due, in time order, with their indicators; moves the state on."""
        lowest = float("-inf")
        best: dict[int, tuple] = {}
        for row in due:
            rank = (row[1], *(lowest if v is None or v != v else v for v in row[2:]))
            if row[0] not in best or rank > best[row[0]][0]:
                best[row[0]] = (rank, row)
        rows = [best[us][1] for us in sorted(best)]
        us = np.array([r[0] for r in rows], dtype=np.int64)
        close, high, low, open_ = (np.array([np.nan if r[c] is None else r[c] for r in rows], dtype=float) for c in (2, 3, 4, 5))
        m = len(rows)
        st = self._load()
        if st is None:                      # first bar ever: every average starts at it
            ema0, sig0, n, th, tl = [close[0]] * len(self.spans), None, 0, [], []
        else:
            ema0, sig0, n, _, th, tl = st
        emas = [_ema_run(close, a, e) for a, e in zip(self.alpha, ema0)]
        macd = emas[self.i_short] - emas[self.i_long]
        sig = _ema_run(macd, self.sig_alpha, macd[0] if sig0 is None else sig0)
        res_lvl, th = self._pivots(high, th, n, np.argmax)
        sup_lvl, tl = self._pivots(low, tl, n, np.argmin)
        self.state.update(([float(e[-1]) for e in emas], float(sig[-1]), n + m, int(us[-1]),
                           th, tl))
        out = {"symbol": [key[0]] * m, "datetime": pd.to_datetime(us, unit="us"), "open": open_,
               "high": high, "low": low, "close": close, "volume": [r[1] for r in rows]}
        for span, e in zip(self.spans, emas):
            out[f"ema_{span}"] = e
        out.update({"macd": macd, "signal": sig, "support": sup_lvl, "resistance": res_lvl})
        return pd.DataFrame(out)

    def _pivots(self, v: np.ndarray, tail: list, n: int, pick):
        """Level (the bar's own value) where the first extreme of the trailing
        ``width`` bars sits at ``left``; returns levels and the new tail."""
        hist = self.width - 1
        allv = np.concatenate([np.asarray(tail, dtype=float), v])
        lvl = np.zeros(len(v))
        t = len(tail)
        if len(allv) >= self.width:
            win = np.lib.stride_tricks.sliding_window_view(allv, self.width)
            # first extreme, like list.index; a window with a missing value has none
            hit = (pick(win, axis=1) == self.left) & ~np.isnan(win).any(axis=1)
            idx = np.arange(len(win)) + self.width - 1 - t  # new-bar index of each window's end
            ok = (idx >= 0) & (n + idx >= self.min_prior) & hit
            lvl[idx[ok]] = v[idx[ok]]
        return lvl, [float(x) for x in allv[-hist:]]

    def handleInitialState(self, key, initialState, timerValues) -> None:
        r = initialState.iloc[0]
        ema = [float(r[f"ema_{n}"]) for n in self.spans]
        us = int(_micros(pd.Series([r["last_datetime"]]))[0])
        self.state.update((ema, float(r["signal"]), int(r["n_bars"]), us,
                           [float(x) for x in r["tail_high"]], [float(x) for x in r["tail_low"]]))

    def close(self) -> None:
        pass


def warm_state(enriched: DataFrame, spans=tuple(EMA_SPANS) + (LONG_SPAN,),
               tail: int = PIVOT_LEFT + PIVOT_RIGHT) -> DataFrame:
    """End-of-history state per symbol from batch indicators (the handoff)."""
    cols = [f"ema_{n}" for n in spans] + ["signal"]
    st = indicator_state(enriched, cols, tail=tail)
    return st.select("symbol", *cols, F.col("last_datetime").cast("timestamp").alias("last_datetime"),
                     "n_bars", F.transform("tail", lambda x: x["high"]).alias("tail_high"),
                     F.transform("tail", lambda x: x["low"]).alias("tail_low"))


def save_warm_state(state: DataFrame, path: str) -> DataFrame:
    """Write the handoff state to the shared folder and read it back: the
    live query then starts from a plain table, not from the batch lineage."""
    state.write.mode("overwrite").parquet(path)
    return state.sparkSession.read.parquet(path)


def live_indicators(bars_stream: DataFrame, init_state: DataFrame | None = None,
                    processor: IndicatorProcessor | None = None) -> DataFrame:
    """Watermarked streaming bars -> bars with indicators, keyed by symbol.

    Give ``bars_stream`` a watermark on ``datetime``.  Start the result with
    ``sinks.start``, which gives the query the state store it needs.
    """
    import sys

    from pyspark import cloudpickle

    from barsmith.session import ship_package

    spark = bars_stream.sparkSession
    ship_package(spark)
    # the processor class travels by value: some Python runners of the
    # stateful operator (its driver-side initialisation) do not receive the
    # shipped package, and a class pickled by reference would not import
    cloudpickle.register_pickle_by_value(sys.modules["barsmith"])
    proc = processor or IndicatorProcessor()
    src = bars_stream.select("symbol", "datetime", *[F.col(c).cast("double") for c in ("open", "high", "low", "close")],
                             F.col("volume").cast("bigint"))
    init = init_state.groupBy("symbol") if init_state is not None else None
    return src.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=output_schema(proc.spans),
        outputMode="Append", timeMode="EventTime", initialState=init)


def _stored(spark: SparkSession, checkpoint: str, name: str, operator: int) -> DataFrame:
    return spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name).load(checkpoint)


def live_state(spark: SparkSession, checkpoint: str, spans=tuple(EMA_SPANS) + (LONG_SPAN,), operator: int = 0) -> DataFrame:
    """The indicator state of a stopped live query, read from its checkpoint, in the form of ``warm_state``.

    The number of state partitions is fixed for the life of a checkpoint; a query with
    another one starts from this table on a new checkpoint, with ``waiting_bars``
    among its input.  ``operator`` is the place of the live step among the query's stateful steps.
    """
    v = F.col("value")
    return _stored(spark, checkpoint, "indicators", operator).select(
        F.col("key.symbol").alias("symbol"), *[v["ema"][i].alias(f"ema_{n}") for i, n in enumerate(spans)], v["signal"].alias("signal"),
        F.timestamp_micros(v["last_us"]).alias("last_datetime"), v["n"].alias("n_bars"), v["tail_high"].alias("tail_high"), v["tail_low"].alias("tail_low"))


def waiting_bars(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The bars that a stopped live query has taken in but not released, as input for the query that goes on."""
    each = _stored(spark, checkpoint, "waiting", operator).select(
        F.col("key.symbol").alias("symbol"), F.inline(F.arrays_zip(*[F.col("user_map_value")[c].alias(c) for c in ("us", *DECIDES)])))
    at = F.timestamp_add("MICROSECOND", F.col("us"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return each.select("symbol", at.alias("datetime"), "open", "high", "low", "close", "volume")
