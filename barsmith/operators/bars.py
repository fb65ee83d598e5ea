"""Bar-level aggregates: resampling, coverage, newest-N, dedup, state snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions.timefns import floor_time, interval_micros

#: Parts of a symbol that are cut on their own before its newest bars are taken.
SALTS = 32


def resample_ohlcv(ticks: DataFrame, interval: str = "1 minute", key: str = "symbol",
                   time_col: str = "datetime", price: str = "price",
                   tie: str | None = "tick_id", volume: str | None = None) -> DataFrame:
    """Fixed-interval OHLCV bars from ticks.

    open/close are the first/last price by (time, tie); high/low are max/min;
    volume is the tick count, or the sum of ``volume`` when given.  A plain
    hash aggregate with partial (map-side) aggregation: a hot symbol is split
    by bar start, and each mapper ships one partial row per bar.
    """
    order = F.struct(F.col(time_col), F.col(tie)) if tie else F.col(time_col)
    bucket = floor_time(time_col, interval_micros(interval)).alias("datetime")
    vol = F.sum(volume).cast("bigint") if volume else F.count(F.lit(1))
    return (ticks.groupBy(F.col(key).alias("symbol"), bucket)
                 .agg(F.min_by(price, order).alias("open"),
                      F.max(price).alias("high"),
                      F.min(price).alias("low"),
                      F.max_by(price, order).alias("close"),
                      vol.alias("volume")))


def resample_stream(ticks, interval: str = "1 minute", key: str = "symbol",
                    time_col: str = "datetime", price: str = "price",
                    tie: str | None = "tick_id"):
    """``resample_ohlcv`` for a watermarked stream: a tumbling event-time
    window, so append mode emits each bar once its interval has closed.
    ``datetime`` of a bar is the window start; ``event_time`` (the window's
    last instant, ``window_time``) carries the watermark to later stateful
    operators."""
    order = F.struct(F.col(time_col), F.col(tie)) if tie else F.col(time_col)
    return (ticks.groupBy(F.col(key).alias("symbol"), F.window(time_col, interval).alias("_w"))
                 .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"),
                      F.min(price).alias("low"), F.max_by(price, order).alias("close"),
                      F.count(F.lit(1)).alias("volume"))
                 .select("symbol", F.col("_w.start").alias("datetime"), "open", "high", "low",
                         "close", "volume", F.window_time("_w").alias("event_time")))


def coverage(bars: DataFrame, key: str = "symbol", time_col: str = "datetime") -> DataFrame:
    """First and last bar time and bar count per symbol."""
    return bars.groupBy(key).agg(F.min(time_col).alias("first_datetime"),
                                 F.max(time_col).alias("last_datetime"),
                                 F.count(F.lit(1)).alias("n_bars"))


def latest_n_per_symbol(bars: DataFrame, n: int, symbols: list[str] | None = None,
                        key: str = "symbol", time_col: str = "datetime",
                        tie: str | None = None) -> DataFrame:
    """Newest ``n`` bars of each (allowed) symbol, like a supplier's ``outputsize``.

    ``row_number() <= n`` plans as a WindowGroupLimit: each mapper keeps at
    most ``n`` rows per symbol before the shuffle, so a hot symbol ships n rows
    per map task, not its whole history.
    """
    if symbols is not None:
        bars = bars.where(F.col(key).isin(list(symbols)))
    order = [F.col(time_col).desc()] + ([F.col(tie).desc()] if tie else [])
    w = Window.partitionBy(key).orderBy(*order)
    return bars.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def dedup_bars(bars: DataFrame, key: str = "symbol", time_col: str = "datetime",
               prefer: tuple[str, ...] = ("volume", "close", "high", "low", "open")) -> DataFrame:
    """One bar per (symbol, datetime).

    Where fetches differ, the bar with the largest ``prefer`` columns, in their
    order, stays: a bar fetched again after its interval has the larger volume.
    An aggregate with partial aggregation, so copies are removed map-side.
    """
    first = [c for c in prefer if c in bars.columns and c not in (key, time_col)]
    rest = [c for c in bars.columns if c not in (key, time_col, *first)]
    best = F.max(F.struct(*first, *rest)).alias("_b")
    return bars.groupBy(key, time_col).agg(best).select(
        *[F.col(c) if c in (key, time_col) else F.col(f"_b.{c}").alias(c) for c in bars.columns])


def dedup_stream(bars: DataFrame, key: str = "symbol", time_col: str = "datetime") -> DataFrame:
    """The first arrival of each (symbol, datetime) of a watermarked stream.

    An append stream cannot take a bar back, so a later copy never replaces it;
    copies that come after the watermark has passed the bar are late rows.
    """
    return bars.dropDuplicatesWithinWatermark([key, time_col])


def best_of_stream(bars: DataFrame, key: str = "symbol", time_col: str = "datetime",
                   prefer: tuple[str, ...] = ("volume", "close", "high", "low", "open")) -> DataFrame:
    """One bar per (symbol, datetime) of a stream watermarked on its time: the copy that ``dedup_bars`` keeps.

    The time is a grouping column, so append mode holds a bar's best copy in state
    until the watermark has passed it and then emits it once; copies that come later
    are late rows.  ``dedup_stream`` emits at once, but keeps the first arrival.
    """
    return dedup_bars(bars, key, time_col, prefer)


def indicator_state(enriched: DataFrame, cols: list[str], key: str = "symbol",
                    time_col: str = "datetime", tail: int = 0) -> DataFrame:
    """End-of-series snapshot per symbol: the newest value of each column.

    ``max_by`` is an ordinary aggregate (partial + final), so a hot symbol is
    reduced map-side.  With ``tail`` > 0, the newest ``tail`` (high, low) pairs
    are kept too, oldest first, to seed a live level detector: each of ``SALTS``
    parts of a symbol gives its newest ones, and their union is cut again.
    """
    order = F.col(time_col)
    aggs = [F.max_by(c, order).alias(c) for c in cols]
    aggs.append(F.max(time_col).alias("last_datetime"))
    if tail <= 0:
        return enriched.groupBy(key).agg(*aggs)
    out = enriched.groupBy(key).agg(*aggs, F.count(F.lit(1)).alias("n_bars"))
    part = F.pmod(F.xxhash64(time_col), F.lit(SALTS))
    w = Window.partitionBy(key, "_part").orderBy(F.col(time_col).desc())
    newest = (enriched.select(key, time_col, "high", "low").withColumn("_part", part)
                      .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= tail))
    t = newest.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(time_col, "high", "low"))).alias("_t"))
    t = t.select(key, F.transform(F.expr(f"slice(_t, greatest(size(_t) - {tail - 1}, 1), {tail})"),
                                  lambda s: F.struct(s["high"].alias("high"), s["low"].alias("low"))).alias("tail"))
    return out.join(t, key, "left")
