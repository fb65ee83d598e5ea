"""Bars -> served, enriched bars (EMAs, MACD, signal, levels, SMA)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barsmith.operators.ema import indicators
from barsmith.operators.sequence import DEFAULT_BUCKET
from barsmith.operators.sma import frame_mean, mean_frame, sma_join, sma_range
from barsmith.schema import SERVED_COLUMNS


def served_columns(df: DataFrame) -> DataFrame:
    """``symbol`` then the 15 served columns, in the served order."""
    return df.select("symbol", *SERVED_COLUMNS)


def enriched_bars(bars: DataFrame, window: str = "20 minutes", slide: str = "1 minute",
                  sma_plan: str = "frame", how: str = "inner",
                  exact_decimals: int | None = None, bucket: str | int = DEFAULT_BUCKET) -> DataFrame:
    """Indicators on every bar (EMA must see all bars) and the mean of the window
    before each, which drops bars with no earlier bar in the window (``inner``).

    ``frame`` takes the means out of the indicators' own layout: one scan and one
    exchange of the bars.  ``window_join`` and ``range`` compute them apart.
    """
    if sma_plan == "frame":
        rows, frame = mean_frame(bars, window, "close", exact_decimals)
        return served_columns(frame_mean(indicators(rows, bucket=bucket, frames=(frame,)), window, slide, how, "datetime", "sma_20", exact_decimals))
    ind = indicators(bars, bucket=bucket)
    if sma_plan == "range":
        out = sma_range(ind, window, how=how, exact_decimals=exact_decimals)
    else:
        out = sma_join(ind, window, slide, how=how, exact_decimals=exact_decimals,
                       means_from=bars)
    return served_columns(out)
