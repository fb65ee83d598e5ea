"""Warm start: newest history -> indicators -> wire messages + handoff state.

The batch half of the live flow: load the newest ``n`` bars of each symbol,
enrich them, publish them as wire messages, and hand the end-of-history
state (EMAs, signal, bar count, last highs/lows) to the live processor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from barsmith.operators.bars import latest_n_per_symbol
from barsmith.operators.ema import indicators
from barsmith.sources.kafka import encode_for_kafka

WARM_BARS = 2000        # newest bars per symbol loaded at warm start


def warm_start(bars: DataFrame, n: int = WARM_BARS,
               symbols: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (enriched history, wire rows to publish, handoff state)."""
    from barsmith.streaming.live import warm_state

    hist = latest_n_per_symbol(bars, n, symbols)
    ind = indicators(hist)
    return ind, encode_for_kafka(ind), warm_state(ind)
