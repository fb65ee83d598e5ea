"""Schemas and fixed values of the bar data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the modelled system for equal results) -------
# Wire message fields, in order; every one travels as text.
WIRE_FIELDS = ["datetime", "open", "high", "low", "close", "volume",
               "ema_12", "ema_16", "ema_30", "ema_200", "macd", "signal",
               "support", "resistance"]
# Served (enriched) bar columns, in order, after the leading ``symbol``.
SERVED_COLUMNS = ["datetime", "open", "high", "low", "close", "volume",
                  "ema_12", "ema_16", "ema_30", "ema_200", "signal", "macd",
                  "support", "resistance", "sma_20"]
# Columns that are never offered as trend lines.
NOT_TRENDS = ["_id", "datetime", "open", "high", "low", "close", "volume",
              "macd", "signal", "support", "resistance"]
# Store names ending like this hold level lists, not bars.
HIDDEN_SUFFIXES = ["supports", "resistances"]
EMA_SPANS = [12, 16, 30]     # MACD uses min and max of these (12 and 30)
LONG_SPAN = 200              # computed apart, never part of MACD
SIGNAL_SPAN = 9
PIVOT_LEFT = 4               # first extreme of a 7-bar slice sits at index 4
PIVOT_RIGHT = 2
MIN_PRIOR = 8                # bars needed before a level may be reported
NONE_OPTION = "none"
# ---------------------------------------------------------------------------

WIRE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in WIRE_FIELDS])

BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

RAW_BAR_STRUCT = T.StructType([T.StructField(f, T.StringType()) for f in
                               ["datetime", "open", "close", "high", "low", "volume"]])
# symbol -> newest-first list of bars, as a data supplier returns it
PAYLOAD_SCHEMA = T.MapType(T.StringType(), T.ArrayType(RAW_BAR_STRUCT))
