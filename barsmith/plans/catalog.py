"""Named queries over the input tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads whole tables.  Computed doubles are rounded to 6 places so
results compare by value with the SQL oracle (``barsmith.plans.oracle``).
Bars come from ``events`` resampled to one hour, so the reference's minute
scale becomes hours: a 20-minute mean is a 20-hour mean here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.parse import parse_bars, topic_name
from barsmith.functions.timefns import in_session
from barsmith.operators import bars as B
from barsmith.operators.ema import ema, indicators, macd
from barsmith.operators.levels import levels, pivot_position, trailing_extremes
from barsmith.operators.serving import (candles, default_symbol, level_feed, level_options,
                                        macd_histogram, range_scan, trend_line)
from barsmith.operators.sma import sma_join, sma_range, sma_range_scan, sma_windows
from barsmith.plans.enriched import enriched_bars, served_columns
from barsmith.session import scratch_path
from barsmith.sources import tables
from barsmith.sources.files import explode_payload, list_symbols, trend_columns
from barsmith.sources.kafka import encode_for_kafka

# --- fixed query parameters (scaled: 1 minute -> 1 hour) --------------------
WINDOW = "20 hours"
SLIDE = "1 hour"
AS_OF = "2024-01-20 00:00:00"
LATEST_N = 100
ALLOWED = ["click", "view", "no such symbol"]
SYMBOL = "purchase"
PRICE_DECIMALS = 2          # input prices are cents: means are exact
ORDERS_BUCKET = "3650 days"  # a customer's orders: some rows in years
# ----------------------------------------------------------------------------

BAR_COLS = ["symbol", "datetime", "open", "high", "low", "close", "volume"]
IND_COLS = ["ema_12", "ema_16", "ema_30", "ema_200", "signal", "macd"]


def r6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols if c in df.columns})


def _bars(spark, sf):
    return tables.bars_1h(spark, sf)


def _enriched(spark, sf):
    return enriched_bars(_bars(spark, sf), WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS)


_STORES: dict[tuple[str, str], str] = {}


def _store(spark, sf) -> str:
    """Path of the serving store of the enriched bars, written once in a session."""
    from barsmith.sources.files import write_serving
    at = (spark.sparkContext.applicationId, sf)
    if at not in _STORES:
        path = scratch_path(spark, "store")
        write_serving(_enriched(spark, sf), path, mode="overwrite")
        _STORES[at] = path
    return _STORES[at]


def _stored(spark, sf, days: float | None = None, symbol: str | None = None):
    """The served bars as the read side gets them: from the store."""
    from barsmith.sources.files import scan
    return served_columns(scan(spark, _store(spark, sf), symbol, AS_OF if days else None, days))


# --- bars and sources --------------------------------------------------------

def q_resample_ohlcv(spark, sf):
    return _bars(spark, sf)


def q_coverage(spark, sf):
    return B.coverage(_bars(spark, sf))


def q_latest_n_per_symbol(spark, sf):
    return B.latest_n_per_symbol(_bars(spark, sf), LATEST_N)


def q_allowed_latest(spark, sf):
    """Newest bars of the allowed symbols only."""
    return B.latest_n_per_symbol(_bars(spark, sf), LATEST_N, symbols=ALLOWED)


def q_payload_explode(spark, sf):
    """Supplier payloads (one JSON document per symbol and day, newest bar
    first) built from the bars, then normalised back to bar rows."""
    b = _bars(spark, sf)
    day = F.to_date("datetime")
    s = F.struct(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                 *[F.col(c).cast("string").alias(c) for c in ("open", "close", "high", "low", "volume")])
    docs = (b.groupBy("symbol", day.alias("day"))
             .agg(F.reverse(F.sort_array(F.collect_list(s))).alias("bars"))
             .select(F.to_json(F.create_map(F.col("symbol"), F.col("bars"))).alias("payload")))
    return explode_payload(docs, "payload").select(*BAR_COLS)


def q_wire_encode(spark, sf):
    enc = encode_for_kafka(_bars(spark, sf))
    v = F.col("value")
    return enc.select(
        "topic", F.col("key").alias("symbol"),
        F.get_json_object(v, "$.datetime").alias("datetime_text"),
        F.get_json_object(v, "$.open").cast("double").alias("open"),
        F.get_json_object(v, "$.close").cast("double").alias("close"),
        F.get_json_object(v, "$.volume").cast("bigint").alias("volume"))


def q_wire_roundtrip(spark, sf):
    enc = encode_for_kafka(_bars(spark, sf)).select(F.col("key").alias("symbol"), "value")
    return parse_bars(enc, "value").select(*BAR_COLS)


def q_props_json(spark, sf):
    ev = tables.table(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def q_topic_names(spark, sf):
    p = tables.table(spark, sf, "part")
    return p.select("p_partkey", topic_name("p_type").alias("topic"))


def q_list_symbols(spark, sf):
    return list_symbols(_stored(spark, sf))


def q_default_symbol(spark, sf):
    return default_symbol(list_symbols(_stored(spark, sf)))


def q_trend_columns(spark, sf):
    return trend_columns(_stored(spark, sf))


# --- sequence operators ------------------------------------------------------

def q_ema_multi(spark, sf):
    out = ema(tables.seq(spark, sf), "close", [12, 16, 30, 200], tie="tick_id")
    return r6(out.select("symbol", "tick_id", "datetime", "close",
                         "ema_12", "ema_16", "ema_30", "ema_200"),
              ["ema_12", "ema_16", "ema_30", "ema_200"])


def q_ema_orders(spark, sf):
    out = ema(tables.short_series(spark, sf), "close", [12, 30], tie="tick_id", bucket=ORDERS_BUCKET)
    # totals are ~1e5: keep ~9 significant digits
    return out.select("symbol", "tick_id", *[F.round(c, 3).alias(c) for c in ("ema_12", "ema_30")])


def q_macd(spark, sf):
    out = macd(_bars(spark, sf), "close")
    return r6(out.select("symbol", "datetime", "ema_12", "ema_30", "macd", "signal"),
              ["ema_12", "ema_30", "macd", "signal"])


def q_levels(spark, sf):
    return levels(_bars(spark, sf)).select("symbol", "datetime", "high", "low",
                                           "support", "resistance")


def q_trailing_extremes(spark, sf):
    return trailing_extremes(_bars(spark, sf)).select("symbol", "datetime", "rn",
                                                      "max_high", "min_low")


def q_pivot_position(spark, sf):
    return pivot_position(_bars(spark, sf)).select("symbol", "datetime", "max_pos", "min_pos")


def q_sma_range(spark, sf):
    """Time-range mean over raw events (any timestamp, not a grid)."""
    s = tables.seq(spark, sf)
    out = sma_range(s, WINDOW, exact_decimals=PRICE_DECIMALS)
    return out.select("symbol", "tick_id", "datetime", "sma_20")


def q_sma_range_scan(spark, sf):
    """Same means by the as-of prefix scan over whole series."""
    s = tables.seq(spark, sf)
    out = sma_range_scan(s, WINDOW, tie=("tick_id",), exact_decimals=PRICE_DECIMALS)
    return out.select("symbol", "tick_id", "datetime", "sma_20")


def q_sma_range_bars(spark, sf):
    out = sma_range(_bars(spark, sf), WINDOW, exact_decimals=PRICE_DECIMALS)
    return out.select("symbol", "datetime", "sma_20")


def q_sma_windows(spark, sf):
    return sma_windows(_bars(spark, sf), WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS)


def q_sma_window_join(spark, sf):
    out = sma_join(_bars(spark, sf), WINDOW, SLIDE, exact_decimals=PRICE_DECIMALS)
    return out.select("symbol", "datetime", "sma_20")


def q_enriched_bars(spark, sf):
    return r6(_enriched(spark, sf), IND_COLS)


def q_warm_start(spark, sf):
    """Newest 2000 one-minute bars per symbol, enriched for the warm start."""
    from barsmith.plans.warm import warm_start
    bars_1m = B.resample_ohlcv(tables.ticks(spark, sf), "1 minute")
    ind, _, _ = warm_start(bars_1m, 2000)
    out = ind.select("symbol", "datetime", "ema_12", "ema_16", "ema_30", "ema_200", "macd",
                     "signal", "support", "resistance")
    return r6(out, ["ema_12", "ema_16", "ema_30", "ema_200", "macd", "signal"])


def q_indicator_state(spark, sf):
    ind = indicators(_bars(spark, sf), levels=False)
    st = B.indicator_state(ind, ["ema_12", "ema_16", "ema_30", "ema_200", "signal"])
    return r6(st, ["ema_12", "ema_16", "ema_30", "ema_200", "signal"])


# --- serving -----------------------------------------------------------------

def q_range_scan(spark, sf):
    """The read path: enriched bars appended to the serving store (one folder
    per symbol and day), then scanned with the bound on both."""
    return r6(range_scan(_stored(spark, sf, 5), AS_OF, 5), IND_COLS)


def q_symbol_scan(spark, sf):
    """The same for one symbol: one folder of symbols is read."""
    return r6(range_scan(_stored(spark, sf, 5, SYMBOL), AS_OF, 5, SYMBOL, descending=True), IND_COLS)


def q_candles(spark, sf):
    return candles(range_scan(_stored(spark, sf, 5), AS_OF, 5))


def q_trend_line(spark, sf):
    return trend_line(range_scan(_stored(spark, sf, 5), AS_OF, 5), "ema_12")


def q_macd_hist(spark, sf):
    h = macd_histogram(range_scan(_stored(spark, sf, 3), AS_OF, 3, descending=True))
    return r6(h, ["macd", "signal", "hist"])


def q_level_options(spark, sf):
    o = level_options(range_scan(_stored(spark, sf, 5), AS_OF, 5), "support")
    return o


def q_resistance_options(spark, sf):
    o = level_options(range_scan(_stored(spark, sf, 5), AS_OF, 5), "resistance", distinct=True)
    return o


def q_level_feed(spark, sf):
    return level_feed(range_scan(_stored(spark, sf, 5), AS_OF, 5), "support")


def q_resistance_feed(spark, sf):
    return level_feed(range_scan(_stored(spark, sf, 5), AS_OF, 5), "resistance")


def q_session_filter(spark, sf):
    return _bars(spark, sf).where(in_session("datetime")).select("symbol", "datetime", "close")


def q_dedup_bars(spark, sf):
    """Warm history plus an earlier fetch of its newest bars, then unfinished."""
    b = _bars(spark, sf)
    # the first fetch saw the newest bars unfinished: less volume, another close
    overlap = B.latest_n_per_symbol(b, 5).withColumns({"volume": F.col("volume") - 1, "close": F.col("close") + 1})
    return B.dedup_bars(b.unionByName(overlap)).select(*BAR_COLS)


def q_sink_roundtrip(spark, sf):
    from barsmith.sources.files import scan, write_serving
    path = scratch_path(spark, "serving")
    write_serving(_bars(spark, sf), path, mode="overwrite")
    return scan(spark, path).select(*BAR_COLS)


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from barsmith.streaming import queries as sq
    out = {name[2:]: fn for name, fn in globals().items()
           if name.startswith("q_") and callable(fn)}
    out.update(sq.catalog())
    return out
