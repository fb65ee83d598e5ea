"""DuckDB SQL for every catalog query (the correctness oracle).

Written independently of the Spark plans: recursions are recursive CTEs over a
row number, windows are plain SQL windows.  Views ``events``, ``orders``,
``part`` ... are registered by the caller.
"""

from __future__ import annotations

# --- fixed query parameters: keep equal to barsmith.plans.catalog ------------
WINDOW_US = 20 * 3600 * 1_000_000     # 20 hours
AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"
WARM_CUTOFF = "TIMESTAMP '2024-01-20 00:00:00'"
# -----------------------------------------------------------------------------

BARS = """bars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS datetime,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, count(*)::BIGINT AS volume
  FROM events
  WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL
  GROUP BY 1, 2)"""

SEQ = """seqsrc AS (
  SELECT event_type AS symbol, ts AS datetime, event_id AS tick_id, value AS close
  FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL)"""

SHORT = """seqsrc AS (
  SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderdate AS datetime, o_orderkey AS tick_id,
         o_totalprice AS close
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL)"""


def _a(n: int) -> str:
    return f"(2.0::DOUBLE / {n + 1})"


def ema_ctes(src: str, spans: list[int], order: str, signal: tuple[int, int, int] | None = None,
             name: str = "ind") -> str:
    """``{name}``: every row of ``src`` with ``ema_N`` columns (and optionally
    macd/signal from spans (short, long, signal_span)), by recursion on rn."""
    seed = ", ".join(f"close AS ema_{n}" for n in spans)
    step = ", ".join(f"{_a(n)} * s.close + (1 - {_a(n)}) * r.ema_{n} AS ema_{n}" for n in spans)
    if signal:
        sh, lo, sg = signal
        seed += ", 0.0::DOUBLE AS signal"
        m = (f"(({_a(sh)} * s.close + (1 - {_a(sh)}) * r.ema_{sh}) - "
             f"({_a(lo)} * s.close + (1 - {_a(lo)}) * r.ema_{lo}))")
        step += f", {_a(sg)} * {m} + (1 - {_a(sg)}) * r.signal AS signal"
    extra = f", ema_{signal[0]} - ema_{signal[1]} AS macd" if signal else ""
    return f"""{name}_rn AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) - 1 AS rn FROM {src}),
{name}_rec AS (
  SELECT symbol, rn, {seed} FROM {name}_rn WHERE rn = 0
  UNION ALL
  SELECT s.symbol, s.rn, {step}
  FROM {name}_rec r JOIN {name}_rn s ON s.symbol = r.symbol AND s.rn = r.rn + 1),
{name} AS (
  SELECT s.*, {', '.join(f'r.ema_{n}' for n in spans)}{', r.signal' if signal else ''}{extra}
  FROM {name}_rn s JOIN {name}_rec r USING (symbol, rn))"""


def levels_cte(src: str, name: str = "lv") -> str:
    lags = ", ".join([f"lag(high, {k}) OVER w AS h{k}" for k in range(1, 7)] +
                     [f"lag(low, {k}) OVER w AS l{k}" for k in range(1, 7)])
    res = " AND ".join([f"h2 > h{k}" for k in (3, 4, 5, 6)] + ["h2 >= h1", "h2 >= high"])
    sup = " AND ".join([f"l2 < l{k}" for k in (3, 4, 5, 6)] + ["l2 <= l1", "l2 <= low"])
    return f"""{name}_l AS (
  SELECT *, row_number() OVER w - 1 AS lrn, {lags}
  FROM {src} WINDOW w AS (PARTITION BY symbol ORDER BY datetime)),
{name} AS (
  SELECT *, CASE WHEN lrn >= 8 AND {sup} THEN low ELSE 0.0 END AS support,
            CASE WHEN lrn >= 8 AND {res} THEN high ELSE 0.0 END AS resistance
  FROM {name}_l)"""


def sma_cte(src: str, name: str = "sm") -> str:
    """Mean of close over [t - 20 h, t); prices are cents, summed as integers."""
    return f"""{name}_all AS (
  SELECT *, (sum(round(close * 100.0)::BIGINT) OVER w / count(close) OVER w) / 100.0 AS sma_20,
         count(close) OVER w AS sma_n
  FROM {src}
  WINDOW w AS (PARTITION BY symbol ORDER BY epoch_us(datetime)
               RANGE BETWEEN {WINDOW_US} PRECEDING AND 1 PRECEDING)),
{name} AS (SELECT * FROM {name}_all WHERE sma_n > 0)"""


ENRICHED = ",\n".join([
    BARS,
    ema_ctes("bars", [12, 16, 30, 200], "datetime", (12, 30, 9)),
    levels_cte("ind"),
    sma_cte("lv"),
    """enriched_raw AS (
  SELECT symbol, datetime, open, high, low, close, volume, ema_12, ema_16, ema_30, ema_200,
         signal, macd, support, resistance, sma_20 FROM sm)""",
    """enriched AS (
  SELECT symbol, datetime, open, high, low, close, volume,
         round(ema_12, 6) AS ema_12, round(ema_16, 6) AS ema_16, round(ema_30, 6) AS ema_30,
         round(ema_200, 6) AS ema_200, round(signal, 6) AS signal, round(macd, 6) AS macd,
         support, resistance, sma_20
  FROM sm)"""])


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _scan(days: int) -> str:
    return (f"scanned AS (SELECT * FROM enriched_raw WHERE datetime > {AS_OF} - INTERVAL {days} DAY "
            f"AND datetime < {AS_OF})")


_ROUNDED = """symbol, datetime, open, high, low, close, volume,
  round(ema_12, 6) AS ema_12, round(ema_16, 6) AS ema_16, round(ema_30, 6) AS ema_30,
  round(ema_200, 6) AS ema_200, round(signal, 6) AS signal, round(macd, 6) AS macd,
  support, resistance, sma_20"""


def _wm() -> str:
    return "(SELECT max(datetime) FROM bars) - INTERVAL 2 SECOND"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    bars_only = _with(BARS)
    q["resample_ohlcv"] = bars_only + "SELECT * FROM bars"
    q["coverage"] = bars_only + """SELECT symbol, min(datetime) AS first_datetime,
  max(datetime) AS last_datetime, count(*)::BIGINT AS n_bars FROM bars GROUP BY symbol"""
    q["latest_n_per_symbol"] = bars_only + """SELECT * FROM bars
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 100"""
    q["allowed_latest"] = bars_only + """SELECT * FROM bars WHERE symbol IN ('click', 'view')
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 100"""
    q["payload_explode"] = bars_only + "SELECT * FROM bars"
    q["wire_encode"] = bars_only + """SELECT replace(lower(symbol), '/', '-') AS topic, symbol,
  strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime_text, open, close, volume FROM bars"""
    q["wire_roundtrip"] = bars_only + "SELECT * FROM bars"
    q["props_json"] = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events"""
    q["topic_names"] = "SELECT p_partkey, replace(lower(p_type), '/', '-') AS topic FROM part"
    q["list_symbols"] = bars_only + """SELECT DISTINCT symbol FROM bars
  WHERE NOT ends_with(symbol, 'supports') AND NOT ends_with(symbol, 'resistances')"""
    q["default_symbol"] = bars_only + """SELECT min(symbol) AS symbol FROM bars
  WHERE NOT ends_with(symbol, 'supports') AND NOT ends_with(symbol, 'resistances')"""
    trends = ["ema_12", "ema_16", "ema_30", "ema_200", "sma_20"]
    q["trend_columns"] = _with(ENRICHED) + " UNION ALL ".join(
        f"SELECT '{c}' AS trend, {i} AS pos FROM enriched HAVING count({c}) > 0" for i, c in enumerate(trends)) + \
        f" UNION ALL SELECT 'none' AS trend, {len(trends)} AS pos"

    q["ema_multi"] = _with(SEQ, ema_ctes("seqsrc", [12, 16, 30, 200], "datetime, tick_id")) + """
SELECT symbol, tick_id, datetime, close, round(ema_12, 6) AS ema_12, round(ema_16, 6) AS ema_16,
       round(ema_30, 6) AS ema_30, round(ema_200, 6) AS ema_200 FROM ind"""
    q["ema_orders"] = _with(SHORT, ema_ctes("seqsrc", [12, 30], "datetime, tick_id")) + """
SELECT symbol, tick_id, round(ema_12, 3) AS ema_12, round(ema_30, 3) AS ema_30 FROM ind"""
    q["macd"] = _with(BARS, ema_ctes("bars", [12, 16, 30], "datetime", (12, 30, 9))) + """
SELECT symbol, datetime, round(ema_12, 6) AS ema_12, round(ema_30, 6) AS ema_30,
       round(macd, 6) AS macd, round(signal, 6) AS signal FROM ind"""
    q["levels"] = _with(BARS, levels_cte("bars")) + \
        "SELECT symbol, datetime, high, low, support, resistance FROM lv"
    q["trailing_extremes"] = bars_only + """SELECT symbol, datetime,
  row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS rn,
  max(high) OVER w AS max_high, min(low) OVER w AS min_low
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
    q["pivot_position"] = bars_only + """SELECT symbol, datetime,
  list_position(hs, list_max(hs)) - 1 AS max_pos, list_position(ls, list_min(ls)) - 1 AS min_pos
FROM (SELECT symbol, datetime, row_number() OVER w0 - 1 AS rn, list(high) OVER w AS hs, list(low) OVER w AS ls
      FROM bars WINDOW w0 AS (PARTITION BY symbol ORDER BY datetime),
                      w AS (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
WHERE rn >= 6"""
    q["sma_range"] = _with(SEQ, sma_cte("seqsrc")) + \
        "SELECT symbol, tick_id, datetime, sma_20 FROM sm"
    q["sma_range_scan"] = q["sma_range"]
    q["sma_range_bars"] = _with(BARS, sma_cte("bars")) + \
        "SELECT symbol, datetime, sma_20 FROM sm"
    q["sma_windows"] = bars_only + """SELECT symbol, window_start, window_end, (sum(round(close * 100.0)::BIGINT) / count(close)) / 100.0 AS sma_20
FROM (SELECT symbol, close, datetime - k * INTERVAL 1 HOUR AS window_start,
             datetime - k * INTERVAL 1 HOUR + INTERVAL 20 HOUR AS window_end
      FROM bars, range(0, 20) r(k))
GROUP BY 1, 2, 3"""
    q["sma_window_join"] = _with(BARS, sma_cte("bars")) + \
        "SELECT symbol, datetime, sma_20 FROM sm"
    q["enriched_bars"] = _with(ENRICHED) + "SELECT * FROM enriched"
    q["indicator_state"] = _with(BARS, ema_ctes("bars", [12, 16, 30, 200], "datetime", (12, 30, 9))) + """
SELECT symbol, round(arg_max(ema_12, datetime), 6) AS ema_12, round(arg_max(ema_16, datetime), 6) AS ema_16,
       round(arg_max(ema_30, datetime), 6) AS ema_30, round(arg_max(ema_200, datetime), 6) AS ema_200,
       round(arg_max(signal, datetime), 6) AS signal, max(datetime) AS last_datetime
FROM ind GROUP BY symbol"""

    q["range_scan"] = _with(ENRICHED, _scan(5)) + f"SELECT {_ROUNDED} FROM scanned"
    q["symbol_scan"] = q["range_scan"] + " WHERE symbol = 'purchase'"
    q["candles"] = _with(ENRICHED, _scan(5)) + \
        "SELECT symbol, datetime, open, high, low, close FROM scanned"
    q["trend_line"] = _with(ENRICHED, _scan(5)) + \
        "SELECT symbol, datetime, round(ema_12, 2) AS value FROM scanned"
    q["macd_hist"] = _with(ENRICHED, _scan(3)) + """SELECT symbol, datetime, round(macd, 6) AS macd,
  round(signal, 6) AS signal, round(macd - signal, 6) AS hist,
  CASE WHEN macd - signal >= 0 THEN 'up' ELSE 'down' END AS side FROM scanned"""
    q["level_options"] = _with(ENRICHED, _scan(5)) + """
SELECT symbol, 'none' AS option, 0::INTEGER AS rank FROM (SELECT DISTINCT symbol FROM scanned)
UNION ALL SELECT symbol, CAST(support AS VARCHAR) AS option, row_number() OVER (PARTITION BY symbol ORDER BY support)::INTEGER AS rank
FROM scanned WHERE support <> 0"""
    q["resistance_options"] = _with(ENRICHED, _scan(5)) + """
SELECT symbol, 'none' AS option, 0::INTEGER AS rank FROM (SELECT DISTINCT symbol FROM scanned)
UNION ALL SELECT symbol, CAST(v AS VARCHAR) AS option, row_number() OVER (PARTITION BY symbol ORDER BY v)::INTEGER AS rank
FROM (SELECT DISTINCT symbol, resistance AS v FROM scanned WHERE resistance <> 0)"""
    q["level_feed"] = _with(ENRICHED, _scan(5)) + \
        "SELECT DISTINCT symbol, datetime, support FROM scanned WHERE support <> 0"
    q["resistance_feed"] = _with(ENRICHED, _scan(5)) + \
        "SELECT DISTINCT symbol, datetime, resistance FROM scanned WHERE resistance <> 0"
    q["session_filter"] = bars_only + """SELECT symbol, datetime, close FROM bars
WHERE isodow(datetime) <= 5 AND hour(datetime) * 60 + minute(datetime) >= 570
  AND hour(datetime) * 60 + minute(datetime) < 960"""
    q["dedup_bars"] = bars_only + """SELECT DISTINCT * FROM (
  SELECT * FROM bars UNION ALL
  SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 5)"""
    q["sink_roundtrip"] = bars_only + "SELECT * FROM bars"

    # streaming twins: append output stops at the watermark (max time - 2 s)
    q["stream_sma_windows"] = bars_only + f"""SELECT * FROM (
  SELECT symbol, window_start, window_end, (sum(round(close * 100.0)::BIGINT) / count(close)) / 100.0 AS sma_20
  FROM (SELECT symbol, close, datetime - k * INTERVAL 1 HOUR AS window_start,
               datetime - k * INTERVAL 1 HOUR + INTERVAL 20 HOUR AS window_end
        FROM bars, range(0, 20) r(k))
  GROUP BY 1, 2, 3) WHERE window_end <= {_wm()}"""
    q["stream_sma"] = _with(BARS, sma_cte("bars")) + f"""SELECT symbol, datetime, close,
  sma_20 FROM sm WHERE datetime <= {_wm()}"""
    q["stream_fan_out"] = q["stream_sma"]
    q["stream_sma_late"] = q["stream_sma"]
    q["stream_sma_raw"] = _with(BARS, sma_cte("bars")) + """SELECT symbol, datetime, close,
  sma_20 FROM sm
WHERE datetime + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 SECOND"""
    q["stream_sma_panes"] = q["stream_sma_raw"]
    q["stream_enriched"] = _with(ENRICHED) + f"""SELECT * FROM enriched WHERE datetime <= {_wm()}"""
    q["stream_live_enriched"] = q["stream_enriched"]
    live = """SELECT symbol, datetime, round(ema_12, 6) AS ema_12, round(ema_16, 6) AS ema_16,
  round(ema_30, 6) AS ema_30, round(ema_200, 6) AS ema_200, round(macd, 6) AS macd,
  round(signal, 6) AS signal, support, resistance FROM lv"""
    ind_lv = _with(BARS, ema_ctes("bars", [12, 16, 30, 200], "datetime", (12, 30, 9)),
                   levels_cte("ind"))
    q["stream_indicators"] = ind_lv + live
    q["stream_warm_start"] = ind_lv + live + f" WHERE datetime >= {WARM_CUTOFF}"
    q["stream_dedup"] = bars_only + "SELECT * FROM bars"
    # of two copies the one with the larger volume stays
    q["stream_dedup_best"] = bars_only + """SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, datetime ORDER BY volume DESC) AS rn
  FROM (SELECT * FROM bars UNION ALL SELECT * REPLACE (close + 1 AS close, volume - 1 AS volume) FROM bars))
WHERE rn = 1"""
    bars_1m = BARS.replace("bars AS (", "bars1m AS (").replace("date_trunc('hour', ts)",
                                                              "date_trunc('minute', ts)")
    hist = """hist AS (SELECT * FROM bars1m
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 2000)"""
    q["warm_start"] = _with(bars_1m, hist, ema_ctes("hist", [12, 16, 30, 200], "datetime", (12, 30, 9)),
                            levels_cte("ind")) + live
    return q
