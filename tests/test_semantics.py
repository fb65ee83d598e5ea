"""One test per decided semantic on hand-made bars."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsmith.functions.parse import parse_bars, topic_name
from barsmith.operators.bars import dedup_bars, latest_n_per_symbol, resample_ohlcv
from barsmith.operators.levels import levels, pivot_position
from barsmith.operators.serving import level_feed, level_options, macd_histogram, trend_line
from barsmith.operators.sma import sma_join, sma_range, sma_windows
from barsmith.sources.files import explode_payload, list_symbols
from conftest import minute_bars

T0 = dt.datetime(2024, 1, 2, 9, 30)


def test_sma_gap_drops_first_bar_and_first_after_gap(spark):
    a = minute_bars(spark, "A", T0, [10.0 + i for i in range(30)])
    b = minute_bars(spark, "A", T0 + dt.timedelta(minutes=55), [50.0 + i for i in range(5)])
    bars = a.unionByName(b)
    out = sma_join(bars, "20 minutes", "1 minute").orderBy("datetime").toPandas()
    assert len(out) == 29 + 4
    times = set(out.datetime)
    assert T0 not in times and T0 + dt.timedelta(minutes=55) not in times
    # mean of the 20 bars before, the bar itself excluded
    row = out[out.datetime == T0 + dt.timedelta(minutes=25)].iloc[0]
    closes = [(10.0 + i + 9.0 + i) / 2 for i in range(5, 25)]
    assert row.sma_20 == pytest.approx(sum(closes) / 20)
    rng = sma_range(bars, "20 minutes").orderBy("datetime").toPandas()
    assert list(rng.sma_20.round(9)) == list(out.sma_20.round(9))


def test_off_grid_bar_feeds_means_but_is_not_emitted(spark):
    bars = minute_bars(spark, "A", T0, [10.0, 11.0, 12.0])
    odd = minute_bars(spark, "A", T0 + dt.timedelta(seconds=90), [100.0], [98.0], [99.0])
    out = sma_join(bars.unionByName(odd), "20 minutes", "1 minute").orderBy("datetime").toPandas()
    assert T0 + dt.timedelta(seconds=90) not in set(out.datetime)
    last = out[out.datetime == T0 + dt.timedelta(minutes=2)].iloc[0]
    assert last.sma_20 == pytest.approx((9.5 + 10.5 + 99.0) / 3)
    left = sma_join(bars.unionByName(odd), "20 minutes", "1 minute", how="left")
    assert left.count() == 4 and left.where(F.col("sma_20").isNull()).count() == 2


def test_pivot_first_maximum_rule_and_current_bar_value(spark):
    # index:   0  1  2  3  4  5  6  7  8  9 10
    highs = [1, 1, 1, 1, 1, 1, 2, 3, 9, 9, 8, 7, 7]
    bars = minute_bars(spark, "A", T0, highs)
    out = levels(bars).orderBy("datetime").toPandas()
    # bar 10: slice 4..10 = [1,1,2,3,9,9,8]: tie at 4/5, first max at 4 -> level,
    # reported as the *current* bar's high (8), not the pivot's (9)
    assert out.resistance.iloc[10] == 8.0
    # bar 11: [1,2,3,9,9,8,7]: tie at 3/4 -> first max at 3 -> none
    assert out.resistance.iloc[11] == 0.0 and out.resistance.iloc[12] == 0.0
    assert levels(bars, level_from="pivot").orderBy("datetime").toPandas().resistance.iloc[10] == 9.0
    highs2 = [1, 1, 1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 9, 9, 9]
    out2 = levels(minute_bars(spark, "A", T0, highs2)).orderBy("datetime").toPandas()
    # bar 14: slice 8..14 = [2,3,4,5,9,9,9] -> first max at 4 -> resistance = high[14]
    assert out2.resistance.iloc[14] == 9.0
    assert out2.resistance.iloc[13] == 0.0          # slice [1,2,3,4,5,9,9]: max at 5
    piv = levels(minute_bars(spark, "A", T0, highs2), level_from="pivot").orderBy("datetime")
    assert piv.toPandas().resistance.iloc[14] == 9.0


def test_numeric_not_lexicographic_comparison(spark):
    highs = [50, 50, 50, 50, 50, 50, 50, 50, 99.9, 99.9, 99.9, 99.9, 100.1, 60, 60]
    out = levels(minute_bars(spark, "A", T0, highs)).orderBy("datetime").toPandas()
    assert out.resistance.iloc[14] == 60.0           # 100.1 > 99.9 numerically
    pos = pivot_position(minute_bars(spark, "A", T0, highs)).orderBy("datetime").toPandas()
    assert pos.max_pos.iloc[-1] == 4


def test_min_prior_eligibility(spark):
    highs = [1, 2, 3, 9, 8, 7, 6, 5, 4, 3]
    out = levels(minute_bars(spark, "A", T0, highs)).orderBy("datetime").toPandas()
    assert out.resistance.iloc[5] == 0.0             # pattern at index 5 but only 5 prior bars


def test_interleaved_symbols_keep_separate_state(spark):
    a = minute_bars(spark, "A", T0, [1, 1, 1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 9, 8, 7])
    b = minute_bars(spark, "B", T0, [9] * 15)
    out = levels(a.unionByName(b)).toPandas()
    assert out[out.symbol == "A"].resistance.max() == 7.0
    assert out[out.symbol == "B"].resistance.max() == 0.0


def test_junk_wire_messages_become_nulls(spark):
    rows = [("A", '{"datetime":"2024-01-02 09:30:00","open":"1","high":"2","low":"0.5",'
                  '"close":"1.5","volume":"3000000000"}'),
            ("A", "not json at all"),
            ("A", '{"datetime":"bad","close":"x1","macd":1.25}')]
    df = spark.createDataFrame(rows, "symbol string, value string")
    out = parse_bars(df).toPandas()
    assert len(out) == 3
    assert out.volume.iloc[0] == 3_000_000_000          # beyond 32-bit kept
    assert out.close.isna().iloc[1] and out.datetime.isna().iloc[2]
    assert out.macd.iloc[2] == 1.25                     # numbers accepted in text fields


def test_float_prices_option(spark):
    df = spark.createDataFrame([("A", '{"close":"1.1"}')], "symbol string, value string")
    assert dict(parse_bars(df, price_type="float").dtypes)["close"] == "float"


def test_topic_name_rule(spark):
    df = spark.createDataFrame([("EUR/USD",), ("AAPL",)], "s string")
    assert [r.t for r in df.select(topic_name("s").alias("t")).collect()] == ["eur-usd", "aapl"]


def test_payload_single_and_keyed(spark):
    bare = '[{"datetime":"2024-01-02 09:31:00","open":"1","close":"2","high":"3","low":"0.5","volume":"7"},' \
           '{"datetime":"2024-01-02 09:30:00","open":"1","close":"1","high":"2","low":"0.5","volume":"5"}]'
    one = explode_payload(spark.createDataFrame([(bare,)], "payload string"), symbol="AAPL")
    assert one.count() == 2 and one.select("symbol").distinct().collect()[0][0] == "AAPL"
    keyed = '{"A": ' + bare + ', "B": ' + bare + '}'
    many = explode_payload(spark.createDataFrame([(keyed,)], "payload string"))
    assert many.count() == 4


def test_resample_first_last_by_time_then_tie(spark):
    rows = [("A", dt.datetime(2024, 1, 2, 9, 30, 5), 2, 10.0), ("A", dt.datetime(2024, 1, 2, 9, 30, 5), 1, 11.0),
            ("A", dt.datetime(2024, 1, 2, 9, 30, 50), 3, 9.0), ("A", dt.datetime(2024, 1, 2, 9, 31, 0), 4, 12.0)]
    t = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, tick_id long, price double")
    out = resample_ohlcv(t, "1 minute").orderBy("datetime").toPandas()
    assert list(out.open) == [11.0, 12.0] and list(out.close) == [9.0, 12.0]
    assert list(out.volume) == [3, 1] and out.high.iloc[0] == 11.0 and out.low.iloc[0] == 9.0


def test_overlap_dedup_and_latest_n(spark):
    bars = minute_bars(spark, "A", T0, [float(i) for i in range(10)])
    again = latest_n_per_symbol(bars, 3)
    assert again.count() == 3
    assert dedup_bars(bars.unionByName(again)).count() == 10
    assert latest_n_per_symbol(bars, 3, symbols=["B"]).count() == 0


def test_level_lists_and_feeds(spark):
    df = spark.createDataFrame([("A", T0, 0.0), ("A", T0, 0.0), ("A", T0 + dt.timedelta(minutes=1), 5.0),
                                ("A", T0 + dt.timedelta(minutes=2), 5.0), ("A", T0 + dt.timedelta(minutes=2), 5.0)],
                               "symbol string, datetime timestamp_ntz, support double")
    opts = [r.option for r in level_options(df).orderBy("rank").collect()]
    assert trend_line(df, "none").columns == ["symbol", "datetime", "value"]
    assert opts == ["none", "5.0", "5.0", "5.0"]                 # not deduplicated
    assert level_options(df, distinct=True).count() == 2
    assert level_feed(df).count() == 2                           # (datetime, level) dedup


def test_histogram_side_and_trend_none(spark):
    df = spark.createDataFrame([("A", T0, 1.0, 0.5), ("A", T0, 0.5, 1.0)],
                               "symbol string, datetime timestamp_ntz, macd double, signal double")
    sides = [r.side for r in macd_histogram(df).collect()]
    assert sides == ["up", "down"]
    assert trend_line(df, "none").count() == 0
    assert trend_line(df, "macd").collect()[0].value == 1.0


def test_list_symbols_hides_level_stores(spark):
    df = spark.createDataFrame([("aapl",), ("aapl-supports",), ("aapl-resistances",)], "symbol string")
    assert [r.symbol for r in list_symbols(df).collect()] == ["aapl"]


def test_sma_windows_cover_exclusive_end(spark):
    bars = minute_bars(spark, "A", T0, [10.0, 20.0])
    w = sma_windows(bars, "20 minutes", "1 minute").toPandas()
    assert len(w) == 21                                          # 20 windows per bar, 19 shared
    end = w[w.window_end == T0 + dt.timedelta(minutes=1)].iloc[0]
    assert end.sma_20 == pytest.approx(9.5)


def test_sma_range_equals_the_prefix_scan_and_any_number_of_parts(spark):
    from barsmith.operators.sma import sma_range_scan
    from barsmith.sources import tables
    s = tables.seq(spark, "/root/testdata/sf0.001")
    a = sma_range(s, "20 hours", exact_decimals=2).toPandas()
    for other in (sma_range_scan(s, "20 hours", ("tick_id",), exact_decimals=2), sma_range(s, "20 hours", exact_decimals=2, parts=1),
                  sma_range(s, "20 hours", exact_decimals=2, parts=7)):
        m = a.merge(other.toPandas(), on=["symbol", "tick_id"])
        assert len(a) == len(m) > 0 and (m.sma_20_x == m.sma_20_y).all()        # exact integer sums: equal bits
    assert sma_range(s, "20 hours", how="left").count() == s.count()


def test_sma_range_is_exact_for_large_values_and_an_early_outlier(spark):
    """Only sums within the window count: neither a long series nor an outlier before it shifts a mean."""
    n = 600
    rows = [("A", T0 + dt.timedelta(minutes=3 * i), 9.0e11 + 0.01 * i if i else 1.0e13, i) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, close double, tick_id long")
    got = {r.tick_id: r.sma_20 for r in sma_range(df, "20 minutes", exact_decimals=2).collect()}
    cents = [round(r[2] * 100.0) for r in rows]
    for i in range(8, n):
        part = cents[max(0, i - 6):i]
        assert got[i] == sum(part) / len(part) / 100.0
    assert 0 not in got


def test_null_symbols_and_times_are_left_out(spark):
    from barsmith.operators.levels import pivot_position, trailing_extremes
    bars = minute_bars(spark, "A", T0, [float(k) for k in range(12)])
    odd = bars.limit(2).withColumn("symbol", F.lit(None).cast("string")).unionByName(bars.limit(1).withColumn("datetime", F.lit(None).cast("timestamp_ntz")))
    assert trailing_extremes(bars.unionByName(odd)).count() == 12
    assert pivot_position(bars.unionByName(odd)).count() == 6


def test_the_fuller_bar_stays_and_scan_bounds_go_together(spark, tmp_path):
    from barsmith.sources.files import scan, write_serving
    bars = minute_bars(spark, "A", T0, [5.0, 6.0, 7.0])
    early = bars.withColumn("volume", F.lit(3).cast(bars.schema["volume"].dataType)).withColumn("close", F.lit(99.0))
    assert sorted(dedup_bars(early.unionByName(bars)).collect()) == sorted(bars.collect())
    write_serving(bars, str(tmp_path / "store"), mode="overwrite")
    assert sorted(scan(spark, str(tmp_path / "store")).select(*bars.columns).collect()) == sorted(bars.collect())
    with pytest.raises(ValueError, match="together"):
        scan(spark, str(tmp_path / "store"), days=3)


def test_scan_orders(spark):
    from barsmith.operators.serving import range_scan
    bars = minute_bars(spark, "A", T0, [float(k) for k in range(9)])
    end = T0 + dt.timedelta(days=1)
    up = [r.datetime for r in range_scan(bars, end, 5).collect()]
    down = [r.datetime for r in range_scan(bars, end, 5, descending=True).collect()]
    assert up == sorted(up) and down == up[::-1] and len(up) == 9


def test_load_bars_allow_list_and_newest_n_from_files(spark, tmp_path):
    from barsmith.sources.files import load_bars
    bars = minute_bars(spark, "A", T0, [float(i) for i in range(10)]).unionByName(
        minute_bars(spark, "B", T0, [float(i) for i in range(4)]))
    bars.write.parquet(str(tmp_path / "pq"))
    bars.write.json(str(tmp_path / "js"))
    got = load_bars(spark, str(tmp_path / "pq"), symbols=["A"], output_size=3).toPandas()
    assert list(got.symbol.unique()) == ["A"] and len(got) == 3
    assert got.datetime.min() == T0 + dt.timedelta(minutes=7)          # newest three
    js = load_bars(spark, str(tmp_path / "js"), output_size=2, fmt="json")
    assert js.count() == 4 and dict(js.dtypes)["close"] == "double"


def test_wall_times_do_not_depend_on_the_session_zone(spark):
    """02:30 on the day clocks go forward stays 02:30; what is no time becomes null."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [("A", '{"datetime": "2024-03-10 02:30:00", "close": "1.5"}'), ("B", '{"datetime": "soon"}')]
        got = {r.symbol: r.datetime for r in parse_bars(spark.createDataFrame(rows, "symbol string, value string"), "value").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {"A": dt.datetime(2024, 3, 10, 2, 30), "B": None}


def test_symbols_that_look_like_numbers_stay_text(spark, tmp_path):
    from barsmith.sources.files import list_symbols, read_store, scan, write_serving
    from conftest import minute_bars
    start = dt.datetime(2024, 1, 5, 10)
    bars = minute_bars(spark, "0700", start, [5, 6, 7]).unionByName(minute_bars(spark, "0005", start, [8])).unionByName(minute_bars(spark, "2024-01-01", start, [9]))
    write_serving(bars, str(tmp_path / "store"), mode="overwrite")
    got = scan(spark, str(tmp_path / "store"))
    assert dict(got.dtypes)["symbol"] == "string"
    assert sorted(r.symbol for r in list_symbols(got).collect()) == ["0005", "0700", "2024-01-01"]
    assert sorted(got.select(*bars.columns).collect()) == sorted(bars.collect())
    assert scan(spark, str(tmp_path / "store"), "0700", dt.datetime(2024, 1, 6), 2).count() == 3
    assert dict(read_store(spark, str(tmp_path / "store")).dtypes)["date"] == "date"


def test_incomplete_bars_are_refused_or_dropped_when_published(spark):
    from barsmith.sources.kafka import encode_for_kafka
    bars = minute_bars(spark, "A", dt.datetime(2024, 1, 5, 10), [5, 6, 7]).withColumn("close", F.when(F.col("high") != 6, F.col("close")))
    assert [r.value.count('"close"') for r in encode_for_kafka(bars).collect()] == [1, 0, 1]
    assert encode_for_kafka(bars, "drop").count() == 2
    assert encode_for_kafka(bars.where("close is not null"), "error").count() == 2
    with pytest.raises(Exception, match="a bar of A lacks a field"):
        encode_for_kafka(bars, "error").collect()
    with pytest.raises(ValueError):
        encode_for_kafka(bars, "ignore")


def test_topics_become_symbols(spark):
    """Rows as the Kafka source gives them: bytes, a topic each; junk becomes a row of nulls."""
    from barsmith.sources.kafka import decode_kafka, encode_for_kafka
    bars = minute_bars(spark, "EUR/USD", dt.datetime(2024, 1, 5, 10), [5, 6]).unionByName(minute_bars(spark, "0700", dt.datetime(2024, 1, 5, 10), [7]))
    raw = encode_for_kafka(bars).select("topic", F.col("value").cast("binary").alias("value"))
    raw = raw.unionByName(spark.createDataFrame([("0700", bytearray(b"{junk"))], "topic string, value binary"))
    got = sorted((r.symbol, str(r.datetime), r.close, r.volume) for r in decode_kafka(raw).collect())
    want = [(r.symbol.lower().replace("/", "-"), str(r.datetime), r.close, r.volume) for r in bars.collect()] + [("0700", "None", None, None)]
    assert got == sorted(want, key=lambda r: (r[0], r[1]))
