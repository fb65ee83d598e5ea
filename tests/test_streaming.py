"""Streaming equals batch: watermark tail, micro-batch splits, warm start, restart."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.operators.ema import indicators
from barsmith.operators.sma import sma_join
from barsmith.schema import BAR_SCHEMA
from barsmith.sources.kafka import encode_for_kafka, kafka_reader_options
from barsmith.streaming.live import live_indicators, save_warm_state, warm_state
from barsmith.sources.files import read_store
from barsmith.streaming.sinks import dropped_by_watermark, fan_out, parquet_batch_sink, run, start
from barsmith.streaming.sources import bar_file_stream, heartbeat, wall_time
from conftest import minute_bars

T0 = dt.datetime(2024, 1, 2, 9, 30)
COLS = ["symbol", "datetime", "open", "high", "low", "close", "volume"]


def rand_bars(spark, symbol, n, seed, start=T0):
    rng = np.random.default_rng(seed)
    highs = (100 + rng.normal(0, 1, n).cumsum()).round(2)
    lows = (highs - rng.uniform(0.1, 1, n)).round(2)
    return minute_bars(spark, symbol, start, [float(h) for h in highs], [float(v) for v in lows])


def write_parts(df, path, n_parts):
    """Write bars in time order as separate sub-folders (one trigger each)."""
    pdf = df.toPandas().sort_values("datetime")
    for i, chunk in enumerate((pdf.iloc[ix] for ix in np.array_split(np.arange(len(pdf)), n_parts))):
        df.sparkSession.createDataFrame(chunk, BAR_SCHEMA).coalesce(1).write.parquet(f"{path}/p{i:03d}")


def test_stream_sma_equals_batch_except_withheld_tail(spark, tmp_path):
    bars = rand_bars(spark, "A", 60, 1).unionByName(rand_bars(spark, "B", 45, 2))
    src = str(tmp_path / "src")
    write_parts(bars, src, 3)
    s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA, max_files_per_trigger=1)
    j = sma_join(s.withWatermark("datetime", "2 seconds"), "20 minutes", "1 minute")
    q = run(start(j, str(tmp_path / "ck"), str(tmp_path / "out"), state_partitions=4))
    got = wall_time(spark.read.parquet(str(tmp_path / "out"))).toPandas()
    want = sma_join(bars, "20 minutes", "1 minute").toPandas()
    cut = bars.agg(F.max("datetime")).collect()[0][0] - dt.timedelta(seconds=2)
    want = want[want.datetime <= cut]
    assert len(got) == len(want) == 60 - 1 - 1 + 45 - 1        # first bars and newest A withheld
    m = got.merge(want, on=["symbol", "datetime"])
    np.testing.assert_allclose(m.sma_20_x, m.sma_20_y, rtol=1e-12)
    assert dropped_by_watermark(q) == 0


def test_late_file_rows_are_dropped_and_counted(spark, tmp_path):
    bars = rand_bars(spark, "A", 40, 3)
    src = str(tmp_path / "src")
    bars.coalesce(1).write.parquet(f"{src}/p0")
    s = lambda: sma_join(bar_file_stream(spark, f"{src}/*", BAR_SCHEMA, 1)
                         .withWatermark("datetime", "2 seconds"), "20 minutes", "1 minute")
    run(start(s(), str(tmp_path / "ck"), str(tmp_path / "out"), state_partitions=4))
    minute_bars(spark, "A", T0 + dt.timedelta(minutes=5, seconds=30), [500.0]).coalesce(1) \
        .write.parquet(f"{src}/p1")
    q = run(start(s(), str(tmp_path / "ck"), str(tmp_path / "out"), state_partitions=4))
    assert dropped_by_watermark(q) > 0
    out = spark.read.parquet(str(tmp_path / "out")).toPandas()
    assert out.sma_20.max() < 200                               # the late bar fed no mean


def _batch_indicators(bars):
    cols = ["symbol", "datetime", "ema_12", "ema_16", "ema_30", "ema_200", "macd", "signal",
            "support", "resistance"]
    return indicators(bars).select(*cols).toPandas()


def _compare(live: pd.DataFrame, batch: pd.DataFrame):
    m = live.merge(batch, on=["symbol", "datetime"], suffixes=("_l", "_b"))
    assert len(m) == len(live)
    for c in ("ema_12", "ema_200", "macd", "signal", "support", "resistance"):
        np.testing.assert_allclose(m[f"{c}_l"], m[f"{c}_b"], rtol=1e-9, atol=1e-9)


def go_live(spark, tmp_path, src, bars, init=None, delay="2 hours"):
    """Live indicators over the files below ``src``, one a micro-batch, then a heartbeat."""
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def query():
        s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA, max_files_per_trigger=1).withWatermark("datetime", delay)
        return start(live_indicators(s, init), ck, out, state_partitions=4)

    first = run(query())
    heartbeat(spark, f"{src}/zz", bars, delay)
    second = run(query())
    return wall_time(spark.read.parquet(out)).toPandas(), dropped_by_watermark(first) + dropped_by_watermark(second)


@pytest.mark.parametrize("seed", [1, 2])
def test_live_indicators_do_not_depend_on_files_order_or_copies(spark, tmp_path, seed):
    bars = rand_bars(spark, "A", 90, 4).unionByName(rand_bars(spark, "B", 50, 5))
    rng = np.random.default_rng(seed)
    pdf = bars.toPandas()
    stale = pdf.sample(20, random_state=seed)
    stale = stale.assign(volume=1, close=1.0)                    # a fetch of an unfinished bar: the full one wins
    pdf = pd.concat([pdf, stale, pdf.sample(15, random_state=seed)]).sample(frac=1, random_state=seed)
    src = str(tmp_path / "src")
    for i, chunk in enumerate((pdf.iloc[ix] for ix in np.split(np.arange(len(pdf)), np.sort(rng.choice(len(pdf), 3, replace=False))))):
        spark.createDataFrame(chunk, BAR_SCHEMA).coalesce(1).write.parquet(f"{src}/p{i:03d}")
    live, dropped = go_live(spark, tmp_path, src, bars)
    assert len(live) == 140 and dropped == 0
    _compare(live, _batch_indicators(bars))
    m = live.merge(bars.toPandas(), on=["symbol", "datetime"], suffixes=("", "_b"))
    assert all((m[c] == m[f"{c}_b"]).all() for c in ("open", "high", "low", "close", "volume"))
    assert (live.resistance > 0).any() or (live.support > 0).any()


def test_live_drops_and_counts_only_bars_behind_the_watermark(spark, tmp_path):
    bars = rand_bars(spark, "A", 60, 14)
    cut = T0 + dt.timedelta(minutes=20)
    src = str(tmp_path / "src")
    last = T0 + dt.timedelta(minutes=59)
    bars.where(~F.col("datetime").isin(cut, last)).coalesce(1).write.parquet(f"{src}/p0")
    bars.where(F.col("datetime") == last).coalesce(1).write.parquet(f"{src}/p1")
    bars.where(F.col("datetime") == cut).coalesce(1).write.parquet(f"{src}/p2")
    live, dropped = go_live(spark, tmp_path, src, bars, delay="5 minutes")
    assert len(live) == 59 and dropped == 1


def test_a_missing_high_makes_no_level():
    from barsmith.streaming.live import IndicatorProcessor
    p = IndicatorProcessor(min_prior=0)
    v = np.array([1.0, 2, 3, 4, 9, 3, 2, 1, 1])
    assert p._pivots(v, [], 0, np.argmax)[0][6] == 2.0
    v[5] = np.nan
    assert not p._pivots(v, [], 0, np.argmax)[0].any()


def test_the_meter_counts_more_batches_than_progress_keeps():
    from barsmith.streaming.sinks import Meter

    class Query:
        recentProgress: list = []

    m = Meter(Query)
    for end in range(0, 390, 60):
        Query.recentProgress = [{"batchId": i, "numInputRows": i % 2, "stateOperators": [{"numRowsDroppedByWatermark": 1}]}
                                for i in range(max(0, end - 100), end)]
        m.read()
    assert (len(m.batches), m.with_data, m.dropped) == (360, 180, 360)


def test_await_any_raises_and_forgets_ended_queries(spark, tmp_path):
    from barsmith.streaming.sinks import await_any
    bars = rand_bars(spark, "A", 5, 15)
    bars.coalesce(1).write.parquet(str(tmp_path / "src"))
    s = bar_file_stream(spark, str(tmp_path / "src"), BAR_SCHEMA)
    spark.streams.resetTerminated()
    start(s.withColumn("close", F.raise_error(F.lit("broken")).cast("double")), str(tmp_path / "ck"), str(tmp_path / "out"))
    with pytest.raises(Exception, match="broken"):
        await_any(spark, 60)
    start(s, str(tmp_path / "ck2"), str(tmp_path / "out2"))
    await_any(spark, 60)
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 5


def test_sinks_take_options_and_need_checkpoints(spark, tmp_path):
    bars = rand_bars(spark, "A", 6, 16)
    bars.coalesce(1).write.parquet(str(tmp_path / "src"))
    s = bar_file_stream(spark, str(tmp_path / "src"), BAR_SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run(start(s, str(tmp_path / "ck"), str(tmp_path / "out"), fmt="csv", options={"sep": ";"}, state_partitions=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.read.csv(str(tmp_path / "out"), sep=";").count() == 6
    with pytest.raises(ValueError, match="checkpoint"):
        start(s, "", str(tmp_path / "out3"))


def test_warm_state_then_live_equals_one_batch(spark, tmp_path):
    bars = rand_bars(spark, "A", 120, 6).unionByName(rand_bars(spark, "B", 70, 7))
    cut = T0 + dt.timedelta(minutes=40)
    warm = indicators(bars.where(F.col("datetime") < cut), levels=False)
    state = save_warm_state(warm_state(warm), str(tmp_path / "state"))
    src = str(tmp_path / "src")
    write_parts(bars.where(F.col("datetime") >= cut), src, 2)
    live, _ = go_live(spark, tmp_path, src, bars, state)
    assert len(live) == 80 + 30
    _compare(live, _batch_indicators(bars))


def test_state_read_as_a_table_goes_on_with_other_partitions(spark, tmp_path):
    """Live with four state partitions, stopped while bars wait; state and waiting bars move to three partitions: one run's result."""
    from barsmith.streaming.live import live_state, waiting_bars
    bars = rand_bars(spark, "A", 120, 16).unionByName(rand_bars(spark, "0700", 70, 17))
    cut = T0 + dt.timedelta(minutes=50)
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    bars.where(F.col("datetime") < F.lit(cut)).coalesce(1).write.parquet(f"{src}/p0")
    s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA, 1).withWatermark("datetime", "15 minutes")
    run(start(live_indicators(s), ck, out, state_partitions=4))
    before = wall_time(read_store(spark, out)).toPandas()
    state = live_state(spark, ck)
    waiting = waiting_bars(spark, ck).select(*COLS)
    assert sorted(r.n_bars for r in state.collect()) == sorted(before.groupby("symbol").size())
    assert waiting.count() + len(before) == 100 and waiting.count() > 0
    again = str(tmp_path / "again")
    src2 = f"{again}/src"
    bars.where(F.col("datetime") >= F.lit(cut)).unionByName(waiting).coalesce(1).write.parquet(f"{src2}/p0")
    init = save_warm_state(state, str(tmp_path / "state"))
    heartbeat(spark, f"{src2}/zz", bars, "15 minutes")
    s = bar_file_stream(spark, f"{src2}/*", BAR_SCHEMA, 1).withWatermark("datetime", "15 minutes")
    run(start(live_indicators(s, init), f"{again}/ck", f"{again}/out", state_partitions=3))
    both = pd.concat([before, wall_time(read_store(spark, f"{again}/out")).toPandas()])
    assert len(both) == 190
    _compare(both, _batch_indicators(bars))


def test_overlap_after_restart_is_deduplicated(spark, tmp_path):
    bars = rand_bars(spark, "A", 30, 8)
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    bars.coalesce(1).write.parquet(f"{src}/p0")

    def go():
        s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA).withWatermark("datetime", "1 hour")
        return run(start(s.dropDuplicatesWithinWatermark(["symbol", "datetime"]), ck, out,
                         state_partitions=4))

    go()
    bars.orderBy(F.col("datetime").desc()).limit(5).coalesce(1).write.parquet(f"{src}/p1")
    go()
    res = spark.read.parquet(out)
    assert res.count() == 30 and res.select("datetime").distinct().count() == 30


def test_fan_out_writes_every_sink_once(spark, tmp_path):
    bars = rand_bars(spark, "A", 25, 9)
    bars.coalesce(1).write.parquet(str(tmp_path / "src"))
    s = bar_file_stream(spark, str(tmp_path / "src"), BAR_SCHEMA)
    run(fan_out(s, [parquet_batch_sink(str(tmp_path / "a")), parquet_batch_sink(str(tmp_path / "b"))],
                str(tmp_path / "ck")))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 25
    assert spark.read.parquet(str(tmp_path / "b")).count() == 25


def test_kafka_options_and_codec(spark):
    o = kafka_reader_options("broker:9092", ["aapl", "eur-usd"])
    assert o["subscribe"] == "aapl,eur-usd" and o["failOnDataLoss"] == "false"
    assert o["startingOffsets"] == "earliest"
    enc = encode_for_kafka(rand_bars(spark, "EUR/USD", 3, 10)).collect()
    assert {r.topic for r in enc} == {"eur-usd"}
    assert '"close":"' in enc[0].value                  # every field travels as text


def test_console_sink_and_bounded_live_run(spark, tmp_path, capsys):
    from barsmith.streaming.sinks import stop_after_batches, write_console
    bars = rand_bars(spark, "A", 12, 11)
    src = str(tmp_path / "src")
    write_parts(bars, src, 3)
    s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA, max_files_per_trigger=1)
    q = write_console(s, str(tmp_path / "ck"), trigger="200 milliseconds")
    stop_after_batches(q, 3, poll_s=0.2, timeout_s=60)
    assert not q.isActive
    assert sum(p["numInputRows"] for p in q.recentProgress) == 12


def test_session_filter_with_exchange_time_zone(spark):
    from barsmith.functions.timefns import in_session
    rows = [(dt.datetime(2024, 1, 2, 14, 30),), (dt.datetime(2024, 1, 2, 9, 30),),
            (dt.datetime(2024, 1, 6, 15, 0),)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz")
    utc_rows = df.where(in_session("datetime", tz="America/New_York")).collect()
    assert [r.datetime.hour for r in utc_rows] == [14]          # 09:30 New York
    assert df.where(in_session("datetime")).count() == 2        # Saturday excluded


def test_fan_out_sink_replay_is_idempotent(spark, tmp_path):
    bars = rand_bars(spark, "A", 7, 12)
    sink = parquet_batch_sink(str(tmp_path / "a"))
    sink(bars, 0)
    sink(bars, 0)                                   # the same epoch replayed
    sink(bars, 1)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 14


def test_live_drops_bars_already_in_the_warm_state(spark, tmp_path):
    bars = rand_bars(spark, "A", 60, 13)
    cut = T0 + dt.timedelta(minutes=40)
    warm = indicators(bars.where(F.col("datetime") < cut), levels=False)
    state = save_warm_state(warm_state(warm), str(tmp_path / "state"))
    # the live feed starts with the last 3 warm bars again (overlapping fetch)
    live_in = bars.where(F.col("datetime") >= cut - dt.timedelta(minutes=3))
    src = str(tmp_path / "src")
    write_parts(live_in, src, 2)
    live, _ = go_live(spark, tmp_path, src, bars, state)
    assert len(live) == 20 and live.datetime.min() == cut
    _compare(live, _batch_indicators(bars))


def test_the_listener_counts_all_batches_of_a_query_nobody_polls(spark, tmp_path):
    """A newest bar first, then 110 files with one late bar each, a file a batch: more than recent progress keeps."""
    src = str(tmp_path / "src")
    minute_bars(spark, "A", T0 + dt.timedelta(days=9), [1.0]).coalesce(1).write.parquet(f"{src}/p000")
    bars = minute_bars(spark, "A", T0, [float(i) for i in range(110)])
    bars.write.option("maxRecordsPerFile", 1).parquet(f"{src}/p001")
    s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA, 1).withWatermark("datetime", "2 seconds")
    q = start(s.groupBy("symbol", "datetime").count(), str(tmp_path / "ck"), str(tmp_path / "out"), state_partitions=1)
    q.awaitTermination(240)
    assert not q.isActive and len(q.recentProgress) <= 100
    from barsmith.streaming.sinks import meter
    counts = meter(q)
    # every batch but the first is behind the watermark; batches planned with the first one's watermark may pass a row
    assert counts.with_data == 111 and 108 <= dropped_by_watermark(q) <= 110


def test_a_stream_keeps_the_copies_that_a_batch_keeps(spark, tmp_path):
    from barsmith.operators.bars import best_of_stream, dedup_bars
    src = str(tmp_path / "src")
    a = minute_bars(spark, "A", T0, [5.0, 6.0, 7.0, 8.0])
    b = a.withColumns({"volume": F.col("volume") + F.when(F.minute("datetime") % 2 == 0, 1).otherwise(-1), "close": F.col("close") + 9})
    a.coalesce(1).write.parquet(f"{src}/p0")
    b.coalesce(1).write.parquet(f"{src}/p1")
    minute_bars(spark, "Z", T0 + dt.timedelta(days=3), [1.0]).coalesce(1).write.parquet(f"{src}/p2")
    s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA).withWatermark("datetime", "1 hour")
    run(start(best_of_stream(s), str(tmp_path / "ck"), str(tmp_path / "out"), state_partitions=2))
    got = wall_time(read_store(spark, str(tmp_path / "out"))).select(*a.columns)
    assert sorted(got.collect()) == sorted(dedup_bars(a.unionByName(b)).select(*a.columns).collect())


def test_pane_means_equal_the_window_join(spark, tmp_path):
    """Files in order with gaps, repeats, a null close and bars off the grid; stripes shorter than the series."""
    from barsmith.streaming.panes import sma_panes
    a = rand_bars(spark, "A", 70, 1)
    gap = rand_bars(spark, "B", 90, 2).where(F.minute("datetime") % 7 != 3)
    odd = minute_bars(spark, "C", T0 + dt.timedelta(seconds=20), [float(i) for i in range(40)])
    more = minute_bars(spark, "C", T0, [float(i) for i in range(60)])
    bars = a.unionByName(gap).unionByName(odd).unionByName(more).unionByName(more.limit(3))
    bars = bars.withColumn("close", F.when((F.col("symbol") == "A") & (F.minute("datetime") == 41), None).otherwise(F.col("close")))
    src = str(tmp_path / "src")
    for k in range(4):
        lo, hi = T0 + dt.timedelta(minutes=25 * k), T0 + dt.timedelta(minutes=25 * (k + 1))
        bars.where((F.col("datetime") >= F.lit(lo)) & (F.col("datetime") < F.lit(hi))).coalesce(1).write.parquet(f"{src}/p{k}")
    heartbeat(spark, f"{src}/p9", bars, "2 seconds")
    s = bar_file_stream(spark, f"{src}/*", BAR_SCHEMA, 1).withWatermark("datetime", "2 seconds")
    q = run(start(sma_panes(s, "20 minutes", "1 minute", stripe="25 minutes"), str(tmp_path / "ck"), str(tmp_path / "out"), state_partitions=4))
    got = wall_time(read_store(spark, str(tmp_path / "out"))).select(*COLS, "sma_20").orderBy(*COLS[:2], "close").toPandas()
    end = bars.agg(F.max("datetime")).first()[0]
    want = sma_join(bars, "20 minutes", "1 minute").where(F.col("datetime") <= F.lit(end)).select(*COLS, "sma_20").orderBy(*COLS[:2], "close").toPandas()
    pd.testing.assert_frame_equal(got, want, rtol=1e-12, check_dtype=False)
    assert dropped_by_watermark(q) == 0
