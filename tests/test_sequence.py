"""The scan: EMA, row index and lags equal the literal recursion at every border."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.operators import sequence as sq
from barsmith.operators.ema import ema, indicators, macd


def literal_ema(x, span):
    a = 2.0 / (span + 1)
    out, e = [], x[0]
    for v in x:
        e = a * v + (1 - a) * e
        out.append(e)
    return np.array(out)


def series_df(spark, lengths, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for k, n in enumerate(lengths):
        vals = rng.normal(100, 10, n).round(2)
        for i, v in enumerate(vals):
            rows.append((f"s{k}", i, float(v)))
    return spark.createDataFrame(rows, "symbol string, t long, close double")


def small_tree(monkeypatch, fan_log2, span):
    """Nodes of few children, and levels for a short time axis."""
    monkeypatch.setattr(sq, "FAN_LOG2", fan_log2)
    monkeypatch.setattr(sq, "_SPAN_INTEGERS", span)


@pytest.mark.parametrize("bucket,block_log2,fan_log2,span", [(8, 1, 1, 64), (5, 0, 1, 40), (3, 3, 2, 1000), (1 << 20, 12, 8, 1 << 40), (16, 2, 8, 1 << 40)])
def test_ema_matches_recursion_at_block_and_bucket_borders(spark, monkeypatch, bucket, block_log2, fan_log2, span):
    spans = [1, 2, 12, 200]
    recs = [sq.Recurrence(f"e{n}", "close", sq.ema_decay(n)) for n in spans]
    block_log2 = min(block_log2, sq.block_log2_for([r.decay for r in recs if r.decay > 0]))
    small_tree(monkeypatch, fan_log2, span)
    df = series_df(spark, [1, 7, 8, 9, 26, 41])
    out = sq.scan(df, "symbol", ["t"], sq.ScanSpec(recs, ["close"], 3, "rn"), bucket, block_log2).toPandas()
    pdf = df.toPandas().sort_values(["symbol", "t"])
    assert len(out) == len(pdf)
    for sym, g in pdf.groupby("symbol"):
        o = out[out.symbol == sym].sort_values("t")
        assert len(o) == len(g)
        for n in spans:
            np.testing.assert_allclose(o[f"e{n}"].to_numpy(), literal_ema(g.close.to_numpy(), n),
                                       rtol=1e-11, atol=1e-9)
        assert (o.rn.to_numpy() == np.arange(len(g))).all()
        lag3 = g.close.shift(3).to_numpy()
        got = o.close_lag3.to_numpy()
        assert np.array_equal(np.isnan(lag3), pd.isna(got))
        np.testing.assert_array_equal(got[~np.isnan(lag3)], lag3[~np.isnan(lag3)])


def test_gaps_negative_times_and_ties(spark, monkeypatch):
    """Empty buckets between rows, times before the epoch, and rows of one time told apart by the tie column."""
    small_tree(monkeypatch, 2, 1 << 12)
    rng = np.random.default_rng(3)
    times = sorted(rng.choice(np.arange(-3000, 3000), 60, replace=False).tolist() + [7] * 9)
    rows = [("a", int(t), i, float(v)) for i, (t, v) in enumerate(zip(times, rng.normal(50, 5, len(times))))]
    df = spark.createDataFrame(rows, "symbol string, t long, tie long, close double").repartition(5)
    out = sq.scan(df, "symbol", ["t", "tie"], sq.ScanSpec([sq.Recurrence("e", "close", sq.ema_decay(9)), sq.running_sum("ps", "close")], ["close"], 4, "rn"), 10, 1)
    got = out.orderBy("tie").toPandas()
    x = np.array([r[3] for r in rows])
    np.testing.assert_allclose(got.e, literal_ema(x, 9), rtol=1e-12)
    np.testing.assert_allclose(got.ps, np.cumsum(x), rtol=1e-12)
    assert list(got.rn) == list(range(len(x)))
    np.testing.assert_array_equal(got.close_lag4.to_numpy()[4:], x[:-4])


def test_frames_look_back_over_buckets(spark):
    rng = np.random.default_rng(5)
    rows = [(f"s{k}", int(t), float(v)) for k in range(3) for t, v in zip(rng.choice(200, 70, replace=False), rng.integers(1, 99, 70))]
    df = spark.createDataFrame(rows, "symbol string, t long, close double")
    out = sq.scan(df, "symbol", ["t"], sq.ScanSpec([sq.Recurrence("e", "close", sq.ema_decay(5))], ["close"], 2, "rn", [sq.Frame("m", "close", 25)]), 10, 1).toPandas()
    assert len(out) == len(rows)
    for sym, g in df.toPandas().sort_values("t").groupby("symbol"):
        o = out[out.symbol == sym].sort_values("t")
        np.testing.assert_allclose(o.e, literal_ema(g.close.to_numpy(), 5), rtol=1e-12)
        assert list(o.rn) == list(range(len(g)))
        want = [g.close[(g.t >= t - 25) & (g.t < t)] for t in g.t]
        assert list(o.m_count) == [len(v) for v in want]
        assert [0.0 if pd.isna(v) else v for v in o.m_sum] == [v.sum() for v in want]


def test_ema_matches_pandas_ewm_and_first_value_seed(spark):
    df = series_df(spark, [50, 300]).withColumnRenamed("t", "datetime")
    out = ema(df, "close", [12, 30]).toPandas()
    for sym, g in df.toPandas().sort_values("datetime").groupby("symbol"):
        o = out[out.symbol == sym].sort_values("datetime")
        np.testing.assert_allclose(o.ema_12, g.close.ewm(span=12, adjust=False).mean(), rtol=1e-12)
        assert o.ema_12.iloc[0] == pytest.approx(g.close.iloc[0])      # EMA_0 = close_0


def test_macd_uses_min_and_max_span_and_signal_starts_at_zero(spark):
    df = series_df(spark, [120]).withColumnRenamed("t", "datetime")
    out = macd(df, "close", [12, 16, 30]).toPandas().sort_values("datetime")
    x = out.close.to_numpy()
    m = literal_ema(x, 12) - literal_ema(x, 30)                      # 12/30, not 12/26
    np.testing.assert_allclose(out.macd, m, atol=1e-10)
    sig, s = [], m[0]
    for v in m:
        s = 0.2 * v + 0.8 * s
        sig.append(s)
    np.testing.assert_allclose(out.signal, sig, atol=1e-10)
    assert out.signal.iloc[0] == pytest.approx(0.0, abs=1e-12)


def test_one_pass_signal_equals_two_pass(spark):
    """The partial-fraction signal equals a second scan over the MACD column."""
    from barsmith.operators.sequence import Recurrence, ScanSpec, scan
    df = series_df(spark, [700, 33]).withColumnRenamed("t", "datetime")
    one = macd(df).select("symbol", "datetime", "signal").toPandas()
    base = df.withColumn("_src", F.col("close"))
    p1 = scan(base, "symbol", ["datetime"], ScanSpec([Recurrence(f"ema_{n}", "_src", sq.ema_decay(n)) for n in (12, 30)]), 100)
    p1 = p1.withColumn("macd", F.col("ema_12") - F.col("ema_30"))
    two = scan(p1, "symbol", ["datetime"], ScanSpec([Recurrence("signal", "macd", sq.ema_decay(9))]), 100)
    two = two.select("symbol", "datetime", F.col("signal").alias("s2")).toPandas()
    m = one.merge(two, on=["symbol", "datetime"])
    assert len(m) == 733
    np.testing.assert_allclose(m.signal, m.s2, atol=1e-9)


def test_null_close_rows_are_dropped(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None), ("a", 2, 3.0)],
                               "symbol string, datetime long, close double")
    out = ema(df, "close", [2]).orderBy("datetime").toPandas()
    assert list(out.datetime) == [0, 2]
    assert out.ema_2.iloc[1] == pytest.approx(2 / 3 * 3 + 1 / 3 * 1)


def test_indicators_many_short_series(spark):
    rows = [(f"k{k}", i, float(100 + k + i)) for k in range(300) for i in range(k % 7 + 1)]
    df = spark.createDataFrame(rows, "symbol string, datetime long, close double").withColumns(
        {"high": F.col("close") + 1, "low": F.col("close") - 1})
    out = indicators(df).toPandas()
    assert len(out) == len(rows)
    g = out[out.symbol == "k6"].sort_values("datetime")
    np.testing.assert_allclose(g.ema_12, literal_ema(g.close.to_numpy(), 12), rtol=1e-12)


def test_unsafe_block_size_is_refused(spark):
    df = series_df(spark, [3])
    with pytest.raises(ValueError):
        sq.scan(df, "symbol", ["t"], sq.ScanSpec([sq.Recurrence("e", "close", sq.ema_decay(2))]), block_log2=12)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(lengths=st.lists(st.integers(1, 90), min_size=1, max_size=4),
       span=st.sampled_from([1, 2, 3, 9, 26, 200]),
       block_log2=st.integers(0, 5), bucket=st.integers(1, 40), fan_log2=st.integers(1, 3),
       seed=st.integers(0, 10_000))
def test_property_ema_equals_recursion(spark, lengths, span, block_log2, bucket, fan_log2, seed):
    with pytest.MonkeyPatch.context() as patch:
        small_tree(patch, fan_log2, 90)
        rec = sq.Recurrence("e", "close", sq.ema_decay(span))
        lg = min(block_log2, sq.block_log2_for([rec.decay]))
        df = series_df(spark, lengths, seed)
        out = sq.scan(df, "symbol", ["t"], sq.ScanSpec([rec], ["close"], 2, "rn"), bucket, lg).toPandas()
    for sym, g in df.toPandas().sort_values("t").groupby("symbol"):
        o = out[out.symbol == sym].sort_values("t")
        np.testing.assert_allclose(o.e, literal_ema(g.close.to_numpy(), span), rtol=1e-10)
        assert list(o.rn) == list(range(len(g)))


def test_empty_and_all_null_inputs(spark):
    empty = spark.createDataFrame([], "symbol string, datetime long, close double")
    assert ema(empty, "close", [12]).count() == 0
    nulls = spark.createDataFrame([("a", 1, None), ("a", 2, None)],
                                  "symbol string, datetime long, close double")
    assert ema(nulls, "close", [12]).count() == 0
    bars = empty.withColumn("high", F.col("close")).withColumn("low", F.col("close"))
    assert indicators(bars).count() == 0


def test_signal_falls_back_to_two_passes_when_decays_coincide(spark):
    df = series_df(spark, [150]).withColumnRenamed("t", "datetime")
    out = macd(df, "close", [9, 30], signal_span=9).toPandas().sort_values("datetime")
    x = out.close.to_numpy()
    m = literal_ema(x, 9) - literal_ema(x, 30)
    sig, s = [], m[0]
    for v in m:
        s = 0.2 * v + 0.8 * s
        sig.append(s)
    np.testing.assert_allclose(out.signal, sig, atol=1e-10)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(lengths=st.lists(st.integers(1, 60), min_size=1, max_size=3),
       bucket=st.integers(1, 30), seed=st.integers(0, 10_000))
def test_property_pivots_equal_first_index_rule(spark, lengths, bucket, seed):
    from barsmith.operators.levels import level_columns
    rng = np.random.default_rng(seed)
    rows = []
    for k, n in enumerate(lengths):
        for i, h in enumerate(rng.integers(0, 5, n)):          # small range: many ties
            rows.append((f"s{k}", i, float(h), float(h - rng.integers(0, 3))))
    df = spark.createDataFrame(rows, "symbol string, t long, high double, low double")
    out = sq.scan(df, "symbol", ["t"], sq.ScanSpec([], ["high", "low"], 6, "_idx"), bucket)
    out = out.withColumns(level_columns()).toPandas()
    for sym, g in df.toPandas().sort_values("t").groupby("symbol"):
        o = out[out.symbol == sym].sort_values("t")
        hs, ls = list(g.high), list(g.low)
        want_r = [hs[i] if i >= 8 and hs[i - 6:i + 1].index(max(hs[i - 6:i + 1])) == 4 else 0.0
                  for i in range(len(hs))]
        want_s = [ls[i] if i >= 8 and ls[i - 6:i + 1].index(min(ls[i - 6:i + 1])) == 4 else 0.0
                  for i in range(len(ls))]
        assert list(o.resistance) == want_r and list(o.support) == want_s
