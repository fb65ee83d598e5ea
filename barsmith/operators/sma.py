"""Moving means of close over event time.

Two forms with equal results on bars that sit on the slide grid:

* ``sma_windows`` (+ ``sma_join``): sliding windows ``[end - window, end)``.
  On a stream they are aggregated by (symbol, window) and equi-joined back on
  ``datetime = window.end`` (watermark + append).  In a batch ``sma_join`` reads
  them as time frames of the layout by (symbol, bucket) of ``sequence``: one
  exchange of the bars and of the stretch before each bucket, no expansion, no
  join.  Frames that hold very many bars are better served by ``sma_range``.
* ``sma_range``: a time-range frame ``[t - window, t)`` for bars at any time.
  The window is cut into parts; a bar's mean is made of the sums of the whole
  parts before its own, its own part up to it, and what the oldest part holds
  before the frame, taken off.  A group of rows is two parts of one symbol,
  whatever the symbol's history or the number of symbols.

``sma_range_scan`` gives the same means from prefix sums over whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions.timefns import epoch_micros, interval_micros
from barsmith.operators.sequence import DEFAULT_BUCKET, Frame, ScanSpec, running_sum, scan


def _fixed(value: str, exact_decimals: int | None):
    """The value as an integer count of ``10^-d`` units (``None``: as is)."""
    if exact_decimals is None:
        return F.col(value)
    return F.round(F.col(value) * F.lit(10.0 ** exact_decimals)).cast("bigint")


def _mean(summed, count, exact_decimals: int | None):
    """Mean from a sum and a count.  With ``exact_decimals`` the sum is of
    integers, so it is exact and independent of partitioning and summation
    order; only the final division rounds."""
    m = summed / count
    if exact_decimals is None:
        return m
    return m / F.lit(10.0 ** exact_decimals)


def sma_windows(bars: DataFrame, window: str = "20 minutes", slide: str = "1 minute",
                key: str = "symbol", time_col: str = "datetime", value: str = "close",
                out: str = "sma_20", exact_decimals: int | None = None) -> DataFrame:
    """Mean of ``value`` per (symbol, sliding window); window start/end as columns.

    ``exact_decimals=d`` treats values as fixed point with ``d`` decimals
    (prices in cents: 2) and averages exact integer sums.
    """
    g = bars.groupBy(F.col(key).alias(key), F.window(time_col, window, slide).alias("_w"))
    v = _fixed(value, exact_decimals)
    agg = g.agg(_mean(F.sum(v), F.count(v), exact_decimals).alias(out))
    return agg.select(key, F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"), out)


def sma_join(bars: DataFrame, window: str = "20 minutes", slide: str = "1 minute",
             how: str = "inner", key: str = "symbol", time_col: str = "datetime",
             value: str = "close", out: str = "sma_20",
             exact_decimals: int | None = None,
             means_from: DataFrame | None = None,
             window_col: str | None = None, bucket: str | int = DEFAULT_BUCKET) -> DataFrame:
    """Each bar with the mean of the window that *ends* at it (bar excluded).

    ``how='inner'`` drops bars with no earlier bar inside the window and bars
    off the slide grid; ``'left'`` keeps them with a null mean.  On a stream,
    give ``bars`` one watermark first; both join sides inherit it.
    ``bucket`` is the time that a task holds of a symbol in a batch.
    ``means_from`` computes the means from another frame holding the same
    bars (e.g. the raw bars when ``bars`` carries costly derived columns),
    so the aggregate side does not recompute them.  ``window_col`` assigns
    windows by another event-time column (e.g. ``event_time`` of a streamed
    resample, which carries the watermark to this second stateful step).
    """
    if not bars.isStreaming and means_from is None and window_col is None:
        return _frame_join(bars, window, slide, how, key, time_col, value, out, exact_decimals, bucket)
    src = means_from if means_from is not None else bars
    sma = sma_windows(src, window, slide, key, window_col or time_col, value, out, exact_decimals)
    sma = sma.select(F.col(key).alias("_s2"), F.col("window_end").alias("_wend"), out)
    cond = (F.col(key) == F.col("_s2")) & (F.col(time_col) == F.col("_wend"))
    return bars.join(sma, cond, how).drop("_s2", "_wend")


def mean_frame(df: DataFrame, window: str, value: str, exact_decimals: int | None) -> tuple[DataFrame, Frame]:
    """``df`` with the values to average as ``_fx``, and the frame that adds them up (for ``sequence.scan``)."""
    return df.withColumn("_fx", _fixed(value, exact_decimals)), Frame("_fm", "_fx", interval_micros(window))


def frame_mean(df: DataFrame, window: str, slide: str, how: str, time_col: str, out: str, exact_decimals: int | None) -> DataFrame:
    """The mean out of the sums of ``mean_frame``, for rows on the slide grid that have a bar in the window; others are
    dropped (``inner``) or have none."""
    on_grid = F.pmod(epoch_micros(time_col) - interval_micros(window), F.lit(interval_micros(slide))) == 0
    has = on_grid & (F.col("_fm_count") > 0)
    rows = df.where(has) if how == "inner" else df
    return rows.withColumn(out, F.when(has, _mean(F.col("_fm_sum"), F.col("_fm_count"), exact_decimals))).drop("_fx", "_fm_sum", "_fm_count")


def _frame_join(bars, window, slide, how, key, time_col, value, out, exact_decimals, bucket) -> DataFrame:
    rows, frame = mean_frame(bars, window, value, exact_decimals)
    got = frame_mean(scan(rows, key, [time_col], ScanSpec(frames=[frame]), bucket), window, slide, how, time_col, out, exact_decimals)
    if how != "inner":
        outside = bars.where(F.col(key).isNull() | F.col(time_col).isNull())
        got = got.unionByName(outside, allowMissingColumns=True)
    return got.select(*bars.columns, out)


def _whole_parts(totals: DataFrame, key: str, parts: int, span: int = 64) -> DataFrame:
    """(key, _p, _s, _n): sum and count of the ``parts`` parts before each part.

    Parts are looked at in stretches of ``span * parts``, each with the last
    ``parts`` parts of the stretch before, so no group holds a whole history.
    """
    size = span * parts
    own = totals.withColumn("_g", F.floor(F.col("_p") / size)).withColumn("_own", F.lit(True))
    halo = own.where(F.pmod("_p", F.lit(size)) >= size - parts).withColumn("_g", F.col("_g") + 1).withColumn("_own", F.lit(False))
    w = Window.partitionBy(key, "_g").orderBy("_p").rangeBetween(-parts, -1)
    both = own.unionByName(halo)
    return both.select(key, "_p", "_own", F.sum("_s").over(w).alias("_s"), F.sum("_n").over(w).alias("_n")).where("_own").drop("_own")


def sma_range(bars: DataFrame, window: str = "20 minutes", how: str = "inner",
              key: str = "symbol", time_col: str = "datetime", value: str = "close",
              out: str = "sma_20", exact_decimals: int | None = None, parts: int = 16) -> DataFrame:
    """Mean of ``value`` over ``[t - window, t)`` for every bar (time based).

    ``how='inner'`` keeps bars whose frame is non-empty; ``'left'`` keeps all.
    Only sums within a window are ever formed: with ``exact_decimals`` they
    are integers and exact below 2^63.  Denser data asks for more ``parts``
    (the largest divisor of the window in microseconds up to it is used).
    """
    W = interval_micros(window)
    parts = max(d for d in range(1, parts + 1) if W % d == 0)
    width = W // parts
    v = _fixed(value, exact_decimals)
    base = bars.withColumn("_us", epoch_micros(time_col)).withColumns({
        "_p": F.floor(F.col("_us") / F.lit(width)).cast("bigint"),
        "_s": F.coalesce(v, F.lit(0).cast("bigint" if exact_decimals is not None else "double")),
        "_n": v.isNotNull().cast("bigint")})
    own = base.withColumn("_own", F.lit(True))
    gone = base.select(key, (F.col("_p") + parts).alias("_p"), (F.col("_us") + W).alias("_us"),
                       (-F.col("_s")).alias("_s"), (-F.col("_n")).alias("_n"), F.lit(False).alias("_own"))
    totals = base.groupBy(key, "_p").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    before = _whole_parts(totals, key, parts).where(F.col("_n").isNotNull()).select(
        key, "_p", (F.col("_p") * width - 1).alias("_us"), "_s", "_n", F.lit(False).alias("_own"))
    rows = own.unionByName(gone, allowMissingColumns=True).unionByName(before, allowMissingColumns=True)
    w = Window.partitionBy(key, "_p").orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    res = rows.withColumns({"_sum": F.sum("_s").over(w), "_cnt": F.sum("_n").over(w)}).where("_own")
    res = res.withColumn(out, F.when(F.col("_cnt") > 0, _mean(F.col("_sum"), F.col("_cnt"), exact_decimals)))
    if how == "inner":
        res = res.where(F.col("_cnt") > 0)
    return res.select(*bars.columns, out)


def sma_range_scan(bars: DataFrame, window: str = "20 minutes", tie: tuple[str, ...] = (), how: str = "inner",
                   key: str = "symbol", time_col: str = "datetime", value: str = "close",
                   out: str = "sma_20", exact_decimals: int | None = None, bucket: str | int = "7 days") -> DataFrame:
    """Window sums as differences of exclusive prefix sums read at markers.

    ``tie`` names columns that, with (key, time), make a row unique.

    Every bar adds two zero-valued markers, at ``t`` and at ``t - W``; a
    marker sorts before real rows of equal time, so the running sum of the
    real rows seen at a marker is the sum over times strictly before it.
    The running sums come from the scan (``sequence``) and reach over
    the whole series: ``exact_decimals`` integers are exact while the series
    sums to less than 2^53, plain doubles lose about ``eps * prefix`` to
    cancellation.  ``sma_range`` has neither limit.
    """
    W = interval_micros(window)
    ids = [key, time_col, *tie]
    base = bars.withColumn("_us", epoch_micros(time_col)).withColumn(
        "_v", _fixed(value, exact_decimals).cast("double"))
    real = base.select(*[F.col(c).alias(f"_id{i}") for i, c in enumerate(ids)],
                       F.col(key).alias("_sk"), "_us", F.lit(1).alias("_kind"),
                       F.lit(0).alias("_m"), F.col("_v"),
                       F.when(F.col("_v").isNotNull(), 1.0).otherwise(0.0).alias("_c"))
    marks = [base.select(*[F.col(c).alias(f"_id{i}") for i, c in enumerate(ids)],
                         F.col(key).alias("_sk"), (F.col("_us") - F.lit(shift)).alias("_us"),
                         F.lit(0).alias("_kind"), F.lit(m).alias("_m"),
                         F.lit(0.0).alias("_v"), F.lit(0.0).alias("_c"))
             for m, shift in ((1, 0), (2, W))]
    allrows = real.unionByName(marks[0]).unionByName(marks[1]).where(F.col("_v").isNotNull())
    tie_order = ["_us", "_kind", "_m"] + [f"_id{i}" for i in range(len(ids))]
    sc = scan(allrows, "_sk", tie_order, ScanSpec([running_sum("_ps", "_v"), running_sum("_pc", "_c")]),
              bucket if isinstance(bucket, int) else interval_micros(bucket))
    at = sc.where(F.col("_kind") == 0)
    sign = F.when(F.col("_m") == 1, 1.0).otherwise(-1.0)
    win = at.groupBy(*[f"_id{i}" for i in range(len(ids))]).agg(
        F.sum(sign * F.col("_ps")).alias("_sum"), F.sum(sign * F.col("_pc")).alias("_cnt"))
    cond = [base[c] == win[f"_id{i}"] for i, c in enumerate(ids)]
    joined = base.join(win, cond, "left" if how != "inner" else "inner")
    res = joined.withColumn(out, F.when(F.col("_cnt") > 0, _mean(F.col("_sum"), F.col("_cnt"),
                                                                  exact_decimals)))
    if how == "inner":
        res = res.where(F.col("_cnt") > 0)
    return res.select(*bars.columns, out)
