"""Exponential moving averages and MACD on keyed series (see ``sequence``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.operators.sequence import DEFAULT_BUCKET, Frame, Recurrence, ScanSpec, ema_decay, scan
from barsmith.schema import EMA_SPANS, SIGNAL_SPAN


def _order(time_col: str, tie: str | None) -> list[str]:
    return [time_col] + ([tie] if tie else [])


def ema(df: DataFrame, col: str = "close", spans=(12, 16, 30), key: str = "symbol",
        time_col: str = "datetime", tie: str | None = None, prefix: str = "ema_",
        bucket: str | int = DEFAULT_BUCKET) -> DataFrame:
    """Add ``{prefix}{N}`` = EMA of ``col`` for each span N.

    alpha = 2/(N+1); the first value seeds the average and the update is also
    applied to it, so the first EMA equals the first input (``ewm(span=N,
    adjust=False)``).  Rows with a null key, time or input are dropped first.
    ``bucket`` is the time that a task holds of a series (see ``sequence``).
    """
    spans = list(spans)
    base = df.where(F.col(key).isNotNull() & F.col(time_col).isNotNull() & F.col(col).isNotNull())
    base = base.withColumn("_src", F.col(col).cast("double"))
    recs = [Recurrence(f"{prefix}{n}", "_src", ema_decay(n)) for n in spans]
    return scan(base, key, _order(time_col, tie), ScanSpec(recs), bucket).drop("_src")


def signal_terms(spans: list[int], signal_span: int) -> tuple[list[Recurrence], object]:
    """Signal = EMA_s(EMA_short - EMA_long) as a sum of first-order terms.

    Two chained first-order filters with different decays split by partial
    fractions into single filters of the input, so the signal needs no
    second scan over the MACD column.  With ``E_N`` the EMA of span N of the
    close, ``E_9`` the EMA with the signal's decay and ``Z = b9^(t+1) x0``
    (the decayed seed, ``E_9`` minus its unseeded twin):

        S = a9 * sum_N sgn_N / (b_N - b9) *
            (b_N E_N - b9 (a_N/a9) E_9 + (b9 a_N/a9 - b_N) Z)

    over N = short (+1) and long (-1).  S(0) = 0 as in the recursion.
    Returns the extra recurrences and a function building the column.
    """
    short, long_ = min(spans), max(spans)
    b9 = ema_decay(signal_span)
    a9 = 1.0 - b9
    extra = [Recurrence("_e_sig", "_src", b9), Recurrence("_e_sig0", "_src", b9, seeded=False)]

    def column():
        z = F.col("_e_sig") - F.col("_e_sig0")
        total = F.lit(0.0)
        for n, sgn in ((short, 1.0), (long_, -1.0)):
            bn = ema_decay(n)
            an = 1.0 - bn
            c = sgn / (bn - b9)
            total = total + F.lit(c) * (F.lit(bn) * F.col(f"ema_{n}")
                                        - F.lit(b9 * an / a9) * F.col("_e_sig")
                                        + F.lit(b9 * an / a9 - bn) * z)
        return F.lit(a9) * total

    return extra, column


def _one_pass_signal(spans: list[int], signal_span: int) -> bool:
    """The split needs the signal's decay apart from both MACD decays
    (1/(b_N - b9) scales rounding errors); otherwise run a second pass."""
    b9 = ema_decay(signal_span)
    return min(abs(ema_decay(n) - b9) for n in (min(spans), max(spans))) > 1e-3


def indicators(bars: DataFrame, spans=tuple(EMA_SPANS), long_span: int | None = 200,
               signal_span: int = SIGNAL_SPAN, key: str = "symbol", time_col: str = "datetime",
               tie: str | None = None, levels: bool = True, left: int = 4, right: int = 2,
               min_prior: int = 8, level_from: str = "current", bucket: str | int = DEFAULT_BUCKET,
               frames: tuple[Frame, ...] = ()) -> DataFrame:
    """EMA of every span (+ the long span), MACD, signal and support/resistance.

    One scan over one exchange: the EMAs, the signal (as first-order terms, see
    ``signal_terms``), the row index and the high/low lags the pivot test
    needs.  Only when the signal's decay nearly equals a MACD decay does a
    second scan run the signal recurrence on the MACD column.  ``frames`` adds
    time-range sums out of the same layout.
    """
    from barsmith.operators.levels import level_columns

    spans = list(spans)
    all_spans = spans + ([long_span] if long_span else [])
    short, long_ = f"ema_{min(spans)}", f"ema_{max(spans)}"
    base = bars.where(F.col(key).isNotNull() & F.col(time_col).isNotNull()
                      & F.col("close").isNotNull())
    base = base.withColumn("_src", F.col("close").cast("double"))
    recs = [Recurrence(f"ema_{n}", "_src", ema_decay(n)) for n in all_spans]
    sig = Recurrence("signal", "macd", ema_decay(signal_span))
    one_pass = _one_pass_signal(spans, signal_span)
    extra, sig_col = signal_terms(spans, signal_span) if one_pass else ([], None)
    width = left + right + 1
    spec1 = ScanSpec(recs + extra, ["high", "low"] if levels else [], width - 1 if levels else 0,
                     "_idx" if levels else None, list(frames))
    p1 = scan(base, key, _order(time_col, tie), spec1, bucket).withColumn("macd", F.col(short) - F.col(long_))
    if one_pass:
        p2 = p1.withColumn("signal", sig_col()).drop("_e_sig", "_e_sig0")
    else:
        p2 = scan(p1, key, _order(time_col, tie), ScanSpec([sig]), bucket)
    if levels:
        p2 = p2.withColumns(level_columns(left, right, min_prior, level_from))
        p2 = p2.drop(*[f"{c}_lag{k}" for c in ("high", "low") for k in range(1, width)], "_idx")
    return p2.drop("_src")


def macd(df: DataFrame, col: str = "close", spans=tuple(EMA_SPANS), signal_span: int = SIGNAL_SPAN,
         key: str = "symbol", time_col: str = "datetime", tie: str | None = None,
         bucket: str | int = DEFAULT_BUCKET) -> DataFrame:
    """EMA of each span, ``macd = ema_min - ema_max`` and ``signal`` = EMA(macd)."""
    spans = list(spans)
    base = df.where(F.col(key).isNotNull() & F.col(time_col).isNotNull() & F.col(col).isNotNull())
    base = base.withColumn("_src", F.col(col).cast("double"))
    recs = [Recurrence(f"ema_{n}", "_src", ema_decay(n)) for n in spans]
    sig = Recurrence("signal", "macd", ema_decay(signal_span))
    one_pass = _one_pass_signal(spans, signal_span)
    extra, sig_col = signal_terms(spans, signal_span) if one_pass else ([], None)
    p1 = scan(base, key, _order(time_col, tie), ScanSpec(recs + extra), bucket).withColumn(
        "macd", F.col(f"ema_{min(spans)}") - F.col(f"ema_{max(spans)}"))
    if one_pass:
        return p1.withColumn("signal", sig_col()).drop("_e_sig", "_e_sig0", "_src")
    return scan(p1, key, _order(time_col, tie), ScanSpec([sig]), bucket).drop("_src")
