"""Support / resistance pivots over a trailing slice of bars.

Resistance at bar i: within bars i-6..i the *first* maximum of ``high`` sits
at slice index 4 (bar i-2), i.e. high[i-2] is above each of the four bars
before it and not below the two after it.  Support mirrors it with ``low``.
The level reported is the current bar's high/low (``level_from='current'``)
or the pivot bar's (``'pivot'``); 0.0 means "no level".  A bar needs
``min_prior`` earlier bars to qualify.  Comparisons are numeric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.operators.sequence import DEFAULT_BUCKET, ScanSpec, scan


def _lag(c: str, k: int) -> Column:
    return F.col(c) if k == 0 else F.col(f"{c}_lag{k}")


def _first_extreme_at(c: str, left: int, right: int, better) -> Column:
    """The value ``right`` bars back beats all ``left`` before it and is not
    beaten by the ``right`` after it."""
    p = _lag(c, right)
    cond = F.lit(True)
    for k in range(right + 1, right + left + 1):          # earlier bars: strict
        cond = cond & better(p, _lag(c, k), strict=True)
    for k in range(0, right):                              # later bars: ties allowed
        cond = cond & better(p, _lag(c, k), strict=False)
    return cond


def _gt(a, b, strict):
    return a > b if strict else a >= b


def _lt(a, b, strict):
    return a < b if strict else a <= b


def level_columns(left: int = 4, right: int = 2, min_prior: int = 8,
                  level_from: str = "current", index_col: str = "_idx") -> dict[str, Column]:
    """Column expressions for ``support``/``resistance`` given lag columns."""
    ok = F.col(index_col) >= min_prior
    res_v = F.col("high") if level_from == "current" else _lag("high", right)
    sup_v = F.col("low") if level_from == "current" else _lag("low", right)
    res = F.when(ok & _first_extreme_at("high", left, right, _gt), res_v).otherwise(F.lit(0.0))
    sup = F.when(ok & _first_extreme_at("low", left, right, _lt), sup_v).otherwise(F.lit(0.0))
    return {"support": sup.cast("double"), "resistance": res.cast("double")}


def levels(bars: DataFrame, left: int = 4, right: int = 2, min_prior: int = 8,
           level_from: str = "current", key: str = "symbol", time_col: str = "datetime",
           tie: str | None = None, bucket: str | int = DEFAULT_BUCKET) -> DataFrame:
    """Add ``support`` and ``resistance`` (0.0 = none) to bars."""
    width = left + right + 1
    base = bars.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    base = base.withColumn("high", F.col("high").cast("double")).withColumn(
        "low", F.col("low").cast("double"))
    s = scan(base, key, [time_col] + ([tie] if tie else []), ScanSpec([], ["high", "low"], width - 1, "_idx"), bucket)
    s = s.withColumns(level_columns(left, right, min_prior, level_from))
    return s.drop(*[f"{c}_lag{k}" for c in ("high", "low") for k in range(1, width)],
                  "_idx")


def trailing_extremes(bars: DataFrame, width: int = 7, key: str = "symbol",
                      time_col: str = "datetime", tie: str | None = None, bucket: str | int = DEFAULT_BUCKET) -> DataFrame:
    """Max high and min low over the trailing ``width`` bars (fewer at the start),
    plus the row index; exact across bucket borders via the carried halo.  Rows
    without a symbol or a time are left out."""
    base = bars.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    base = base.withColumn("high", F.col("high").cast("double")).withColumn(
        "low", F.col("low").cast("double"))
    s = scan(base, key, [time_col] + ([tie] if tie else []), ScanSpec([], ["high", "low"], width - 1, "rn"), bucket)
    hs = [_lag("high", k) for k in range(width)]
    ls = [_lag("low", k) for k in range(width)]
    s = s.withColumns({"max_high": F.greatest(*hs), "min_low": F.least(*ls)})
    return s.drop(*[f"{c}_lag{k}" for c in ("high", "low") for k in range(1, width)])


def pivot_position(bars: DataFrame, width: int = 7, key: str = "symbol",
                   time_col: str = "datetime", tie: str | None = None, bucket: str | int = DEFAULT_BUCKET) -> DataFrame:
    """0-based slice index of the first max high / first min low over the
    trailing ``width`` bars, for bars that have a full slice.  Rows without a
    symbol or a time are left out."""
    base = bars.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    base = base.withColumn("high", F.col("high").cast("double")).withColumn(
        "low", F.col("low").cast("double"))
    s = scan(base, key, [time_col] + ([tie] if tie else []), ScanSpec([], ["high", "low"], width - 1, "rn"), bucket)
    s = s.where(F.col("rn") >= width - 1)
    hs = F.array(*[_lag("high", k) for k in range(width - 1, -1, -1)])   # oldest first
    ls = F.array(*[_lag("low", k) for k in range(width - 1, -1, -1)])
    s = s.withColumns({"max_pos": (F.array_position(hs, F.array_max(hs)) - 1).cast("int"),
                       "min_pos": (F.array_position(ls, F.array_min(ls)) - 1).cast("int")})
    return s.drop(*[f"{c}_lag{k}" for c in ("high", "low") for k in range(1, width)])
