"""Read-side queries over stored enriched bars (range scans, feeds, options)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions.timefns import open_interval
from barsmith.schema import NONE_OPTION


def range_scan(df: DataFrame, as_of, days: float = 5, symbol: str | None = None,
               time_col: str = "datetime", descending: bool = False) -> DataFrame:
    """Bars with ``as_of - days < datetime < as_of`` (one symbol or all), sorted."""
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    df = df.where(open_interval(time_col, as_of, days))
    o = F.col(time_col).desc() if descending else F.col(time_col).asc()
    return df.orderBy("symbol", o)


def candles(df: DataFrame) -> DataFrame:
    """Candlestick feed."""
    return df.select("symbol", "datetime", "open", "high", "low", "close")


def trend_line(df: DataFrame, name: str | None) -> DataFrame:
    """The chosen trend column rounded to 2 places; nothing for 'none'/None."""
    if name is None or name == NONE_OPTION:
        return df.select("symbol", "datetime", F.lit(None).cast("double").alias("value")).limit(0)
    return df.select("symbol", "datetime",
                     F.round(F.col(name).cast("double"), 2).alias("value"))


def macd_histogram(df: DataFrame) -> DataFrame:
    """``hist = macd - signal`` and its side: 'up' when >= 0, else 'down'."""
    h = F.col("macd").cast("double") - F.col("signal").cast("double")
    return df.select("symbol", "datetime", "macd", "signal", h.alias("hist")).withColumn(
        "side", F.when(F.col("hist") >= 0, F.lit("up")).otherwise(F.lit("down")))


def level_options(df: DataFrame, level: str = "support", distinct: bool = False) -> DataFrame:
    """(symbol, option, rank): 'none' first, then the non-zero levels ascending
    (repeats kept unless ``distinct``); ``rank`` is the place in a symbol's list, from 0.

    Ranks are counted, not sorted: equal levels are one row with their number, levels
    of one whole unit of price are ranked among themselves, and a symbol's units, an
    array of counts, say how many come before.  So no task holds a symbol's levels.
    """
    v = F.col(level).cast("double")
    held = df.groupBy("symbol", F.when(v != 0, v).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    held = held.withColumns({"_n": F.lit(1).cast("long") if distinct else F.col("_n"), "_unit": F.floor("_v")})
    units = held.groupBy("symbol", "_unit").agg(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)).alias("n"))
    lists = units.groupBy("symbol").agg(F.expr("sort_array(collect_list(struct(_unit AS u, n)))").alias("_units"))
    # before each unit: 'none', and the levels of smaller units
    before = F.expr("""aggregate(_units, named_struct('at', 1L, 'out', cast(array() as array<struct<u: bigint, at: bigint>>)),
      (acc, x) -> named_struct('at', acc.at + x.n, 'out', concat(acc.out, array(named_struct('u', x.u, 'at', acc.at)))), acc -> acc.out)""")
    starts = lists.select("symbol", F.explode(before).alias("e")).select(F.col("symbol").alias("_s"), "e.u", "e.at")
    within = Window.partitionBy("symbol", "_unit").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = held.withColumn("_less", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    # an outer join leaves both branches over ``held`` alike, so that it is computed once; rows without a level find no unit
    placed = placed.join(starts, (F.col("symbol") == F.col("_s")) & (F.col("_unit") == F.col("u")), "left")
    ranks = F.explode(F.transform(F.sequence(F.col("at") + F.col("_less"), F.col("at") + F.col("_less") + F.col("_n") - 1), lambda r: r.cast("int")))
    ranked = placed.select("symbol", F.col("_v").cast("string").alias("option"), ranks.alias("rank"))
    # a list is never empty: rank 0, of the same lists as above
    first = F.least(F.size("_units"), F.lit(0)).alias("rank")
    return lists.select("symbol", F.lit(NONE_OPTION).alias("option"), first).unionByName(ranked)


def level_feed(df: DataFrame, level: str = "support") -> DataFrame:
    """Distinct (datetime, level) points with a real (non-zero) level."""
    return (df.select("symbol", "datetime", F.col(level).cast("double").alias(level))
              .where(F.col(level) != 0).dropDuplicates())


def default_symbol(symbols: DataFrame) -> DataFrame:
    """The first listed symbol (deterministic: smallest name)."""
    return symbols.agg(F.min("symbol").alias("symbol"))
