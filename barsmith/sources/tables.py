"""Typed views over the input tables.

``events`` supplies ticks (symbol = event_type); ``orders`` supplies many short
series (symbol = customer).  All readers project only what they use so the
parquet scan prunes columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, datetime, tick_id, price) from ``events``; nulls dropped."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type").isNotNull() & F.col("ts").isNotNull()
                     & F.col("value").isNotNull())
              .select(F.col("event_type").alias("symbol"), F.col("ts").alias("datetime"),
                      F.col("event_id").alias("tick_id"), F.col("value").alias("price")))


def seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one observation of a long series: (symbol, datetime, tick_id, close)."""
    return ticks(spark, sf_dir).withColumnRenamed("price", "close")


def short_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short series from ``orders``: one per customer, tie broken by order key."""
    o = table(spark, sf_dir, "orders")
    return (o.where(F.col("o_custkey").isNotNull() & F.col("o_orderdate").isNotNull()
                    & F.col("o_totalprice").isNotNull())
             .select(F.col("o_custkey").cast("string").alias("symbol"),
                     F.col("o_orderdate").alias("datetime"),
                     F.col("o_orderkey").alias("tick_id"),
                     F.col("o_totalprice").alias("close")))


def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly OHLCV bars resampled from the ``events`` ticks."""
    from barsmith.operators.bars import resample_ohlcv
    return resample_ohlcv(ticks(spark, sf_dir), "1 hour")
