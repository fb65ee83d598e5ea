"""Wire codec: JSON text <-> typed bars, symbol and topic naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.schema import SERVED_COLUMNS, WIRE_FIELDS, WIRE_SCHEMA

_PRICE_FIELDS = [f for f in WIRE_FIELDS if f not in ("datetime", "volume")]


def topic_name(c) -> Column:
    """Symbol -> topic / store name: lower case, '/' replaced by '-'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(F.lower(c), F.lit("/"), F.lit("-"))


def with_symbol(df: DataFrame, symbol) -> DataFrame:
    """Attach the symbol a topic or file stands for as a real column."""
    val = F.lit(symbol) if isinstance(symbol, str) else symbol
    return df.withColumn("symbol", val)


def parse_wire(value) -> Column:
    """bytes/text JSON -> struct of 14 strings (permissive: junk gives nulls)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.from_json(value.cast("string"), WIRE_SCHEMA)


def parse_bars(df: DataFrame, value_col: str = "value", price_type: str = "double",
               keep: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Decode wire messages into typed bars.

    Bad numbers or times become null (``try_cast``), never a failed query.
    ``price_type='float'`` reproduces 32-bit prices; the default keeps doubles.
    """
    v = parse_wire(value_col).alias("_v")
    kept = [c for c in keep if c in df.columns]
    p = df.select(*kept, v)
    cols = [F.col("_v.datetime").try_cast("timestamp_ntz").alias("datetime")]
    for f in _PRICE_FIELDS:
        cols.append(F.col(f"_v.{f}").try_cast(price_type).alias(f))
    cols.append(F.col("_v.volume").try_cast("bigint").alias("volume"))
    out = p.select(*kept, *cols)
    order = ["datetime", "open", "high", "low", "close", "volume"] + \
        [c for c in SERVED_COLUMNS if c not in ("datetime", "open", "high", "low", "close", "volume", "sma_20")]
    return out.select(*kept, *order)


def wire_value(df: DataFrame, fields: list[str] | None = None) -> Column:
    """Typed row -> JSON text with every field as a string (the wire form)."""
    fields = fields or [f for f in WIRE_FIELDS if f in df.columns]
    parts = []
    for f in fields:
        c = F.col(f)
        if f == "datetime":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        parts.append(c.cast("string").alias(f))
    return F.to_json(F.struct(*parts))
