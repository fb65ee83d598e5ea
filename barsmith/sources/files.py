"""File sources: bar loads, supplier payloads, the serving store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.functions.timefns import open_interval
from barsmith.operators.bars import latest_n_per_symbol
from barsmith.schema import BAR_SCHEMA, HIDDEN_SUFFIXES, NONE_OPTION, NOT_TRENDS, PAYLOAD_SCHEMA


def load_bars(spark: SparkSession, path: str, symbols: list[str] | None = None,
              output_size: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Historical bars from files: the allowed symbols, newest ``output_size`` each."""
    reader = spark.read.format(fmt)
    if fmt != "parquet":
        reader = reader.schema(BAR_SCHEMA)
    df = reader.load(path)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    if output_size is not None:
        df = latest_n_per_symbol(df, output_size)
    return df


def explode_payload(df: DataFrame, col: str = "payload", symbol: str | None = None) -> DataFrame:
    """Supplier payload JSON -> bar rows (typed, oldest-first order is by datetime).

    Accepts the keyed form ``{"SYM": [bars...]}`` or, with ``symbol`` given,
    a bare newest-first list for that one symbol.
    """
    text = F.col(col).cast("string")
    if symbol is not None:
        arr = F.from_json(text, "array<struct<datetime:string,open:string,close:string,"
                                "high:string,low:string,volume:string>>")
        m = F.create_map(F.lit(symbol), arr)
    else:
        m = F.from_json(text, PAYLOAD_SCHEMA)
    e = df.select(F.explode(m).alias("symbol", "_bars"))
    e = e.select("symbol", F.inline("_bars"))
    return e.select(
        "symbol",
        F.col("datetime").try_cast("timestamp_ntz").alias("datetime"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").try_cast("bigint").alias("volume"))


def write_serving(df: DataFrame, path: str, mode: str = "append") -> None:
    """Batch write of served bars, one directory per symbol and day, each written
    by one task in time order."""
    dated = df.withColumn("date", F.to_date("datetime")).repartition("symbol", "date")
    dated.sortWithinPartitions("symbol", "date", "datetime").write.mode(mode).partitionBy("symbol", "date").parquet(path)


#: Types of the columns that are folder names; Spark would guess them from the names ("0700" a number).
_FOLDER_TYPES = {"symbol": T.StringType(), "date": T.DateType(), "_epoch": T.LongType()}


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """A store of bars with its symbols as text, however they look."""
    found = spark.read.parquet(path).schema
    typed = T.StructType([T.StructField(f.name, _FOLDER_TYPES.get(f.name, f.dataType), f.nullable) for f in found.fields])
    return spark.read.schema(typed).parquet(path)


def scan(spark: SparkSession, path: str, symbol: str | None = None, as_of=None,
         days: float | None = None) -> DataFrame:
    """Serving-store scan: prunes to the directories of the symbol and the days,
    pushes the time bound.  ``as_of`` and ``days`` go together."""
    if (as_of is None) != (days is None):
        raise ValueError("as_of and days go together")
    df = read_store(spark, path)
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if as_of is not None:
        df = df.where(open_interval("datetime", as_of, days))
        if "date" in df.columns:
            last = F.lit(as_of).cast("timestamp_ntz")
            first = last - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days * 86400.0))
            df = df.where((F.col("date") >= F.to_date(first)) & (F.col("date") <= F.to_date(last)))
    return df.drop("date")


def list_symbols(df: DataFrame) -> DataFrame:
    """Distinct symbols, hiding level-list names."""
    s = df.select("symbol").distinct()
    for suf in HIDDEN_SUFFIXES:
        s = s.where(~F.col("symbol").endswith(suf))
    return s


def trend_columns(df: DataFrame) -> DataFrame:
    """Columns that can be drawn as a trend line (those holding any value in
    the store), plus 'none' last.  One aggregate pass, then an unpivot."""
    names = [c for c in df.columns if c not in NOT_TRENDS and c != "symbol"]
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in names])
    rows = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("trend"), F.lit(i).alias("pos"), F.col(c).alias("n"))
        for i, c in enumerate(names)] + [
        F.struct(F.lit(NONE_OPTION).alias("trend"), F.lit(len(names)).alias("pos"),
                 F.lit(1).cast("bigint").alias("n"))])))
    return rows.where(F.col("n") > 0).select("trend", "pos")
