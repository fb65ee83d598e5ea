"""Bar streams from files (the stand-in for a topic per symbol)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.functions.parse import parse_bars
from barsmith.functions.timefns import to_ntz
from barsmith.schema import BAR_SCHEMA


def event_time(df: DataFrame, col: str = "datetime") -> DataFrame:
    """Wall-clock NTZ time -> TIMESTAMP, which watermarks require."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def wall_time(df: DataFrame, col: str = "datetime") -> DataFrame:
    """TIMESTAMP -> wall-clock NTZ for output."""
    return df.withColumn(col, to_ntz(col))


def bar_file_stream(spark: SparkSession, path: str, schema: T.StructType,
                    max_files_per_trigger: int | None = None,
                    glob: str | None = None) -> DataFrame:
    """Parquet files of bars as a stream; ``datetime`` becomes event time."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return event_time(r.parquet(path))


def wire_file_stream(spark: SparkSession, path: str, price_type: str = "double",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files of (symbol, value) wire messages -> typed bars.

    Stands in for one subscription over all symbol topics: a malformed
    message becomes a row of nulls and never stops the query.
    """
    r = spark.readStream.schema("symbol string, value string")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    bars = parse_bars(r.json(path), "value", price_type)
    return event_time(bars.where(F.col("datetime").isNotNull()))


def heartbeat(spark: SparkSession, path: str, bars: DataFrame, delay: str) -> None:
    """Write a row without a symbol whose time lies so far after ``bars`` that,
    with the watermark's delay, all of them are behind the watermark."""
    at = F.max("datetime") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 second")
    bars.agg(at.alias("datetime")).where("datetime is not null").select(
        *[F.col("datetime") if f.name == "datetime" else F.lit(None).cast(f.dataType).alias(f.name) for f in bars.select(*BAR_SCHEMA.names).schema]
    ).write.parquet(path)
