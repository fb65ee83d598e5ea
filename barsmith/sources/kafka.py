"""Kafka source and sink for the bar wire format.

Needs the ``spark-sql-kafka`` connector on the classpath at run time; the
codec parts (``encode_for_kafka``, ``parse_bars``) are plain Catalyst and are
what the tests exercise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.parse import parse_bars, topic_name, wire_value, with_symbol
from barsmith.schema import WIRE_FIELDS


def kafka_reader_options(servers: str, topics: list[str] | str,
                         starting_offsets: str = "earliest",
                         max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``: one query over many topics,
    lost offsets tolerated, replay from the earliest offset by default."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "failOnDataLoss": "false",
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_kafka(spark: SparkSession, servers: str, topics: list[str] | str,
               starting_offsets: str = "earliest", price_type: str = "double",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Typed bar stream; the topic name supplies the ``symbol`` column."""
    raw = (spark.readStream.format("kafka")
           .options(**kafka_reader_options(servers, topics, starting_offsets,
                                           max_offsets_per_trigger)).load())
    return decode_kafka(raw, price_type)


def decode_kafka(raw: DataFrame, price_type: str = "double") -> DataFrame:
    """Typed bars of (topic, value) rows as Kafka gives them, values as bytes or text."""
    return parse_bars(with_symbol(raw, F.col("topic")), "value", price_type)


def encode_for_kafka(df: DataFrame, incomplete: str = "keep") -> DataFrame:
    """(topic, key, value) rows: topic per symbol, JSON text with string fields.

    A missing value has no field in the text.  ``incomplete`` says what becomes of rows
    with one, or without a symbol: ``keep``, ``drop``, or ``error``, which fails the job.
    """
    if incomplete not in ("keep", "drop", "error"):
        raise ValueError("incomplete is keep, drop or error")
    lacks = F.lit(False)
    for c in ["symbol", *[f for f in WIRE_FIELDS if f in df.columns]]:
        lacks = lacks | F.col(c).isNull()
    value = wire_value(df)
    if incomplete == "drop":
        df = df.where(~lacks)
    elif incomplete == "error":
        said = F.concat(F.lit("a bar of "), F.coalesce(F.col("symbol").cast("string"), F.lit("no symbol")), F.lit(" lacks a field: "), value)
        value = F.when(lacks, F.raise_error(said)).otherwise(value)
    return df.select(topic_name("symbol").alias("topic"), F.col("symbol").cast("string").alias("key"), value.alias("value"))


def write_kafka(df: DataFrame, servers: str, checkpoint: str | None = None, incomplete: str = "error"):
    """Publish bars; batch frames are written, streaming frames start a query,
    which needs a checkpoint.  Incomplete bars are refused unless ``incomplete`` says otherwise."""
    enc = encode_for_kafka(df, incomplete)
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming query needs a checkpoint folder")
        w = (enc.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .outputMode("append").option("checkpointLocation", checkpoint))
        return w.start()
    enc.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    return None
