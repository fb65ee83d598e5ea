"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.session import ensure_checkpoint_dir, scratch_path, ship_package

#: Text bytes that a task turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """The shared folder and the package in the workers, before any Python stage."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def materialise(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(col: str, folds: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``folds`` (null ids: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(folds)


def first_by_hash(df: DataFrame, group: str, id_col: str, limit: int, salts: int = 64) -> DataFrame:
    """At most ``limit`` rows of each group, those whose ids have the least hashes.

    The first cut is by (group, salt), so that no task ranks a whole group; at
    most ``limit * salts`` rows of a group are left for the second.
    """
    order = [F.xxhash64(id_col), F.col(id_col)]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(id_col, F.lit("salt")), F.lit(salts)))
    for by in (Window.partitionBy(group, "_salt"), Window.partitionBy(group)):
        salted = salted.withColumn("_n", F.row_number().over(by.orderBy(*order))).where(F.col("_n") <= limit).drop("_n")
    return salted.drop("_salt")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text, one row at least."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with more columns."""
    names = [*batch.schema.names, *columns]
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=names)


def plus(df: DataFrame, ddl: str, drop: str | None = None) -> T.StructType:
    """Schema of ``df`` (without one column) and of more columns after it."""
    return T.StructType([*(f for f in df.schema.fields if f.name != drop), *T.StructType.fromDDL(ddl).fields])
