"""What the operators share: reading tables, the shared folder, and expressions evaluated once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from telemill.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: its lineage ends there, so a lost
    executor costs no recomputation beyond this point."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def extended(schema: StructType, **more: DataType) -> StructType:
    """The schema with further fields."""
    return StructType([*schema.fields, *(StructField(name, kind) for name, kind in more.items())])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_bytes(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices with up to `limit` bytes of a text column each, or one longer row."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
