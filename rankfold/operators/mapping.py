"""A frozen mapping from category to index.

A mapping never changes after it was learned, given or loaded. A small one, with
its rows and bytes counted first, is an Arrow table on the driver. Any other is
a table on shared storage that only executors read.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.functions.labels import stored_bytes
from rankfold.functions.schemas import is_collated
from rankfold.operators.limits import Limits
from rankfold.sources.bucketed import Buckets
from rankfold.sources.store import new_folder

# Memory a broadcast entry takes besides the key's own bytes: row header, index,
# hash slot.
_ENTRY_BYTES = 64

# ``monotonically_increasing_id`` holds the partition above this bit, the row below.
SLICE_BITS = 33

# Types that reach Arrow and come back unchanged.
_ARROW_EXACT = (
    T.StringType,
    T.BinaryType,
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


@dataclass(frozen=True)
class Mapping:
    key_type: T.DataType
    index_type: T.DataType
    labels: int
    key_bytes: int
    # Small mapping: columns category, idx.
    held: pa.Table | None = None
    # Written mapping: columns category, idx, or category, position together with
    # the index at which each slice starts: columns slice, start.
    folder: str | None = None
    slice_starts: pa.Table | None = None
    # Hashes of the values that fill the most rows of a table.
    hot: tuple[int, ...] = ()
    # Whether the folder is a working table, which may be removed.
    own_folder: bool = True
    # The same entries once more, dealt by key.
    buckets: Buckets | None = None

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("category", self.key_type),
                T.StructField("idx", self.index_type),
            ]
        )

    def frame(self, spark: SparkSession) -> DataFrame:
        """All of the mapping as a table ``category, idx``."""
        if self.held is not None:
            return spark.createDataFrame(self.held, self.schema())
        if self.slice_starts is None:
            return spark.read.schema(self.schema()).parquet(self.folder)
        ranked = read_positions(spark, self.folder, self.key_type)
        row = F.col("position").bitwiseAND(F.lit((1 << SLICE_BITS) - 1))
        # One row for each written slice, so no more than the sort had partitions.
        starts = spark.createDataFrame(self.slice_starts)
        return ranked.join(
            F.broadcast(starts), F.shiftright("position", SLICE_BITS) == F.col("slice")
        ).select("category", (row + F.col("start")).cast(self.index_type).alias("idx"))

    def hot_frame(self, spark: SparkSession) -> DataFrame:
        """The frequent values' hashes, a column ``hash``: no more than ``hotLabels``."""
        return spark.createDataFrame(pa.table({"hash": pa.array(self.hot, pa.int64())}))

    def pairs(self) -> list[tuple]:
        """The entries of a held mapping in index order."""
        columns = (self.held.column(name).to_pylist() for name in ("category", "idx"))
        return sorted(zip(*columns), key=lambda pair: pair[1])

    def broadcastable(self, limits: Limits) -> bool:
        size = memory_bytes(self.labels, self.key_bytes)
        return self.held is not None or size <= limits.broadcast_bytes

    def bucket_count(self, least: int, most: int, limits: Limits) -> int:
        """The first multiple of ``least`` that keeps buckets within their size, or the last up to ``most``."""
        if limits.bucket_bytes < 1:
            return least
        times = -(-memory_bytes(self.labels, self.key_bytes) // (least * limits.bucket_bytes))
        return least * max(1, min(times, most // least))

    def buckets_fit(self, limits: Limits) -> bool:
        """Whether one task may hold a bucket."""
        return memory_bytes(self.labels, self.key_bytes) <= self.buckets.count * limits.bucket_bytes


def read_positions(spark: SparkSession, folder: str, key_type: T.DataType) -> DataFrame:
    schema = T.StructType(
        [T.StructField("category", key_type), T.StructField("position", T.LongType())]
    )
    return spark.read.schema(schema).parquet(folder)


def reaches_arrow(key_type: T.DataType) -> bool:
    return isinstance(key_type, _ARROW_EXACT) and not is_collated(key_type)


def may_hold(key_type: T.DataType, labels: int, key_bytes: int, limits: Limits) -> bool:
    """Whether a mapping of this counted size may live on the driver."""
    if isinstance(key_type, T.NullType):
        return True
    return (
        reaches_arrow(key_type)
        and labels <= limits.held_labels
        and key_bytes <= limits.held_bytes
    )


def memory_bytes(labels: int, key_bytes: int) -> int:
    """What a mapping of this counted size takes in memory."""
    return key_bytes + _ENTRY_BYTES * labels


def freeze(
    frame: DataFrame, index_type: T.DataType, counted: tuple[int, int], limits: Limits
) -> Mapping:
    """Fix the content of a table ``category, idx`` whose categories are unique."""
    spark = frame.sparkSession
    key_type = frame.schema["category"].dataType
    frame = frame.select("category", F.col("idx").cast(index_type).alias("idx"))
    labels, key_bytes = counted
    if may_hold(key_type, labels, key_bytes, limits):
        return Mapping(key_type, index_type, labels, key_bytes, held=frame.toArrow())
    folder = new_folder(spark, "mapping")
    frame.write.parquet(folder)
    return Mapping(key_type, index_type, labels, key_bytes, folder=folder)


def freeze_given(frame: DataFrame, index_type: T.DataType, limits: Limits) -> Mapping:
    """Freeze a mapping somebody supplied, after checking that it is one."""
    if frame.isStreaming:
        raise ValueError("a mapping needs a batch table")
    if len(frame.columns) != 2:
        raise ValueError(f"a mapping has two columns, category and index, not {frame.columns}")
    given = frame.toDF("category", "idx").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        key_type = given.schema["category"].dataType
        index = F.col("idx")
        # There and back again: what changes on the way is no index.
        exact = index.try_cast(index_type).try_cast(given.schema["idx"].dataType).eqNullSafe(index)
        rows, keys, indexes, changed, key_bytes = given.agg(
            F.count(F.lit(1)),
            F.count("category"),
            F.count("idx"),
            F.count_if(~exact),
            F.coalesce(F.sum(stored_bytes(F.col("category"), key_type)), F.lit(0)),
        ).head()
        if keys < rows or indexes < rows:
            raise ValueError("a mapping has no null category and no null index")
        if changed:
            raise ValueError(f"{changed} indexes are no {index_type.simpleString()} values")
        repeated = given.groupBy("category").count().where("count > 1").take(1)
        if repeated:
            raise ValueError(f"category {repeated[0]['category']!r} is mapped more than once")
        return freeze(given, index_type, (rows, key_bytes), limits)
    finally:
        given.unpersist()
