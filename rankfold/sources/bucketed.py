"""Mappings dealt by key into buckets, which a join reads without shuffling them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Spark refuses tables of more buckets than this setting says.
MOST_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"


@dataclass(frozen=True)
class Buckets:
    """A table ``category, idx`` of the session's catalog, over files that outlive it."""

    table: str
    count: int
    folder: str

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def forget(self, spark: SparkSession) -> None:
        """Take the table off the catalog; its files stay."""
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def write_buckets(frame: DataFrame, folder: str, count: int) -> Buckets:
    """Write ``category, idx`` in ``count`` buckets by category, one file each."""
    buckets = Buckets(_new_name(), count, folder)
    dealt = frame.repartition(count, "category").write.format("parquet")
    dealt.bucketBy(count, "category").sortBy("category").option("path", folder).saveAsTable(buckets.table)
    return buckets


def read_buckets(spark: SparkSession, folder: str, schema: T.StructType, count: int) -> Buckets:
    """Name files that ``write_buckets`` has written in this session's catalog."""
    buckets = Buckets(_new_name(), count, folder)
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {buckets.table} ({columns}) USING parquet "
        f"CLUSTERED BY (category) SORTED BY (category) INTO {count} BUCKETS LOCATION '{place}'"
    )
    return buckets


def _new_name() -> str:
    return f"rankfold_{uuid.uuid4().hex}"
