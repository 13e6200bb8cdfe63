"""Input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(table_path(folder, name))


def read_table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a file stream."""
    schema = read_table(spark, folder, name).schema
    # A glob names a table kept as one file as well as one kept as a folder.
    path = table_path(folder, name).removesuffix("t") + "[t]"
    return spark.readStream.schema(schema).parquet(path)
