"""A fitted stage on a stream of rows, into Parquet files."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_transformed(
    stage: Transformer, rows: DataFrame, folder: str, checkpoint: str
) -> StreamingQuery:
    """Start a query that transforms all rows available now and appends them to ``folder``.

    The stages keep no state: each micro-batch meets the frozen mapping by itself.
    """
    return (
        stage.transform(rows)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(folder)
    )
