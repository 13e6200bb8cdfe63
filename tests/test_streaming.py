"""Fitted stages on streams."""

import pytest
from pyspark.ml import Pipeline

from rankfold import CategoryMapper, CategoryMapperModel, DropColumn, LabelIndexer
from rankfold.sources.tables import read_table, read_table_stream
from rankfold.streaming import write_transformed

ROWS = [(0, "aa"), (1, "ab"), (2, None), (3, "zz"), (4, "aa")]


@pytest.fixture
def folder(spark, tmp_path):
    """A data folder whose table is a folder of several files."""
    rows = spark.createDataFrame(ROWS, "ID long, CATEGORY string")
    rows.repartition(3).write.parquet(str(tmp_path / "rows.parquet"))
    return str(tmp_path)


def test_stream_gives_the_rows_of_the_batch(spark, categories, folder, way):
    stages = [
        LabelIndexer(inputCol="CATEGORY", outputCol="i"),
        CategoryMapper(inputCol="CATEGORY", outputCol="j"),
        DropColumn(column="CATEGORY"),
    ]
    model = Pipeline(stages=stages).fit(categories)
    out, progress = f"{folder}/out", f"{folder}/progress"
    stream = read_table_stream(spark, folder, "rows")
    assert stream.isStreaming
    write_transformed(model, stream, out, progress).awaitTermination()
    expected = [(0, 0.0, 0), (1, 1.0, 1), (2, -1.0, None), (3, -1.0, None), (4, 0.0, 0)]
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == expected
    # A second run finds only what arrived in between.
    more = spark.createDataFrame([(9, "cd")], "ID long, CATEGORY string")
    more.write.mode("append").parquet(f"{folder}/rows.parquet")
    write_transformed(model, stream, out, progress).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == [*expected, (9, 3.0, 3)]
    assert read_table(spark, folder, "rows").count() == 6


def test_fit_needs_a_table(spark, folder):
    stream = read_table_stream(spark, folder, "rows")
    with pytest.raises(ValueError, match="batch"):
        LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(stream)
    with pytest.raises(ValueError, match="batch"):
        CategoryMapperModel.from_mapping(stream.select("CATEGORY", "ID"))
