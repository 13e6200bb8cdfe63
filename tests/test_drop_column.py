"""Dropping a column as a stage."""

import pytest
from pyspark.sql import functions as F

from rankfold import DropColumn, LabelIndexer


def test_drops(categories):
    assert DropColumn().setDropCol("ID").transform(categories).columns == ["CATEGORY"]
    assert DropColumn(column="CATEGORY").transform(categories).columns == ["ID"]
    assert DropColumn("CATEGORY").transform(categories).columns == ["ID"]


@pytest.mark.parametrize("column", ["absent", "", None, "ID.x"])
def test_nothing_to_drop(categories, column):
    stage = DropColumn(column=column)
    result = stage.transform(categories)
    assert result.columns == ["ID", "CATEGORY"]
    assert stage.output_schema(categories.schema) == result.schema
    assert result.count() == 5


def test_every_match_goes(spark):
    frame = spark.range(1).select(
        F.lit(1).alias("x"), F.lit(2).alias("X"), F.lit(3).alias("y"), F.lit(4).alias("a.b")
    )
    for column, left in [("x", ["y", "a.b"]), ("a.b", ["x", "X", "y"]), ("y", ["x", "X", "a.b"])]:
        stage = DropColumn(column=column)
        assert stage.transform(frame).columns == left
        assert stage.output_schema(frame.schema).names == left


def test_case_sensitive_session(spark, settings):
    settings(spark__sql__caseSensitive="true")
    frame = spark.range(1).select(F.lit(1).alias("x"), F.lit(2).alias("X"))
    stage = DropColumn(column="x")
    assert stage.transform(frame).columns == ["X"]
    assert stage.output_schema(frame.schema).names == ["X"]
    labels = spark.createDataFrame([("a", 1)], "c string, x int")
    model = LabelIndexer(inputCol="c", outputCol="X").fit(labels)
    result = model.transform(labels)
    assert result.columns == ["c", "x", "X"]
    assert result.schema == model.output_schema(labels.schema)


def test_params():
    stage = DropColumn()
    assert stage.getDropCol() is None
    assert stage.setDropCol("a") is stage
    assert stage.getDropCol() == "a"
    assert stage.setParams(column="b").getDropCol() == "b"
    assert stage.copy({stage.column: "c"}).getDropCol() == "c"
    assert repr(stage) == f"DropColumn: uid={stage.uid}, column=b"
