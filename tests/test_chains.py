"""Stages in a chain, saved and loaded."""

import os
import subprocess
import sys

import pytest
from pyspark.ml import Pipeline, PipelineModel

from rankfold import (
    CategoryMapper,
    CategoryMapperModel,
    DropColumn,
    LabelIndexer,
    LabelIndexerModel,
)
from rankfold.functions.schemas import chained_schema

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def index_then_drop():
    return Pipeline(
        stages=[
            LabelIndexer(inputCol="CATEGORY", outputCol="idx"),
            DropColumn(column="CATEGORY"),
        ]
    )


def test_index_then_drop(categories, way):
    model = index_then_drop().fit(categories)
    result = model.transform(categories)
    assert result.columns == ["ID", "idx"]
    assert rows(result) == [(0, 0.0), (1, 1.0), (2, 3.0), (3, 2.0), (4, 0.0)]
    assert chained_schema(model.stages, categories.schema) == result.schema
    assert chained_schema(index_then_drop().getStages(), categories.schema) == result.schema


def test_a_dropped_column_cannot_be_indexed(categories):
    stages = [DropColumn(column="CATEGORY"), LabelIndexer(inputCol="CATEGORY")]
    with pytest.raises(ValueError, match="not one of"):
        chained_schema(stages, categories.schema)
    with pytest.raises(ValueError, match="not one of"):
        Pipeline(stages=stages).fit(categories)


def test_save_and_load_label_model(categories, tmp_path, way):
    path = str(tmp_path / "model")
    model = LabelIndexer(inputCol="CATEGORY", outputCol="idx").fit(categories)
    model.save(path)
    loaded = LabelIndexerModel.load(path)
    assert (loaded.uid, loaded.getInputCol(), loaded.getOutputCol()) == (
        model.uid,
        "CATEGORY",
        "idx",
    )
    assert loaded.mapping_cat == model.mapping_cat
    assert rows(loaded.transform(categories)) == rows(model.transform(categories))
    assert sorted(name for name in os.listdir(path) if name != "hot") == ["data", "metadata"]


def test_overwrite(categories, tmp_path, way):
    path = str(tmp_path / "model")
    model = CategoryMapper(inputCol="CATEGORY", outputCol="idx").fit(categories)
    model.save(path)
    with pytest.raises(Exception, match="(?i)exist"):
        model.save(path)
    expected = rows(model.transform(categories))
    # A loaded model does not depend on the files it came from.
    loaded = CategoryMapperModel.load(path)
    loaded.write().overwrite().save(path)
    assert rows(loaded.transform(categories)) == expected
    assert rows(CategoryMapperModel.load(path).transform(categories)) == expected


def test_default_output_column_survives(categories, tmp_path):
    path = str(tmp_path / "model")
    model = CategoryMapper(inputCol="CATEGORY").fit(categories)
    model.save(path)
    loaded = CategoryMapperModel.load(path)
    assert not loaded.isSet(loaded.outputCol)
    assert loaded.getOutputCol() == model.getOutputCol()


def test_saved_as_another_kind_is_refused(categories, tmp_path):
    path = str(tmp_path / "model")
    LabelIndexer(inputCol="CATEGORY").fit(categories).save(path)
    with pytest.raises(AssertionError):
        CategoryMapperModel.load(path)


def test_save_and_load_nothing_learned(spark, categories, tmp_path, way):
    path = str(tmp_path / "model")
    empty = spark.createDataFrame([], "ID long, CATEGORY string")
    LabelIndexer(inputCol="CATEGORY", outputCol="idx").fit(empty).save(path)
    result = LabelIndexerModel.load(path).transform(categories)
    assert {row["idx"] for row in result.collect()} == {-1.0}


def test_save_and_load_drop(categories, tmp_path):
    path = str(tmp_path / "drop")
    DropColumn(column="ID").write().overwrite().save(path)
    loaded = DropColumn.load(path)
    assert loaded.getDropCol() == "ID"
    assert loaded.transform(categories).columns == ["CATEGORY"]
    path = str(tmp_path / "unset")
    DropColumn().save(path)
    assert DropColumn.load(path).getDropCol() is None


@pytest.mark.parametrize("kind", [LabelIndexer, CategoryMapper])
def test_save_and_load_estimator(categories, tmp_path, kind):
    path = str(tmp_path / "estimator")
    kind(inputCol="CATEGORY", outputCol="idx").save(path)
    loaded = kind.load(path)
    result = loaded.fit(categories).transform(categories)
    assert [row["idx"] for row in result.orderBy("ID").collect()] == [0, 1, 3, 2, 0]


def test_save_and_load_chain(categories, tmp_path, way):
    path = str(tmp_path / "chain")
    model = index_then_drop().fit(categories)
    expected = rows(model.transform(categories))
    model.save(path)
    loaded = PipelineModel.load(path)
    loaded.write().overwrite().save(path)
    assert rows(loaded.transform(categories)) == expected
    assert rows(PipelineModel.load(path).transform(categories)) == expected


def test_save_and_load_unfitted_chain(categories, tmp_path):
    path = str(tmp_path / "chain")
    index_then_drop().save(path)
    assert Pipeline.load(path).fit(categories).transform(categories).columns == ["ID", "idx"]


FRESH = """
import sys
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
frame = spark.createDataFrame([(0, "aa"), (1, "zz"), (2, "cd")]).toDF("ID", "CATEGORY")
result = PipelineModel.load(sys.argv[1]).transform(frame)
print("RESULT", sorted(map(tuple, result.collect())))
"""


def test_load_in_a_fresh_process(categories, tmp_path, settings):
    settings(spark__rankfold__heldLabels=-1)
    path = str(tmp_path / "chain")
    index_then_drop().fit(categories).save(path)
    done = subprocess.run(
        [sys.executable, "-c", FRESH, path],
        capture_output=True,
        text=True,
        timeout=300,
        env={**os.environ, "PYTHONPATH": ROOT},
    )
    assert "RESULT [(0, 0.0), (1, -1.0), (2, 3.0)]" in done.stdout, done.stderr[-2000:]
