"""Unknown values kept out of the shuffle, and ranges of indexes as ranges of labels."""

import pytest
from pyspark.sql import functions as F

from rankfold import CategoryMapper, CategoryMapperModel, LabelIndexer
from rankfold.operators.known_keys import bitmap_bits

SHUFFLED = {"literalLabels": 0, "heldLabels": 0, "oneTaskBytes": 0, "broadcastBytes": 0}


def plan(table):
    return table._jdf.queryExecution().toString()


@pytest.fixture
def values(spark):
    rows = [(i, f"v{i % 500}" if i % 9 else None) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, s string")


@pytest.mark.parametrize("stage", [LabelIndexer, CategoryMapper])
@pytest.mark.parametrize("known", ["s < 'v12'", "s = 'v7'", "true", "false"])
@pytest.mark.parametrize("hot", [0, 8192])
def test_same_rows_as_without_the_bitmap(values, stage, known, hot):
    indexer = stage(inputCol="s", outputCol="idx").setPlanLimits(**SHUFFLED, hotLabels=hot, knownBytes="1m")
    model = indexer.fit(values.where(known))
    got = model.transform(values)
    wanted = model.setPlanLimits(**SHUFFLED, hotLabels=hot).transform(values)
    assert got.schema == wanted.schema
    assert sorted(got.collect(), key=str) == sorted(wanted.collect(), key=str)


def test_numbers_of_other_types_and_replaced_columns(spark):
    keys = spark.range(0, 4000, 7).select(F.col("id").cast("int").alias("k"))
    rows = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("other"))
    mapper = CategoryMapper(inputCol="k", outputCol="k").setPlanLimits(**SHUFFLED, knownBytes="1m")
    got = mapper.fit(keys).transform(rows)
    assert got.columns == ["k", "other"]
    assert {(r.other // 2, r.k) for r in got.collect()} == {(i, i // 7 if i % 7 == 0 else None) for i in range(4000)}


def test_few_unknown_rows_pass_the_bitmap(spark):
    from rankfold.operators.known_keys import may_be_known

    keys = spark.range(20_000).select(F.col("id").alias("k"))
    model = CategoryMapper(inputCol="k", outputCol="i").setPlanLimits(**SHUFFLED).fit(keys)
    rows = spark.range(0, 120_000).select(F.col("id").alias("k"))
    marked = may_be_known(rows, F.col("k"), rows.schema["k"].dataType, model._mapping, "mark")
    assert marked.where("k < 20000 and not mark").count() == 0
    assert marked.where("k >= 20000 and mark").count() < 100_000 * 0.08


def test_a_bitmap_too_large_is_not_built(values):
    indexer = CategoryMapper(inputCol="s", outputCol="idx").setPlanLimits(**SHUFFLED, knownBytes=bitmap_bits(500) // 8 - 1)
    assert "bitmap_construct_agg" not in plan(indexer.fit(values).transform(values))
    indexer.setPlanLimits(**SHUFFLED, knownBytes=bitmap_bits(500) // 8)
    assert "bitmap_construct_agg" in plan(indexer.fit(values).transform(values))


@pytest.mark.parametrize("low, high", [(3, 9), (0, 0), (-1, 2), (-5, -2), (490, 9999), (7, 3)])
@pytest.mark.parametrize("order", ["codepoint", "utf16"])
def test_between_is_a_filter_on_the_index(values, low, high, order):
    model = LabelIndexer(inputCol="s", outputCol="idx").setTextOrder(order).fit(values)
    got = model.transform_between(values, low, high)
    wanted = model.transform(values).where(F.col("idx").between(low, high))
    assert sorted(got.collect(), key=str) == sorted(wanted.collect(), key=str)


def test_between_with_a_given_mapping_without_order(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "s string")
    model = CategoryMapperModel.from_mapping({"a": 5, "b": 1, "c": 9, "d": 2}, inputCol="s", outputCol="i")
    assert {r.s for r in model.transform_between(rows, 1, 2).collect()} == {"b", "d"}
    assert model.transform_between(rows, 6, 8).count() == 0


def test_between_reaches_the_scan(spark, values, tmp_path):
    values.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    model = LabelIndexer(inputCol="s", outputCol="idx").setPlanLimits(**SHUFFLED).fit(rows)
    shown = plan(model.transform_between(rows, 4, 10))
    assert "GreaterThanOrEqual(s,v101)" in shown and "LessThanOrEqual(s,v107)" in shown
