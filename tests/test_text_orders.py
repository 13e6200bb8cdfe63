"""Text by collation and by UTF-16 units, and mappings dealt into buckets."""

import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from rankfold import CategoryMapper, CategoryMapperModel, IndexPipeline, LabelIndexer, LabelIndexerModel
from rankfold.streaming import write_transformed

LARGE = {"heldLabels": -1, "oneTaskBytes": -1, "broadcastBytes": -1, "hotLabels": 0}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def pairs(model):
    return [(r.category, r.idx) for r in model.mapping.orderBy("idx").collect()]


@pytest.mark.parametrize("collation", ["UTF8_LCASE", "UNICODE_CI"])
def test_equal_texts_share_an_index(spark, way, collation):
    texts = ["b", "A", "a", None, "C", "B", "", "a", "c"] * 3
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    frame = frame.select("id", F.collate("t", collation).alias("t"))
    model = CategoryMapper(inputCol="t", outputCol="i").fit(frame)
    # The first by code point stands for its equals.
    assert pairs(model) == [("", 0), ("A", 1), ("B", 2), ("C", 3)]
    wanted = {"": 0, "a": 1, "b": 2, "c": 3}
    got = model.transform(frame).collect()
    assert len(got) == 27 and all(r.i == (None if r.t is None else wanted[r.t.lower()]) for r in got)
    more = spark.createDataFrame([("AA",), ("c",)], "t string").select(F.collate("t", collation).alias("t"))
    assert {r.t: r.i for r in model.transform(more).collect()} == {"AA": None, "c": 3}


def test_collated_models_are_saved_and_strict_about_types(spark, tmp_path):
    frame = spark.createDataFrame([("x",), ("X",), ("y",)], "t string").select(F.collate("t", "UTF8_LCASE").alias("t"))
    path = str(tmp_path / "m")
    LabelIndexer(inputCol="t", outputCol="i").fit(frame).save(path)
    loaded = LabelIndexerModel.load(path)
    assert sorted(r.i for r in loaded.transform(frame).collect()) == [0.0, 0.0, 1.0]
    with pytest.raises(ValueError, match="keys"):
        loaded.transform(frame.select(F.collate("t", "UTF8_BINARY").alias("t")))
    with pytest.raises(ValueError, match="order"):
        CategoryMapper(inputCol="a").fit(frame.select(F.array("t").alias("a")))
    given = CategoryMapperModel.from_mapping(frame.where("t = 'y'").select("t", F.lit(5)), "t", "i")
    assert sorted((r.t, r.i) for r in given.transform(frame).collect()) == [("X", None), ("x", None), ("y", 5)]
    with pytest.raises(ValueError, match="more than once"):
        CategoryMapperModel.from_mapping(frame.select("t", F.lit(5)), "t", "i")


def test_utf16_order(spark, way, tmp_path):
    texts = ["\U0001f600", "～", "", "z", "é", "\U0001f600a", "퟿", "", "\U0010ffff", "z\U00010000", "z￮"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    units = sorted(texts, key=lambda t: t.encode("utf-16-be"))
    assert units != sorted(texts)
    indexer = LabelIndexer(inputCol="t", outputCol="i").setTextOrder("utf16")
    model = indexer.fit(frame)
    assert [t for t, _ in pairs(model)] == units
    assert {r.t: r.i for r in model.transform(frame).collect()} == {t: float(i) for i, t in enumerate(units)}
    model.save(str(tmp_path / "m"))
    assert LabelIndexerModel.load(str(tmp_path / "m")).getTextOrder() == "utf16"
    both = IndexPipeline(stages=[indexer, CategoryMapper(inputCol="t", outputCol="j")]).fit(frame).stages
    assert [t for t, _ in pairs(both[0])] == units and [t for t, _ in pairs(both[1])] == sorted(texts)


def test_utf16_order_is_for_plain_text(spark):
    with pytest.raises(ValueError, match="text order"):
        LabelIndexer(inputCol="t").setTextOrder("utf8")
    with pytest.raises(ValueError, match="UTF-16"):
        CategoryMapper(inputCol="id").setTextOrder("utf16").fit(spark.range(3))


@pytest.fixture
def keyed(spark):
    return spark.range(0, 3000, 1, 6).select(
        "id", F.when(F.col("id") % 3 != 0, F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("c")
    )


def expected(keyed):
    labels = sorted({r.c for r in keyed.collect() if r.c})
    return {label: float(i) for i, label in enumerate(labels)}


@pytest.fixture
def no_broadcast(settings):
    settings(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__enabled="false")


def exchanges(frame):
    return plan(frame).count("Exchange hashpartitioning")


def test_only_rows_are_shuffled_and_nulls_spread(spark, keyed, no_broadcast, tmp_path):
    model = LabelIndexer(inputCol="c", outputCol="i").setPlanLimits(**LARGE).fit(keyed)
    assert exchanges(model.transform(keyed)) == 2
    dealt = model.co_partition(8)
    result = dealt.transform(keyed)
    assert exchanges(result) == 1 and "Bucketed: true" in plan(result)
    wanted = expected(keyed)
    assert {(r.c, r.i) for r in result.collect()} == {(None, -1.0), *wanted.items()}
    assert result.columns == ["id", "c", "i"] and result.count() == 3000
    sizes = [r["count"] for r in result.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("count"), F.max("i")).collect()]
    assert max(sizes) < 0.3 * 3000
    assert "Join" not in result.select("id")._jdf.queryExecution().optimizedPlan().toString()
    # Saved, loaded, overwritten by itself, and in a chain.
    path = str(tmp_path / "m")
    dealt.write().overwrite().save(path)
    loaded = LabelIndexerModel.load(path)
    assert exchanges(loaded.transform(keyed)) == 1
    loaded.write().overwrite().save(path)
    again = LabelIndexerModel.load(path).transform(keyed)
    assert exchanges(again) == 1 and sorted(again.collect()) == sorted(result.collect())
    chain = PipelineModel([dealt])
    chain.write().overwrite().save(str(tmp_path / "chain"))
    in_chain = PipelineModel.load(str(tmp_path / "chain")).transform(keyed)
    assert exchanges(in_chain) == 1 and sorted(in_chain.collect()) == sorted(result.collect())
    dealt.release()
    assert sorted(again.collect()) == sorted(in_chain.collect())


def test_buckets_of_other_types_and_small_mappings(spark, settings, no_broadcast):
    days = spark.range(400).select("id", F.expr("date_add(date'2020-01-01', cast(id % 90 as int))").alias("d"))
    mapper = CategoryMapper(inputCol="d", outputCol="i")
    model = mapper.copy().setPlanLimits(**LARGE).fit(days).co_partition(4)
    assert exchanges(model.transform(days)) == 1
    assert all(r.i == r.id % 90 for r in model.transform(days).collect())
    assert mapper.fit(days).co_partition(4)._mapping.buckets is None
    narrow = spark.range(50).select(F.col("id").cast("int").alias("k"))
    numbers = CategoryMapper(inputCol="k", outputCol="i").setPlanLimits(**LARGE).fit(narrow).co_partition(4)
    # Keys of another width are looked up in the ordinary way.
    assert sorted(r.i for r in numbers.transform(spark.range(50).select(F.col("id").alias("k"))).collect()) == list(range(50))


def test_larger_mappings_get_more_buckets_and_rows_are_not_sorted(spark, settings, keyed, no_broadcast, tmp_path):
    wanted = {(None, -1.0), *expected(keyed).items()}
    found = {}
    for size in ("16m", "4k", "0"):
        indexer = LabelIndexer(inputCol="c", outputCol="i").setPlanLimits(**LARGE, bucketBytes=size)
        indexer.fit(keyed).co_partition(4).save(str(tmp_path / size))
        model = LabelIndexerModel.load(str(tmp_path / size))
        result = model.transform(keyed)
        assert {(r.c, r.i) for r in result.collect()} == wanted and result.count() == 3000
        assert result.rdd.getNumPartitions() == model._mapping.buckets.count
        found[size] = (model._mapping.buckets.count, "SortMergeJoin" in plan(result), exchanges(result))
    # 500 labels, counted as 64 bytes and their text each, are over two times four buckets of 4 KiB.
    assert found == {"16m": (4, False, 1), "4k": (12, False, 1), "0": (4, True, 1)}
    settings(spark__sql__sources__bucketing__maxBuckets=10)
    few = LabelIndexer(inputCol="c", outputCol="i").setPlanLimits(**LARGE, bucketBytes="4k").fit(keyed).co_partition(4)
    # More than Spark allows: the buckets are larger than one task is to hold.
    assert few._mapping.buckets.count == 8 and "SortMergeJoin" in plan(few.transform(keyed))
    assert {(r.c, r.i) for r in few.transform(keyed).collect()} == wanted


@pytest.mark.parametrize("kind", ["string", "bigint", "smallint", "tinyint"])
def test_rows_without_a_key_reach_most_buckets(spark, keyed, no_broadcast, kind):
    known = spark.range(100).select(F.col("id").cast(kind).alias("c"))
    model = CategoryMapper(inputCol="c", outputCol="i").setPlanLimits(**LARGE).fit(known).co_partition(150)
    blank = spark.range(0, 900, 1, 300).select("id", F.when(F.col("id") < 0, F.col("id").cast(kind)).alias("c"))
    result = model.transform(blank)
    places = {r.place for r in result.select(F.spark_partition_id().alias("place"), "i").collect()}
    # 300 partitions with such rows; a tinyint has no names for that many.
    assert len(places) > (40 if kind == "tinyint" else 100)
    assert result.where("i IS NULL").count() == 900


def test_micro_batches_do_not_shuffle_the_mapping(spark, keyed, no_broadcast, tmp_path):
    keyed.write.parquet(str(tmp_path / "rows"))
    model = LabelIndexer(inputCol="c", outputCol="i").setPlanLimits(**LARGE).fit(keyed).co_partition(4)
    stream = spark.readStream.schema(keyed.schema).parquet(str(tmp_path / "rows"))
    query = write_transformed(model, stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    wanted = expected(keyed)
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(out) == 3000 and all(r.i == wanted.get(r.c, -1.0) for r in out)
