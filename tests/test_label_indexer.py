"""Text labels to double indexes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold import LabelIndexer, LabelIndexerModel

SHELVES = [
    ("bolt", "workshop", 12),
    ("cable", "stage", 7),
    ("bolt", "workshop", 12),
    ("lamp", "stage", 1),
    ("ledger", "archive", 30),
]


def indexed(frame, column="idx"):
    return {row[0]: row[column] for row in frame.collect()}


def test_learns_sorted_labels(categories):
    model = LabelIndexer().setInputCol("CATEGORY").setOutputCol("CATEGORY_INDEX").fit(categories)
    assert model.mapping_cat == {"aa": 0, "ab": 1, "ad": 2, "cd": 3}
    assert model.getMappingCat() == [("aa", 0.0), ("ab", 1.0), ("ad", 2.0), ("cd", 3.0)]
    assert model.mapping.columns == ["category", "idx"]
    assert dict(model.mapping.dtypes)["idx"] == "double"


def test_printed_example(categories, way):
    indexer = LabelIndexer(inputCol="CATEGORY", outputCol="CATEGORY_INDEX")
    result = indexer.fit(categories).transform(categories)
    assert result.columns == ["ID", "CATEGORY", "CATEGORY_INDEX"]
    assert sorted(map(tuple, result.collect())) == [
        (0, "aa", 0.0),
        (1, "ab", 1.0),
        (2, "cd", 3.0),
        (3, "ad", 2.0),
        (4, "aa", 0.0),
    ]


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_expected_column(spark, way):
    rows = [(0, "aa", 0.0), (1, "ab", 1.0), (2, "cd", 3.0), (3, "ad", 2.0), (4, "aa", 0.0)]
    frame = spark.createDataFrame(rows).toDF("ID", "CATEGORY", "EXPECTED")
    result = LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(frame).transform(frame)
    assert result.where("EXPECTED = i").count() == 5


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_employees_keep_equal_rows(spark, way):
    frame = spark.createDataFrame(SHELVES, "item string, room string, pieces int")
    model = LabelIndexer(inputCol="room", outputCol="roomIndex").fit(frame)
    index = {"archive": 0.0, "stage": 1.0, "workshop": 2.0}
    got = sorted(map(tuple, model.transform(frame).collect()))
    assert got == sorted((*row, index[row[1]]) for row in SHELVES)


def test_unknown_and_null_get_minus_one(spark, categories, way):
    model = LabelIndexer(inputCol="CATEGORY", outputCol="idx").fit(categories)
    other = spark.createDataFrame(
        [(1, "aa"), (2, "AA"), (3, None), (4, ""), (5, "aa "), (6, "cd")], "n int, CATEGORY string"
    )
    result = model.transform(other)
    assert indexed(result) == {1: 0.0, 2: -1.0, 3: -1.0, 4: -1.0, 5: -1.0, 6: 3.0}
    assert not result.schema["idx"].nullable


def test_nulls_are_not_learned(spark, way):
    frame = spark.createDataFrame(
        [(1, None), (2, "b"), (3, ""), (4, None), (5, "a"), (6, "b")], "n int, c string"
    )
    model = LabelIndexer(inputCol="c", outputCol="idx").fit(frame)
    assert model.mapping_cat == {"": 0.0, "a": 1.0, "b": 2.0}
    result = indexed(model.transform(frame))
    assert result == {1: -1.0, 2: 2.0, 3: 0.0, 4: -1.0, 5: 1.0, 6: 2.0}


@pytest.mark.parametrize("rows", [[], [(1, None), (2, None)]])
def test_nothing_to_learn(spark, categories, rows, way):
    frame = spark.createDataFrame(rows, "n int, CATEGORY string")
    model = LabelIndexer(inputCol="CATEGORY", outputCol="idx").fit(frame)
    assert model.mapping_cat == {}
    assert model.mapping.count() == 0
    result = model.transform(categories)
    assert set(indexed(result).values()) == {-1.0}
    assert result.schema == model.output_schema(categories.schema)


def test_order_is_by_code_point(spark, way):
    labels = ["", " ", "\n", "\x00", "\\", "'", '"', "10", "9", "Z", "a", "é", "語", "", "￿", "\U0001f600", "a b", "A"]
    frame = spark.createDataFrame([(v,) for v in labels], "c string")
    model = LabelIndexer(inputCol="c", outputCol="idx").fit(frame)
    assert indexed(model.transform(frame)) == {
        value: float(i) for i, value in enumerate(sorted(labels))
    }


def test_output_replaces_a_column_in_place(spark, way):
    frame = spark.createDataFrame([(1, "b", "x"), (2, "a", "y")], "n int, c string, d string")
    fitted = LabelIndexer(inputCol="c").fit(frame)
    for output, expected in [
        ("n", ["n", "c", "d"]),
        ("c", ["n", "c", "d"]),
        ("D", ["n", "c", "D"]),
        ("new", ["n", "c", "d", "new"]),
    ]:
        model = fitted.copy().setOutputCol(output)
        result = model.transform(frame)
        assert result.columns == expected
        assert result.schema == model.output_schema(frame.schema)
        assert sorted(row[output] for row in result.collect()) == [0.0, 1.0]


def test_odd_column_names(spark, way):
    frame = spark.createDataFrame(
        [("b", "x"), ("a", "y")], T.StructType().add("a.b`c", "string").add("category", "string")
    )
    model = LabelIndexer(inputCol="a.b`c", outputCol="idx.out").fit(frame)
    result = model.transform(frame)
    assert result.columns == ["a.b`c", "category", "idx.out"]
    assert sorted(map(tuple, result.collect())) == [("a", "y", 0.0), ("b", "x", 1.0)]
    clash = LabelIndexer(inputCol="category", outputCol="position").fit(frame).transform(frame)
    assert sorted(map(tuple, clash.collect())) == [("a", "y", 1.0), ("b", "x", 0.0)]


def test_other_columns_may_share_a_name(spark, way):
    frame = spark.range(2).select(
        F.lit(1).alias("x"), F.lit(2).alias("x"), F.col("id").cast("string").alias("c")
    )
    model = LabelIndexer(inputCol="c", outputCol="idx").fit(frame)
    assert model.transform(frame).columns == ["x", "x", "c", "idx"]
    assert sorted(map(tuple, model.transform(frame).collect())) == [
        (1, 2, "0", 0.0),
        (1, 2, "1", 1.0),
    ]


def test_wrong_input_is_refused(spark, categories):
    with pytest.raises(ValueError, match="not string"):
        LabelIndexer(inputCol="ID", outputCol="i").fit(categories)
    with pytest.raises(ValueError, match="not one of"):
        LabelIndexer(inputCol="category", outputCol="i").fit(categories)
    with pytest.raises(ValueError, match="inputCol"):
        LabelIndexer(outputCol="i").fit(categories)
    model = LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(categories)
    with pytest.raises(ValueError, match="not string"):
        model.setInputCol("ID").transform(categories)
    with pytest.raises(ValueError, match="no mapping"):
        LabelIndexerModel(inputCol="CATEGORY", outputCol="i").transform(categories)
    collated = categories.selectExpr("CATEGORY COLLATE UTF8_LCASE AS c")
    with pytest.raises(ValueError, match="string collate UTF8_LCASE"):
        LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(categories).setInputCol("c").transform(collated)
    struct = spark.createDataFrame([(("x",),)], "s struct<c: string>")
    with pytest.raises(ValueError, match="not one of"):
        LabelIndexer(inputCol="s.c", outputCol="i").fit(struct)


def test_params(categories):
    indexer = LabelIndexer().setInputCol("CATEGORY")
    assert indexer.getInputCol() == "CATEGORY"
    assert indexer.getOutputCol() == indexer.uid + "__output"
    assert indexer.setParams(outputCol="o") is indexer
    model = indexer.fit(categories)
    assert model.uid == indexer.uid
    assert (model.getInputCol(), model.getOutputCol()) == ("CATEGORY", "o")
    assert model.setInputCol("CATEGORY").setOutputCol("p") is model
    assert repr(model) == f"LabelIndexerModel: uid={model.uid}"
    assert model.setParams(outputCol="q").getOutputCol() == "q"
    fitted = indexer.fit(categories, {indexer.outputCol: "r"})
    assert fitted.transform(categories).columns[-1] == "r"


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_copy_takes_the_mapping_along(categories, way):
    model = LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(categories)
    twin = model.copy({model.outputCol: "j"})
    assert twin.uid == model.uid
    assert twin.transform(categories).columns[-1] == "j"
    both = twin.transform(model.transform(categories))
    assert both.where("i = j").count() == 5
    assert model.transform(categories, {model.outputCol: "k"}).columns[-1] == "k"


def test_mapping_stays_as_fitted(spark, tmp_path, way):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("b",), ("c",)], "c string").write.parquet(path)
    model = LabelIndexer(inputCol="c", outputCol="i").fit(spark.read.parquet(path))
    spark.createDataFrame([("a",), ("b",)], "c string").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    result = model.transform(spark.read.parquet(path))
    assert sorted(map(tuple, result.collect())) == [
        ("a", -1.0),
        ("b", 0.0),
        ("b", 0.0),
        ("c", 1.0),
    ]


def test_large_mapping_is_not_collected_by_accident(categories, settings):
    model = LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(categories)
    with pytest.raises(ValueError, match="mapping"):
        model.mapping_dict(limit=3)
    settings(spark__rankfold__collectedLabels=3)
    with pytest.raises(ValueError, match="mapping_pairs"):
        model.mapping_cat
    # What is asked for explicitly goes before the setting.
    assert len(model.mapping_dict(limit=4)) == 4
    assert list(model.mapping_pairs()) == [("aa", 0.0), ("ab", 1.0), ("ad", 2.0), ("cd", 3.0)]


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_model_from_given_mapping(spark, categories, way):
    given = spark.createDataFrame([("aa", 5), ("cd", 2)], "label string, code int")
    for mapping in (given, {"aa": 5, "cd": 2}, [("aa", 5), ["cd", 2]]):
        model = LabelIndexerModel.from_mapping(mapping, inputCol="CATEGORY", outputCol="i")
        assert indexed(model.transform(categories), "i") == {
            0: 5.0,
            1: -1.0,
            2: 2.0,
            3: -1.0,
            4: 5.0,
        }
        assert model.getMappingCat() == [("cd", 2.0), ("aa", 5.0)]


def test_given_mapping_must_be_one(spark):
    for rows in ([("a", 1), ("a", 2)], [("a", 1), (None, 2)], [("a", 1), ("b", None)]):
        with pytest.raises(ValueError):
            LabelIndexerModel.from_mapping(spark.createDataFrame(rows, "c string, i int"))
    with pytest.raises(ValueError, match="two columns"):
        LabelIndexerModel.from_mapping(spark.createDataFrame([(1,)], "c int"))
