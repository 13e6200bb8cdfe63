"""Categories of any sortable type to nullable int indexes."""

import datetime as dt
import math
from decimal import Decimal

import pytest

from rankfold import CategoryMapper, CategoryMapperModel


def indexed(frame, column="idx"):
    return {row[0]: row[column] for row in frame.collect()}


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_printed_example(categories, way):
    mapper = CategoryMapper(inputCol="CATEGORY", outputCol="CATEGORY_FITTED")
    result = mapper.fit(categories).transform(categories)
    assert dict(result.dtypes)["CATEGORY_FITTED"] == "int"
    assert result.schema["CATEGORY_FITTED"].nullable
    assert sorted(map(tuple, result.collect())) == [
        (0, "aa", 0),
        (1, "ab", 1),
        (2, "cd", 3),
        (3, "ad", 2),
        (4, "aa", 0),
    ]


def test_unknown_and_null_get_null(spark, categories, way):
    model = CategoryMapper(inputCol="CATEGORY", outputCol="idx").fit(categories)
    other = spark.createDataFrame([(1, "aa"), (2, "zz"), (3, None)], "n int, CATEGORY string")
    assert indexed(model.transform(other)) == {1: 0, 2: None, 3: None}


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_nothing_to_learn(spark, categories, way):
    empty = spark.createDataFrame([], "ID long, CATEGORY string")
    model = CategoryMapper(inputCol="CATEGORY", outputCol="idx").fit(empty)
    result = model.transform(categories)
    assert set(indexed(result).values()) == {None}
    assert result.schema == model.output_schema(categories.schema)


KEYS = {
    "tinyint": [3, -1, 2],
    "int": [30, -1, 2, 10],
    "bigint": [2**62, -(2**62), 0, 5],
    "boolean": [True, False],
    "double": [1.5, -2.0, 0.0, 1e300, float("-inf")],
    "float": [1.5, -2.25, 0.1],
    "decimal(12,3)": [Decimal("1.500"), Decimal("-2.000"), Decimal("10.125")],
    "date": [dt.date(2024, 2, 29), dt.date(1969, 12, 31), dt.date(1, 1, 1)],
    "timestamp": [dt.datetime(2024, 1, 1, 0, 0, 0, 7), dt.datetime(1950, 1, 1)],
    "timestamp_ntz": [dt.datetime(2024, 1, 1, 0, 0, 0, 7), dt.datetime(1950, 1, 1)],
    "binary": [bytearray(b"\xff"), bytearray(b"\x00a"), bytearray(b"")],
    "string": ["b", "", "a"],
    "array<int>": [[2], [1, 5], [1]],
    "struct<a: int, b: string>": [(1, "b"), (1, "a"), (0, "z")],
    "interval day to second": [dt.timedelta(1), dt.timedelta(0, 1), dt.timedelta(-3)],
}


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
@pytest.mark.parametrize("kind", sorted(KEYS))
def test_keys_of_every_sortable_type(spark, way, kind):
    keys = KEYS[kind]
    rows = [(i, key) for i, key in enumerate(keys)] + [(100 + i, key) for i, key in enumerate(keys)]
    frame = spark.createDataFrame([*rows, (999, None)], f"n int, k {kind}")
    model = CategoryMapper(inputCol="k", outputCol="idx").fit(frame)
    order = sorted(keys)
    expected = {n: order.index(key) for n, key in rows} | {999: None}
    assert indexed(model.transform(frame)) == expected
    assert model.mapping.schema["category"].dataType == frame.schema["k"].dataType


def test_zero_and_nan_are_single_keys(spark, way):
    keys = [0.0, -0.0, math.nan, 1.0, -math.inf, math.inf]
    frame = spark.createDataFrame(list(enumerate(keys)), "n int, k double")
    model = CategoryMapper(inputCol="k", outputCol="idx").fit(frame)
    assert indexed(model.transform(frame)) == {0: 1, 1: 1, 2: 4, 3: 2, 4: 0, 5: 3}


def test_time_keys_in_a_zone_with_clock_changes(spark, settings, way):
    settings(spark__sql__session__timeZone="America/New_York")
    # Both of these show 01:30 on a wall clock in that zone.
    frame = spark.sql(
        "SELECT * FROM VALUES (1, timestamp_seconds(1730611800)), "
        "(2, timestamp_seconds(1730615400)), (3, timestamp_seconds(0)) AS t(n, k)"
    )
    model = CategoryMapper(inputCol="k", outputCol="idx").fit(frame)
    assert indexed(model.transform(frame)) == {1: 1, 2: 2, 3: 0}


def test_types_without_order_are_refused(spark):
    frame = spark.sql(
        "SELECT map('a', 1) AS m, array(map('a', 1)) AS a, array('a' COLLATE UTF8_LCASE) AS c"
    )
    for column in ("m", "a", "c"):
        with pytest.raises(ValueError, match="no fixed order"):
            CategoryMapper(inputCol=column, outputCol="i").fit(frame)


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_integral_widths_match_each_other(spark, way):
    narrow = spark.createDataFrame([(5,), (7,)], "k int")
    wide = spark.createDataFrame([(5,), (6,), (2**40,)], "k bigint")
    model = CategoryMapper(inputCol="k", outputCol="idx").fit(narrow)
    assert indexed(model.transform(wide)) == {5: 0, 6: None, 2**40: None}
    model = CategoryMapper(inputCol="k", outputCol="idx").fit(wide)
    assert indexed(model.transform(narrow)) == {5: 0, 7: None}


def test_mapping_keys_must_fit_the_column(spark, categories):
    model = CategoryMapperModel(inputCol="CATEGORY", outputCol="i", mappingCat=[(1, 0)])
    with pytest.raises(ValueError, match="keys"):
        model.transform(categories)
    # 2^53 and 2^53 + 1 are the same double.
    model = CategoryMapperModel(inputCol="k", outputCol="i", mappingCat=[(2**53, 0), (2**53 + 1, 1)])
    with pytest.raises(ValueError, match="keys"):
        model.transform(spark.createDataFrame([(1.0,)], "k double"))


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
def test_model_from_given_mapping(spark, categories, way):
    pairs = [("aa", 7), ("cd", 1)]
    expected = {0: 7, 1: None, 2: 1, 3: None, 4: 7}
    model = CategoryMapperModel(inputCol="CATEGORY", outputCol="i", mappingCat=pairs)
    assert indexed(model.transform(categories), "i") == expected
    model = CategoryMapperModel().setInputCol("CATEGORY").setOutputCol("i").setMappingCat(dict(pairs))
    assert indexed(model.transform(categories), "i") == expected
    assert model.getMappingCat() == [("cd", 1), ("aa", 7)]
    assert model.mapping_cat == {"cd": 1, "aa": 7}
    table = spark.createDataFrame(pairs, "c string, i long")
    model = CategoryMapperModel.from_mapping(table, inputCol="CATEGORY", outputCol="i")
    assert indexed(model.transform(categories), "i") == expected
    assert dict(model.mapping.dtypes) == {"category": "string", "idx": "int"}


def test_empty_given_mapping(categories):
    model = CategoryMapperModel(inputCol="CATEGORY", outputCol="i", mappingCat=[])
    assert set(indexed(model.transform(categories), "i").values()) == {None}


def test_int_index_must_hold_every_label(categories, monkeypatch):
    monkeypatch.setattr("rankfold.operators.domain._INT_LABELS", 3)
    with pytest.raises(ValueError, match="do not fit"):
        CategoryMapper(inputCol="CATEGORY").fit(categories)
    monkeypatch.setattr("rankfold.operators.domain._INT_LABELS", 4)
    assert CategoryMapper(inputCol="CATEGORY").fit(categories).mapping.count() == 4


def test_pairs_of_every_key_type(spark):
    frame = spark.sql("""
        SELECT array(id % 3, 1) AS a, make_ym_interval(1, int(id % 3)) AS m,
               named_struct('x', id % 2) AS s FROM range(6)""")
    expected = {
        "a": [([0, 1], 0), ([1, 1], 1), ([2, 1], 2)],
        "m": [(12, 0), (13, 1), (14, 2)],
        "s": [((0,), 0), ((1,), 1)],
    }
    for name, pairs in expected.items():
        model = CategoryMapper(inputCol=name, outputCol="i").fit(frame)
        assert list(model.mapping_pairs()) == pairs
        assert model.getMappingCat() == pairs


def test_times_of_day(spark, settings):
    settings(spark__sql__timeType__enabled="true")
    frame = spark.sql("SELECT id, make_time(int(12 - id), 0, 0) AS t FROM range(4)")
    model = CategoryMapper(inputCol="t", outputCol="i").fit(frame)
    got = {row["id"]: row["i"] for row in model.transform(frame).select("id", "i").collect()}
    assert got == {0: 3, 1: 2, 2: 1, 3: 0}


@pytest.mark.parametrize("way", ["literal", "shuffled"], indirect=True)
@pytest.mark.parametrize(
    "learned, applied",
    [("decimal(10,2)", "decimal(12,4)"), ("int", "double"), ("bigint", "decimal(25,3)"), ("decimal(6,1)", "int")],
)
def test_key_types_that_meet_without_loss(spark, way, learned, applied):
    frame = spark.sql(f"SELECT CAST(id AS {learned}) AS k FROM range(5)")
    other = spark.sql(f"SELECT id, CAST(id + 1 AS {applied}) AS k FROM range(5)")
    model = CategoryMapper(inputCol="k", outputCol="i").fit(frame)
    got = {row["id"]: row["i"] for row in model.transform(other).collect()}
    assert got == {0: 1, 1: 2, 2: 3, 3: 4, 4: None}


@pytest.mark.parametrize("learned, applied", [("bigint", "double"), ("decimal(38,0)", "decimal(38,2)"), ("int", "string")])
def test_key_types_that_lose_values_are_refused(spark, learned, applied):
    frame = spark.sql(f"SELECT CAST(id AS {learned}) AS k FROM range(5)")
    model = CategoryMapper(inputCol="k", outputCol="i").fit(frame)
    with pytest.raises(ValueError, match="keys"):
        model.transform(spark.sql(f"SELECT CAST(1 AS {applied}) AS k"))


def test_an_empty_mapping_checks_its_key_type(spark, way):
    empty = spark.createDataFrame([], "k array<int>")
    model = CategoryMapper(inputCol="k", outputCol="i").fit(empty)
    rows = spark.sql("SELECT array(1) AS k")
    assert [row["i"] for row in model.transform(rows).collect()] == [None]
    with pytest.raises(ValueError, match="keys"):
        model.transform(spark.sql("SELECT 'a' AS k"))
    # A mapping given as no pairs names no type.
    model = CategoryMapperModel.from_mapping({}, inputCol="k", outputCol="i")
    assert [row["i"] for row in model.transform(rows).collect()] == [None]


@pytest.mark.parametrize("index", ["1.7D", "3000000000L", "'x'"])
def test_given_indexes_that_would_change_are_refused(spark, index):
    given = spark.sql(f"SELECT 'a' AS c, {index} AS i")
    with pytest.raises(ValueError, match="int"):
        CategoryMapperModel.from_mapping(given, inputCol="c")
