"""Plans that hold on large data: what is shuffled, what is broadcast, where skew goes."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from rankfold import CategoryMapper, IndexPipeline, LabelIndexer, LabelIndexerModel
from rankfold.functions.labels import stored_bytes
from rankfold.functions.names import quoted
from rankfold.operators.domain import hot_values
from rankfold.operators.limits import Limits

LINES = "/root/testdata/sf0.01/lineitem.parquet"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def random_label(rng):
    letters = "abé語\U0001f600 "
    return "".join(rng.choice(letters) for _ in range(rng.randrange(0, 4)))


@pytest.mark.parametrize("seed", [1])
def test_random_labels_against_plain_python(spark, way, seed):
    rng = random.Random(seed)
    learned = [None if rng.random() < 0.1 else random_label(rng) for _ in range(400)]
    applied = [None if rng.random() < 0.3 else random_label(rng) for _ in range(400)]
    rank = {v: i for i, v in enumerate(sorted({v for v in learned if v is not None}))}
    fitted = spark.createDataFrame([(v,) for v in learned], "c string")
    rows = spark.createDataFrame(list(enumerate(applied)), "n int, c string").repartition(5)
    labels = LabelIndexer(inputCol="c", outputCol="i").fit(fitted).transform(rows)
    mapped = CategoryMapper(inputCol="c", outputCol="j").fit(fitted).transform(labels)
    got = {row["n"]: (row["c"], row["i"], row["j"]) for row in mapped.collect()}
    assert got == {
        n: (v, float(rank.get(v, -1)), rank.get(v)) for n, v in enumerate(applied)
    }


def test_ranks_over_many_sorted_slices(spark, settings):
    settings(
        spark__rankfold__heldLabels=-1,
        spark__rankfold__oneTaskBytes=-1,
        spark__rankfold__broadcastBytes=-1,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions=13,
    )
    lines = spark.read.parquet(LINES).select(F.col("l_orderkey").cast("string").alias("k"))
    model = LabelIndexer(inputCol="k", outputCol="i").fit(lines)
    assert model._mapping.slice_starts.num_rows == 13
    expected = sorted({row["k"] for row in lines.collect()})
    got = model.mapping.orderBy("idx").collect()
    assert [row["category"] for row in got] == expected
    assert [row["idx"] for row in got] == [float(i) for i in range(len(expected))]


def test_long_keys_are_sampled_sparsely(spark, settings, monkeypatch):
    sampling = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    settings(
        spark__rankfold__heldLabels=-1,
        spark__rankfold__oneTaskBytes=-1,
        spark__rankfold__sampleBytes=400_000,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions=5,
    )
    rows = spark.range(300).select(F.repeat(F.col("id").cast("string"), 1000).alias("k"))
    used = []
    numbering = F.monotonically_increasing_id

    def noted():
        used.append(int(spark.conf.get(sampling)))
        return numbering()

    monkeypatch.setattr(F, "monotonically_increasing_id", noted)
    model = LabelIndexer(inputCol="k", outputCol="i").fit(rows)
    # 400,000 bytes hold three times 10 of these keys for each of five partitions.
    assert used == [10]
    assert spark.conf.get(sampling) == "100"
    assert model._mapping.slice_starts.num_rows == 5
    labels = sorted(str(n) * 1000 for n in range(300))
    assert model.mapping_dict() == {label: float(i) for i, label in enumerate(labels)}


def test_a_mapping_for_one_task_is_one_sorted_file(spark, settings):
    settings(spark__rankfold__heldLabels=-1)
    lines = spark.read.parquet(LINES).select(F.col("l_orderkey").cast("string").alias("k"))
    model = LabelIndexer(inputCol="k", outputCol="i").fit(lines)
    assert model._mapping.slice_starts is None
    assert len(model.mapping.inputFiles()) == 1
    expected = sorted({row["k"] for row in lines.collect()})
    got = model.mapping.orderBy("idx").collect()
    assert [(row["category"], row["idx"]) for row in got] == [
        (value, float(i)) for i, value in enumerate(expected)
    ]


def test_no_row_passes_through_python_or_a_udf(spark, categories, way):
    model = LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(categories)
    rows = spark.range(3).select(F.col("id").cast("string").alias("CATEGORY"))
    text = plan(model.transform(rows))
    for word in ("UDF", "EvalPython", "InPandas", "InArrow"):
        assert word not in text


def test_plan_follows_the_size_of_the_mapping(spark, categories, way):
    model = LabelIndexer(inputCol="CATEGORY", outputCol="i").fit(categories)
    text = plan(model.transform(spark.range(3).select(F.col("id").cast("string").alias("CATEGORY"))))
    joins = {
        "literal": (0, 0),
        "held": (1, 0),
        "written": (1, 0),
        # One broadcast places each sorted slice of the mapping.
        "sliced": (2, 0),
        "shuffled": (1, 1),
        # The frequent values' hashes mark rows and entries.
        "hot": (3, 1),
    }
    assert (text.count("BroadcastHashJoin"), text.count("SortMergeJoin")) == joins[way]
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert text.count("Exchange hashpartitioning") == (2 if joins[way][1] else 0)


def test_fit_reads_one_column_and_skips_earlier_lookups(spark, settings):
    settings(
        spark__rankfold__heldLabels=-1,
        spark__rankfold__oneTaskBytes=-1,
        spark__rankfold__broadcastBytes=-1,
        spark__sql__autoBroadcastJoinThreshold=-1,
    )
    lines = spark.read.parquet(LINES)
    first = LabelIndexer(inputCol="l_returnflag", outputCol="i").fit(lines).transform(lines)
    # What learning from the second column evaluates.
    learned = (
        first.select(F.col(quoted("l_linestatus")).alias("category"))
        .where(F.col("category").isNotNull())
        .distinct()
    )
    text = plan(learned)
    assert "Join" not in text
    assert "ReadSchema: struct<l_linestatus:string>" in text
    assert "PushedFilters: [IsNotNull(l_linestatus)]" in text


def test_filters_and_columns_reach_the_scan_through_the_lookup(spark, way):
    lines = spark.read.parquet(LINES)
    model = LabelIndexer(inputCol="l_returnflag", outputCol="i").fit(lines)
    text = plan(model.transform(lines).where("l_quantity > 49").select("l_orderkey", "i"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in text
    # Rows of a shuffled lookup are marked with the partition they come from, and
    # Spark moves no filter below such a mark.
    if way not in ("shuffled", "hot"):
        assert "GreaterThan(l_quantity,49.0)" in text


def test_filters_pass_a_shuffled_lookup_of_a_column_without_nulls(spark, settings, shuffled):
    settings(spark__rankfold__hotLabels=3)
    ids = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    ids = ids.select("id", F.coalesce("k", F.lit(0)).alias("k"))
    model = CategoryMapper(inputCol="k", outputCol="i").fit(ids)
    result = model.transform(ids).where("id < 10")
    assert "spark_partition_id" not in optimized(result).lower()
    above_range = optimized(result).index("Filter (id#")
    assert above_range > optimized(result).index("Join LeftOuter")
    assert {row["id"]: row["i"] for row in result.collect()} == {i: i % 7 for i in range(10)}


def skewed(spark, n=30_000):
    """A third of the rows hold one label, a third are null, the rest are spread."""
    return spark.range(0, n, 1, 12).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")))
        .alias("c"),
    )


@pytest.fixture
def shuffled(settings):
    settings(
        spark__rankfold__heldLabels=-1,
        spark__rankfold__oneTaskBytes=-1,
        spark__rankfold__broadcastBytes=-1,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions=16,
    )


@pytest.mark.parametrize("hot_labels", [100, 0])
def test_hot_labels_and_nulls_spread_over_the_shuffle(spark, settings, shuffled, hot_labels):
    settings(spark__rankfold__hotLabels=hot_labels)
    frame = skewed(spark)
    model = LabelIndexer(inputCol="c", outputCol="i").fit(frame)
    result = model.transform(frame)
    sizes = [r["count"] for r in result.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("count"), F.max("i")).collect()]
    if hot_labels:
        assert len(model._mapping.hot) == 1
        assert max(sizes) < 0.2 * 30_000
    else:
        # What the hot labels are for: one partition holds them all.
        assert model._mapping.hot == ()
        assert max(sizes) > 0.33 * 30_000
    expected = {v: i for i, v in enumerate(sorted({r["c"] for r in frame.collect() if r["c"]}))}
    for row in result.collect():
        assert row["i"] == expected.get(row["c"], -1)


def test_hot_values_are_bounded_and_results_stay(spark, settings, shuffled):
    frame = skewed(spark)
    expected = {v: i for i, v in enumerate(sorted({r["c"] for r in frame.collect() if r["c"]}))}
    for hot_labels in (500, 5000):
        settings(spark__rankfold__hotLabels=hot_labels)
        model = LabelIndexer(inputCol="c", outputCol="i").fit(frame)
        assert 1 <= len(model._mapping.hot) <= hot_labels
        result = model.transform(frame).collect()
        assert len(result) == 30_000
        for row in result:
            assert row["i"] == expected.get(row["c"], -1)


def test_finding_hot_values_does_not_shuffle_the_domain(spark, settings, monkeypatch):
    settings(spark__rankfold__hotLabels=100)
    frame, seen = skewed(spark), []
    head = type(frame).head

    def noted(self, *args):
        seen.append(plan(self))
        return head(self, *args)

    monkeypatch.setattr(type(frame), "head", noted)
    assert len(hot_values(frame, "c", Limits.of(spark))) == 1
    assert seen and all("hashpartitioning" not in text for text in seen)


@pytest.fixture
def whole_partitions(settings):
    """Leave what is hot to the stages alone."""
    settings(spark__sql__adaptive__enabled="false")


def largest(result):
    return max(r["count"] for r in result.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("count"), F.max("i")).collect())


def test_hot_long_texts_are_spread(spark, shuffled, whole_partitions):
    frame = skewed(spark).withColumn("c", F.when(F.col("c") == "hot", F.repeat("c", 500)).otherwise(F.col("c")))
    model = LabelIndexer(inputCol="c", outputCol="i").fit(frame)
    assert largest(model.transform(frame)) < 0.2 * 30_000


def test_hot_values_of_a_given_mapping_and_unknown_ones_are_spread(spark, shuffled, whole_partitions):
    frame = skewed(spark)
    for known in ("hot", "other"):
        model = LabelIndexerModel.from_mapping({known: 4.0}, inputCol="c", outputCol="i")
        model.setPlanLimits(heldLabels=-1, broadcastBytes=-1).setMappingCat({known: 4.0})
        result = model.learn_hot(frame).transform(frame)
        assert largest(result) < 0.2 * 30_000
        assert result.where("i = 4").count() == (10_000 if known == "hot" else 0)


def test_hot_values_of_types_arrow_cannot_take_are_spread(spark, shuffled, whole_partitions):
    frame = skewed(spark).withColumn("c", F.when(F.col("c").isNotNull(), F.array("c")))
    model = CategoryMapper(inputCol="c", outputCol="i").fit(frame)
    result = model.transform(frame)
    assert largest(result) < 0.2 * 30_000
    assert result.where("i = 0").count() == 10_000


@pytest.mark.parametrize("set_before", [False, True])
def test_fits_at_once_leave_the_session_option_as_it_was(spark, settings, set_before):
    option = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    settings(
        spark__rankfold__heldLabels=-1,
        spark__rankfold__oneTaskBytes=-1,
        spark__rankfold__sampleBytes=400_000,
    )
    if set_before:
        settings(spark__sql__execution__rangeExchange__sampleSizePerPartition=90)
    rows = spark.range(300).select(F.repeat(F.col("id").cast("string"), 1000).alias("k"))
    with ThreadPoolExecutor(4) as pool:
        fits = [pool.submit(LabelIndexer(inputCol="k", outputCol="i").fit, rows) for _ in range(4)]
        assert [fit.result()._mapping.labels for fit in fits] == [300] * 4
    assert spark.conf.getAll.get(option) == ("90" if set_before else None)


def test_a_stage_has_limits_of_its_own(spark, categories):
    indexer = LabelIndexer(inputCol="CATEGORY", outputCol="i").setPlanLimits(heldLabels=-1, oneTaskBytes="-1")
    model = indexer.fit(categories)
    assert model._mapping.slice_starts is not None
    assert model.getPlanLimits() == {"heldLabels": "-1", "oneTaskBytes": "-1"}
    with pytest.raises(ValueError, match="no such limits: held"):
        LabelIndexer(inputCol="CATEGORY").setPlanLimits(held=1).fit(categories)


def test_sizes_take_units(spark, settings):
    settings(spark__rankfold__broadcastBytes="128m")
    assert Limits.of(spark).broadcast_bytes == 128 << 20
    settings(spark__rankfold__broadcastBytes="many")
    with pytest.raises(ValueError, match="spark.rankfold.broadcastBytes"):
        Limits.of(spark)


def test_counted_bytes_cover_nested_values(spark):
    frame = spark.sql("""
        SELECT array(1L, NULL, 3L) AS a, named_struct('x', NULL, 'y', 'text', 'z', 1) AS s,
               array('ab', NULL, 'c') AS t, array(named_struct('d', 1.5D, 'e', 'f')) AS u,
               CAST(NULL AS STRUCT<p: BIGINT>) AS n, CAST(1 AS DECIMAL(38, 2)) AS d""")
    # A long takes 8 bytes, a text its bytes, behind a word for each.
    least = {"a": 24, "s": 24 + 4, "t": 24 + 3, "u": 16 + 1, "n": 0, "d": 16}
    row = frame.select(*[stored_bytes(F.col(f.name), f.dataType).alias(f.name) for f in frame.schema]).head()
    assert all(row[name] >= size for name, size in least.items()), row


def test_a_frequent_unknown_value_is_split_while_running(spark, settings, shuffled):
    settings(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB",
    )
    known = skewed(spark).where("c <> 'hot'")
    model = CategoryMapper(inputCol="c", outputCol="i").fit(known)
    frame = skewed(spark, 120_000)
    result = model.transform(frame)
    rows = result.collect()
    assert "SortMergeJoin(skew=true)" in plan(result)
    assert len(rows) == 120_000
    assert {row["i"] for row in rows if row["c"] == "hot"} == {None}


def test_one_hot_label_fills_a_column(spark, shuffled):
    frame = spark.range(0, 20_000, 1, 12).select("id", F.lit("only").alias("c"))
    model = LabelIndexer(inputCol="c", outputCol="i").fit(frame)
    result = model.transform(frame)
    assert result.where("i = 0").count() == 20_000
    sizes = [r["count"] for r in result.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("count"), F.max("i")).collect()]
    assert max(sizes) <= 0.34 * 20_000


def test_two_shuffled_lookups_in_a_row(spark, settings, shuffled):
    settings(spark__rankfold__hotLabels=10)
    frame = skewed(spark, 3000).withColumn("d", F.reverse("c"))
    first = LabelIndexer(inputCol="c", outputCol="i").fit(frame).transform(frame)
    both = CategoryMapper(inputCol="d", outputCol="j").fit(first).transform(first)
    by_c = {v: i for i, v in enumerate(sorted({r["c"] for r in frame.collect() if r["c"]}))}
    by_d = {v: i for i, v in enumerate(sorted({r["d"] for r in frame.collect() if r["d"]}))}
    assert both.columns == ["id", "c", "d", "i", "j"]
    for row in both.collect():
        assert (row["i"], row["j"]) == (by_c.get(row["c"], -1), by_d.get(row["d"]))


def test_keys_arrow_cannot_take_stay_on_the_executors(spark, way):
    frame = spark.sql("SELECT id, make_ym_interval(0, int(id % 5)) AS k FROM range(20)")
    model = CategoryMapper(inputCol="k", outputCol="i").fit(frame)
    assert model._mapping.held is None and model._mapping.hot == ()
    rows = model.transform(frame).select("id", "i").collect()
    assert {row["id"]: row["i"] for row in rows} == {n: n % 5 for n in range(20)}


@pytest.mark.parametrize("kept", ["held", "written"])
def test_a_small_column_is_not_picked_out_of_a_large_one_by_one_task(spark, monkeypatch, kept):
    """Each kind counts 16 + 64 bytes for its 5 values, each id for its 20,000."""
    frame = spark.range(0, 20_000, 1, 6).select("id", (F.col("id") % 5).alias("kind"))
    seen = []
    sort = type(frame).sortWithinPartitions

    def noted(self, *columns):
        seen.append((plan(self), self.rdd.getNumPartitions(), self.count()))
        return sort(self, *columns)

    monkeypatch.setattr(type(frame), "sortWithinPartitions", noted)
    held = {} if kept == "held" else {"heldLabels": -1}
    for size, sent in (("1m", True), ("8m", False)):
        small = CategoryMapper(inputCol="kind", outputCol="i").setPlanLimits(**held, oneTaskBytes=size)
        large = CategoryMapper(inputCol="id", outputCol="j").setPlanLimits(heldLabels=-1, oneTaskBytes=-1)
        result = IndexPipeline(stages=[small, large]).fit(frame).transform(frame)
        (text, partitions, values), = seen
        assert (partitions, values) == (1, 5)
        # What is sent has been picked out where it was cached.
        assert ("Exchange SinglePartition" in text.split("InMemoryTableScan")[0]) is sent
        assert ("Coalesce 1" in text.split("InMemoryTableScan")[0]) is not sent
        assert all((r.i, r.j) == (r.id % 5, r.id) for r in result.collect())
        seen.clear()
