"""One query for each operator, over whole tables of a data folder.

A query that needs a fitted stage fits it when it is built; the table it returns
is lazy.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold import (
    CategoryMapper,
    CategoryMapperModel,
    DropColumn,
    IndexPipeline,
    LabelIndexer,
    LabelIndexerModel,
)
from rankfold.sources.store import new_folder
from rankfold.sources.tables import read_table, read_table_stream
from rankfold.sources.versions import STORE_SETTING
from rankfold.streaming import write_transformed


def label_index(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )
    return LabelIndexer(inputCol="l_returnflag", outputCol="idx").fit(lines).transform(lines)


def label_index_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    model = LabelIndexer(inputCol="event_type", outputCol="idx").fit(events)
    return model.transform(events).groupBy("idx").agg(F.count(F.lit(1)).alias("n"))


def label_mapping(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer")
    return LabelIndexer(inputCol="c_name").fit(customers).mapping


def category_mapping(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return CategoryMapper(inputCol="l_partkey").fit(lines).mapping


def label_index_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the orders that have lines, applied to all orders."""
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_label")
    )
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("order_label")
    )
    return LabelIndexer(inputCol="order_label", outputCol="idx").fit(lines).transform(orders)


def label_index_nulls(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select(
        "doc_id", F.nullif("lang", F.lit("en")).alias("lang_n")
    )
    return LabelIndexer(inputCol="lang_n", outputCol="idx").fit(documents).transform(documents)


def label_index_high_card(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("order_label")
    )
    stages = [
        LabelIndexer(inputCol="order_label", outputCol="idx"),
        DropColumn(column="order_label"),
    ]
    return Pipeline(stages=stages).fit(lines).transform(lines)


def label_index_long_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as labels: equal texts get the same index."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    indexed = LabelIndexer(inputCol="text", outputCol="idx").fit(documents).transform(documents)
    return DropColumn(column="text").transform(indexed)


def label_index_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    return LabelIndexer(inputCol="url", outputCol="idx").fit(pages).transform(pages)


def label_index_replace_output(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = read_table(spark, folder, "supplier")
    return LabelIndexer(inputCol="s_name", outputCol="s_acctbal").fit(suppliers).transform(suppliers)


def label_index_replace_input(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return LabelIndexer(inputCol="role", outputCol="role").fit(turns).transform(turns)


def label_index_empty_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on a column without a single value."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    blank = orders.select(F.nullif("o_orderstatus", "o_orderstatus").alias("o_orderstatus"))
    return LabelIndexer(inputCol="o_orderstatus", outputCol="idx").fit(blank).transform(orders)


def category_map_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the labelled documents, applied to all documents."""
    labels = read_table(spark, folder, "labels").select("doc_id")
    documents = read_table(spark, folder, "documents").select("doc_id", "source")
    return CategoryMapper(inputCol="doc_id", outputCol="idx").fit(labels).transform(documents)


def category_map_text(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part").select("p_partkey", "p_brand")
    return CategoryMapper(inputCol="p_brand", outputCol="idx").fit(parts).transform(parts)


def category_map_numeric_key(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part").select("p_partkey", "p_size")
    return CategoryMapper(inputCol="p_size", outputCol="idx").fit(parts).transform(parts)


def category_map_double_key(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return CategoryMapper(inputCol="c_acctbal", outputCol="idx").fit(customers).transform(customers)


def category_map_time_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate"
    )
    stages = [
        CategoryMapper(inputCol="l_shipdate", outputCol="idx"),
        DropColumn(column="l_shipdate"),
    ]
    return Pipeline(stages=stages).fit(lines).transform(lines)


def category_map_date_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day")
    )
    stages = [CategoryMapper(inputCol="day", outputCol="idx"), DropColumn(column="day")]
    return Pipeline(stages=stages).fit(orders).transform(orders)


def drop_column(spark: SparkSession, folder: str) -> DataFrame:
    return DropColumn(column="o_totalprice").transform(read_table(spark, folder, "orders"))


def drop_missing_column(spark: SparkSession, folder: str) -> DataFrame:
    return DropColumn(column="absent").transform(read_table(spark, folder, "customer"))


def drop_unset_column(spark: SparkSession, folder: str) -> DataFrame:
    return DropColumn().transform(read_table(spark, folder, "supplier"))


def _index_then_drop(customers: DataFrame) -> PipelineModel:
    stages = [
        LabelIndexer(inputCol="c_mktsegment", outputCol="idx"),
        DropColumn(column="c_mktsegment"),
    ]
    return Pipeline(stages=stages).fit(customers)


def index_then_drop(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer")
    return _index_then_drop(customers).transform(customers)


def two_indexers(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    stages = [
        LabelIndexer(inputCol="o_orderstatus", outputCol="status_idx"),
        DropColumn(column="o_orderstatus"),
        LabelIndexer(inputCol="o_orderpriority", outputCol="prio_idx"),
        DropColumn(column="o_orderpriority"),
    ]
    return IndexPipeline(stages=stages).fit(orders).transform(orders)


def mixed_indexers(spark: SparkSession, folder: str) -> DataFrame:
    """Five columns of four types, one of them twice, learned in one scan; one with nulls."""
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        "o_custkey",
    )
    stages = [
        LabelIndexer(inputCol="o_orderstatus", outputCol="status_idx"),
        CategoryMapper(inputCol="o_orderstatus", outputCol="status_number"),
        LabelIndexer(inputCol="priority", outputCol="prio_idx"),
        CategoryMapper(inputCol="day", outputCol="day_idx"),
        DropColumn(column="day"),
        CategoryMapper(inputCol="price", outputCol="price_idx"),
        DropColumn(column="price"),
        CategoryMapper(inputCol="o_custkey", outputCol="customer_idx").setPlanLimits(**_SHUFFLED),
    ]
    return IndexPipeline(stages=stages).fit(orders).transform(orders)


def unread_index(spark: SparkSession, folder: str) -> DataFrame:
    """A shuffled lookup whose index is not read: the plan is a scan."""
    lines = _order_labels(spark, folder)
    indexer = LabelIndexer(inputCol="order_label", outputCol="idx")
    indexer.setPlanLimits(**_SHUFFLED, prunable=1)
    return indexer.fit(lines).transform(lines).select("l_orderkey", "l_linenumber")


def indexer_then_mapper(spark: SparkSession, folder: str) -> DataFrame:
    """The second stage maps what the first one produced."""
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name")
    stages = [
        LabelIndexer(inputCol="p_name", outputCol="name_idx"),
        CategoryMapper(inputCol="name_idx", outputCol="idx"),
    ]
    return Pipeline(stages=stages).fit(parts).transform(parts)


def model_from_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """A mapping taken from a table: the size of the part on each line."""
    sizes = read_table(spark, folder, "part").select("p_partkey", "p_size")
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )
    model = CategoryMapperModel.from_mapping(sizes, inputCol="l_partkey", outputCol="idx")
    return model.transform(lines)


def label_model_from_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Nation keys by name, given by the user; every customer shows its nation's key."""
    nations = read_table(spark, folder, "nation").select("n_name", "n_nationkey")
    customers = (
        read_table(spark, folder, "customer")
        .join(
            read_table(spark, folder, "nation"),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "left",
        )
        .select("c_custkey", "n_name")
    )
    model = LabelIndexerModel.from_mapping(nations, inputCol="n_name", outputCol="idx")
    return model.transform(customers)


def label_index_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the table, applied to the same rows as a stream."""
    events = read_table(spark, folder, "events")
    model = LabelIndexer(inputCol="event_type", outputCol="idx").fit(events)
    rows = read_table_stream(spark, folder, "events").select("event_id", "event_type")
    written, checkpoint = new_folder(spark, "stream"), new_folder(spark, "progress")
    write_transformed(model, rows, written, checkpoint).awaitTermination()
    return spark.read.schema(model.output_schema(rows.schema)).parquet(written)


def reload_label_model(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )
    saved = new_folder(spark, "saved")
    model = LabelIndexer(inputCol="l_returnflag", outputCol="idx").fit(lines)
    model.write().overwrite().save(saved)
    return LabelIndexerModel.load(saved).transform(lines)


def reload_category_model(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    saved = new_folder(spark, "saved")
    CategoryMapper(inputCol="c_acctbal", outputCol="idx").fit(customers).save(saved)
    return CategoryMapperModel.load(saved).transform(customers)


def reload_drop(spark: SparkSession, folder: str) -> DataFrame:
    saved = new_folder(spark, "saved")
    DropColumn(column="o_totalprice").write().overwrite().save(saved)
    return DropColumn.load(saved).transform(read_table(spark, folder, "orders"))


def reload_estimator(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus"
    )
    saved = new_folder(spark, "saved")
    LabelIndexer(inputCol="l_linestatus", outputCol="idx").save(saved)
    return LabelIndexer.load(saved).fit(lines).transform(lines)


def reload_fitted_chain(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer")
    saved = new_folder(spark, "saved")
    _index_then_drop(customers).write().overwrite().save(saved)
    return PipelineModel.load(saved).transform(customers)


# Limits under which a mapping of any size is written in sorted slices, and joined by shuffle.
_SLICED = {"heldLabels": -1, "oneTaskBytes": -1}
_SHUFFLED = {**_SLICED, "broadcastBytes": -1}


def _order_labels(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("order_label")
    )


def label_index_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered over all executors, looked up by broadcast."""
    lines = _order_labels(spark, folder)
    indexer = LabelIndexer(inputCol="order_label", outputCol="idx").setPlanLimits(**_SLICED)
    return DropColumn(column="order_label").transform(indexer.fit(lines).transform(lines))


def label_mapping_ranked(spark: SparkSession, folder: str) -> DataFrame:
    lines = _order_labels(spark, folder)
    return LabelIndexer(inputCol="order_label").setPlanLimits(**_SLICED).fit(lines).mapping


def label_index_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    lines = _order_labels(spark, folder)
    indexer = LabelIndexer(inputCol="order_label", outputCol="idx")
    model = indexer.setPlanLimits(**_SHUFFLED, hotLabels=0).fit(lines)
    return DropColumn(column="order_label").transform(model.transform(lines))


def category_map_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the labelled documents; all documents, ids of one language as null."""
    labels = read_table(spark, folder, "labels").select("doc_id")
    documents = read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") != "en", F.col("doc_id")).alias("doc_id")
    )
    mapper = CategoryMapper(inputCol="doc_id", outputCol="idx").setPlanLimits(**_SHUFFLED)
    return mapper.fit(labels).transform(documents)


def label_index_shuffled_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Three labels hold all rows; each is spread."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )
    indexer = LabelIndexer(inputCol="l_returnflag", outputCol="idx").setPlanLimits(**_SHUFFLED)
    return indexer.fit(lines).transform(lines)


def label_index_hot_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as labels, looked up by shuffle; texts of any length may be frequent."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    indexer = LabelIndexer(inputCol="text", outputCol="idx").setPlanLimits(**_SHUFFLED)
    indexed = indexer.fit(documents).transform(documents)
    return DropColumn(column="text").transform(indexed)


def category_map_mostly_unknown(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the suppliers' keys, looked up for the orders of all lines: few are known."""
    suppliers = read_table(spark, folder, "supplier").select(F.col("s_suppkey").cast("long").alias("l_orderkey"))
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("l_orderkey"), "l_linenumber"
    )
    mapper = CategoryMapper(inputCol="l_orderkey", outputCol="idx")
    return mapper.setPlanLimits(**_SHUFFLED, knownBytes="64m").fit(suppliers).transform(lines)


def label_index_between(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a range of indexes: a range of labels at the scan."""
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_name")
    indexer = LabelIndexer(inputCol="c_name", outputCol="idx").setPlanLimits(**_SHUFFLED)
    return indexer.fit(customers).transform_between(customers, 10, 99)


def two_shuffled_indexers(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer"), "o_orderpriority"
    )
    stages = [
        LabelIndexer(inputCol="customer", outputCol="customer_idx").setPlanLimits(**_SHUFFLED),
        LabelIndexer(inputCol="o_orderpriority", outputCol="prio_idx").setPlanLimits(**_SHUFFLED),
        DropColumn(column="customer"),
        DropColumn(column="o_orderpriority"),
    ]
    return IndexPipeline(stages=stages).fit(orders).transform(orders)


def reload_ranked_model(spark: SparkSession, folder: str) -> DataFrame:
    """A large mapping, read where it was saved."""
    lines = _order_labels(spark, folder)
    saved = new_folder(spark, "saved")
    indexer = LabelIndexer(inputCol="order_label", outputCol="idx").setPlanLimits(**_SHUFFLED)
    indexer.fit(lines).write().overwrite().save(saved)
    indexed = LabelIndexerModel.load(saved).transform(lines)
    return DropColumn(column="order_label").transform(indexed)


def reload_versioned_chain(spark: SparkSession, folder: str) -> DataFrame:
    """A chain with a large mapping in a store of versions, read after it was overwritten."""
    lines = _order_labels(spark, folder)
    saved, before = new_folder(spark, "saved"), spark.conf.get(STORE_SETTING, None)
    indexer = LabelIndexer(inputCol="order_label", outputCol="idx").setPlanLimits(**_SHUFFLED)
    spark.conf.set(STORE_SETTING, new_folder(spark, "versions"))
    try:
        Pipeline(stages=[indexer, DropColumn(column="order_label")]).fit(lines).save(saved)
        loaded = PipelineModel.load(saved)
        PipelineModel.load(saved).write().overwrite().save(saved)
    finally:
        spark.conf.unset(STORE_SETTING) if before is None else spark.conf.set(STORE_SETTING, before)
    return loaded.transform(lines)


def stream_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """A mapping dealt into buckets once, which no micro-batch shuffles."""
    events = read_table(spark, folder, "events")
    indexer = CategoryMapper(inputCol="user_id", outputCol="idx").setPlanLimits(**_SHUFFLED, hotLabels=0)
    model = indexer.fit(events).co_partition()
    rows = read_table_stream(spark, folder, "events").select("event_id", "user_id")
    written, checkpoint = new_folder(spark, "stream"), new_folder(spark, "progress")
    write_transformed(model, rows, written, checkpoint).awaitTermination()
    return spark.read.schema(model.output_schema(rows.schema)).parquet(written)


def reload_dealt_model(spark: SparkSession, folder: str) -> DataFrame:
    """Saved and loaded in buckets; a third of the keys are unknown, a third null."""
    lines = _order_labels(spark, folder)
    saved = new_folder(spark, "saved")
    indexer = LabelIndexer(inputCol="order_label", outputCol="idx").setPlanLimits(**_SHUFFLED, hotLabels=0)
    indexer.fit(lines).co_partition(16).write().overwrite().save(saved)
    part = F.col("l_orderkey") % 3
    asked = F.when(part == 0, F.col("order_label")).when(part == 1, F.concat(F.lit("?"), "order_label"))
    return LabelIndexerModel.load(saved).transform(lines.withColumn("order_label", asked))


def label_index_collated(spark: SparkSession, folder: str) -> DataFrame:
    """Segments in two spellings that their collation holds equal."""
    segment = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    customers = read_table(spark, folder, "customer").select(
        "c_custkey", F.collate(segment, "UTF8_LCASE").alias("a"), F.collate(segment, "UNICODE_CI").alias("b")
    )
    stages = [
        LabelIndexer(inputCol="a", outputCol="idx"),
        CategoryMapper(inputCol="b", outputCol="number").setPlanLimits(**_SHUFFLED),
        DropColumn(column="a"),
        DropColumn(column="b"),
    ]
    return IndexPipeline(stages=stages).fit(customers).transform(customers)


def label_index_utf16(spark: SparkSession, folder: str) -> DataFrame:
    """Names that begin with characters above U+FFFF, between U+E000 and U+FFFF, or below."""
    first = F.element_at(F.array(*map(F.lit, "z\uff5e\U0001f600\ue000")), (F.col("c_custkey") % 4 + 1).cast("int"))
    customers = read_table(spark, folder, "customer").select("c_custkey", F.concat(first, "c_name").alias("label"))
    indexer = LabelIndexer(inputCol="label", outputCol="idx").setTextOrder("utf16")
    return indexer.fit(customers).transform(customers)


def model_from_mapping_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """A given mapping; which parts are frequent is learned from the lines."""
    sizes = read_table(spark, folder, "part").select("p_partkey", "p_size")
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )
    model = CategoryMapperModel(inputCol="l_partkey", outputCol="idx").setPlanLimits(**_SHUFFLED)
    return model.setMappingCat(sizes).learn_hot(lines).transform(lines)


def category_map_decimal_key(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on narrow decimals, applied to wide ones."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    )
    wide = lines.withColumn("price", F.col("price").cast("decimal(20,4)"))
    model = CategoryMapper(inputCol="price", outputCol="idx").fit(lines)
    return DropColumn(column="price").transform(model.transform(wide))


def category_map_array_key(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part").select(
        "p_partkey", F.array("p_brand", "p_type").alias("kind")
    )
    model = CategoryMapper(inputCol="kind", outputCol="idx").fit(parts)
    return DropColumn(column="kind").transform(model.transform(parts))


ALL = (
    label_index,
    label_index_counts,
    label_mapping,
    category_mapping,
    label_index_unseen,
    label_index_nulls,
    label_index_high_card,
    label_index_long_text,
    label_index_urls,
    label_index_replace_output,
    label_index_replace_input,
    label_index_empty_fit,
    category_map_unseen,
    category_map_text,
    category_map_numeric_key,
    category_map_double_key,
    category_map_time_key,
    category_map_date_key,
    drop_column,
    drop_missing_column,
    drop_unset_column,
    index_then_drop,
    two_indexers,
    mixed_indexers,
    unread_index,
    indexer_then_mapper,
    model_from_mapping,
    label_model_from_mapping,
    label_index_stream,
    reload_label_model,
    reload_category_model,
    reload_drop,
    reload_estimator,
    reload_fitted_chain,
    label_index_ranked,
    label_mapping_ranked,
    label_index_shuffled,
    category_map_shuffled,
    label_index_shuffled_hot,
    label_index_hot_text,
    category_map_mostly_unknown,
    label_index_between,
    two_shuffled_indexers,
    reload_ranked_model,
    reload_versioned_chain,
    stream_shuffled,
    reload_dealt_model,
    label_index_collated,
    label_index_utf16,
    model_from_mapping_shuffled,
    category_map_decimal_key,
    category_map_array_key,
)

QUERIES = {query.__name__: query for query in ALL}
