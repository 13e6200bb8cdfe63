"""Applying a mapping: every row keeps its place in the result, with its index."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.functions.labels import has_exact_literals, literal_lookup, steady_hash
from rankfold.functions.names import fresh, quoted
from rankfold.functions.schemas import common_key_type, is_collated
from rankfold.operators.known_keys import bitmap_bits, may_be_known
from rankfold.operators.limits import Limits
from rankfold.operators.mapping import Mapping


# What a stage has returned: the table it was made from, and the column that differs. Rows and
# all other columns are the same.
_SOURCES: WeakKeyDictionary[DataFrame, tuple[DataFrame, str]] = WeakKeyDictionary()


def note_source(result: DataFrame, source: DataFrame, changed: str) -> DataFrame:
    _SOURCES[result] = (source, changed.lower())
    return result


def source_of(dataset: DataFrame, columns: list[str]) -> DataFrame:
    """The earliest table that has these columns as ``dataset`` has them.

    What is learned from them is the same there, and no lookup of an earlier stage is in its plan.
    """
    names = {column.lower() for column in columns}
    while dataset in _SOURCES and _SOURCES[dataset][1] not in names:
        dataset = _SOURCES[dataset][0]
    return dataset


def add_index(
    dataset: DataFrame,
    input_col: str,
    output_col: str,
    mapping: Mapping,
    missing: float | None,
    limits: Limits,
) -> DataFrame:
    """Add ``output_col``: the index of ``input_col``, or ``missing`` if it has none.

    The plan follows the size of the mapping. A few labels are an expression in
    the scan's own stage; a mapping of checked size is broadcast; any other is
    joined by shuffle. Column order is that of ``withColumn``.
    """
    key_type = common_key_type(dataset.schema[input_col].dataType, mapping.key_type)
    key = F.col(quoted(input_col))
    if mapping.held is not None and mapping.labels <= limits.literal_labels and (
        has_exact_literals(key_type) or not mapping.labels
    ):
        found = literal_lookup(key, mapping.pairs(), key_type, mapping.index_type)
        return dataset.withColumn(output_col, _or_missing([found], missing))
    if dataset.schema[input_col].dataType != key_type:
        key = key.cast(key_type)
    if mapping.broadcastable(limits):
        return _broadcast_lookup(dataset, key, key_type, output_col, mapping, missing)
    if mapping.buckets is not None and key_type == mapping.key_type and not mapping.hot:
        return _dealt_lookup(dataset, key, key_type, output_col, mapping, missing, limits)
    if bitmap_bits(mapping.labels) // 8 <= limits.known_bytes and not (
        dataset.isStreaming or is_collated(key_type)
    ):
        return _reduced_lookup(dataset, input_col, key, key_type, output_col, mapping, missing, limits)
    return _shuffled_lookup(
        dataset, input_col, key, key_type, output_col, mapping, missing, limits
    )


def _reduced_lookup(
    dataset: DataFrame,
    input_col: str,
    key: Column,
    key_type: T.DataType,
    output_col: str,
    mapping: Mapping,
    missing: float | None,
    limits: Limits,
) -> DataFrame:
    """Only rows whose value may have an entry are shuffled; the others take the default where they are."""
    mark = fresh("known")
    marked = may_be_known(dataset, key, key_type, mapping, mark)
    known = marked.where(F.col(mark)).drop(mark)
    found = _shuffled_lookup(known, input_col, key, key_type, output_col, mapping, missing, limits)
    default = F.lit(missing).cast(mapping.index_type)
    return found.union(marked.where(~F.col(mark)).drop(mark).withColumn(output_col, default))


def _or_missing(found: list[Column], missing: float | None) -> Column:
    options = found if missing is None else [*found, F.lit(missing)]
    return F.coalesce(*options) if len(options) > 1 else options[0]


def _broadcast_lookup(
    dataset: DataFrame,
    key: Column,
    key_type: T.DataType,
    output_col: str,
    mapping: Mapping,
    missing: float | None,
) -> DataFrame:
    label, index = fresh("label"), fresh("index")
    entries = _entries(mapping.frame(dataset.sparkSession), key_type, label, index)
    if mapping.slice_starts is None:
        # What the driver or one task has sorted is one partition: grouping needs no shuffle.
        entries = _each_once(entries.coalesce(1), [label], index)
    return (
        dataset.join(F.broadcast(entries), key == F.col(label), "left")
        .withColumn(output_col, _or_missing([F.col(index)], missing))
        .drop(label, index)
    )


def _shuffled_lookup(
    dataset: DataFrame,
    input_col: str,
    key: Column,
    key_type: T.DataType,
    output_col: str,
    mapping: Mapping,
    missing: float | None,
    limits: Limits,
) -> DataFrame:
    """Join by key over a shuffle that no single key can overload.

    Rows of frequent values spread over ``places`` by the partition they come from, and
    the entries of such values, if the mapping has any, are copied to each place. Rows
    without a key need no match and spread likewise. Where a row goes is a fixed property
    of it rather than a random number: a task that runs again sends it to the same place.
    Skew that no table has shown before is left to adaptive execution.
    """
    spark, places = dataset.sparkSession, limits.hot_spread
    label, index = fresh("label"), fresh("index")
    entries = _entries(mapping.frame(spark), key_type, label, index)
    scratch, parts = [label, index], [label]
    matches = key == F.col(label)
    # Only where a row may be moved: Catalyst moves no filter below the mark.
    if dataset.schema[input_col].nullable or mapping.hot:
        origin = F.pmod(F.spark_partition_id(), F.lit(places)).cast("long")
        spread, label_spread = fresh("spread"), fresh("label_spread")
        moved = key.isNull()
        # Equal texts of a collation have unlike hashes: they go by the join's own alone.
        spread_of = (lambda c: F.lit(0).cast("long")) if is_collated(key_type) else F.xxhash64
        copies = F.array(spread_of(F.col(label)))
        if mapping.hot:
            hot, hot_entry = fresh("hot"), fresh("hot_entry")
            hashes = F.broadcast(mapping.hot_frame(spark).coalesce(1).distinct())
            dataset = dataset.join(
                hashes.withColumnRenamed("hash", hot),
                steady_hash(key, key_type) == F.col(hot),
                "left",
            )
            entries = entries.join(
                hashes.withColumnRenamed("hash", hot_entry),
                steady_hash(F.col(label), key_type) == F.col(hot_entry),
                "left",
            )
            moved = moved | F.col(hot).isNotNull()
            everywhere = F.sequence(F.lit(0).cast("long"), F.lit(places - 1).cast("long"))
            copies = F.when(F.col(hot_entry).isNotNull(), everywhere).otherwise(copies)
            scratch.append(hot)
        dataset = dataset.withColumn(spread, F.when(moved, origin).otherwise(spread_of(key)))
        entries = entries.select(label, index, F.explode(copies).alias(label_spread))
        matches = (F.col(spread) == F.col(label_spread)) & matches
        scratch += [spread, label_spread]
        parts = [label_spread, label]
    if limits.prunable:
        entries = _each_once(entries, parts, index)
    return (
        dataset.join(entries, matches, "left")
        .withColumn(output_col, _or_missing([F.col(index)], missing))
        .drop(*scratch)
    )


def _dealt_lookup(
    dataset: DataFrame,
    key: Column,
    key_type: T.DataType,
    output_col: str,
    mapping: Mapping,
    missing: float | None,
    limits: Limits,
) -> DataFrame:
    """Join with a mapping that lies in buckets by key: only the rows are shuffled.

    A task holds its bucket, whose size is bounded, and lets the rows pass unsorted, so its memory does
    not grow with them. Buckets too large for that, of models dealt under other limits, are joined
    by sorting. Rows without a key are spread by the partition they come from: they get one of
    some keys, several for each bucket, and what they meet does not count.
    """
    label, index = fresh("label"), fresh("index")
    entries = _entries(mapping.buckets.frame(dataset.sparkSession), key_type, label, index)
    entries = _each_once(entries, [label], index)
    if mapping.buckets_fit(limits):
        entries = entries.hint("shuffle_hash")
    met, found = key, F.col(index)
    if isinstance(key_type, (T.StringType, *_INTEGERS)):
        places = min(max(limits.hot_spread, 4 * mapping.buckets.count), _PLACES.get(type(key_type), 1 << 20))
        origin = F.pmod(F.spark_partition_id(), F.lit(places))
        met = F.coalesce(key, origin.cast(key_type))
        found = F.when(key.isNotNull(), found)
    own = fresh("key")
    return (
        dataset.withColumn(own, met)
        .join(entries, F.col(own) == F.col(label), "left")
        .withColumn(output_col, _or_missing([found], missing))
        .drop(label, index, own)
    )


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# As many places as short types have numbers for.
_PLACES = {T.ByteType: 100, T.ShortType: 30_000}


def _each_once(entries: DataFrame, keys: list[str], index: str) -> DataFrame:
    """The same entries, in a form that shows Catalyst that their keys are unique.

    A lookup whose index nobody reads is then left out of the plan. The grouping shuffles by
    the keys the join needs, so the join adds no shuffle to it.
    """
    return entries.groupBy(*keys).agg(F.any_value(index).alias(index))


def _entries(frame: DataFrame, key_type: T.DataType, label: str, index: str) -> DataFrame:
    category = F.col("category")
    if frame.schema["category"].dataType != key_type:
        category = category.cast(key_type)
    return frame.select(category.alias(label), F.col("idx").alias(index))
