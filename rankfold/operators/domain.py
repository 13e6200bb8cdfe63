"""Learning a column's domain: distinct values, sorted, numbered from 0."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from itertools import accumulate

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.functions.labels import steady_hash, stored_bytes
from rankfold.functions.names import quoted
from rankfold.functions.schemas import is_collated
from rankfold.operators.limits import Limits
from rankfold.operators.lookup import source_of
from rankfold.operators.mapping import (
    SLICE_BITS,
    Mapping,
    may_hold,
    memory_bytes,
    read_positions,
)
from rankfold.sources.store import new_folder

_INT_LABELS = 2**31

_SAMPLE_SETTING = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


@dataclass(frozen=True)
class Wanted:
    """A column whose domain is to be learned, and what the mapping shall be like."""

    column: str
    index_type: T.DataType
    limits: Limits
    # Text by UTF-16 units in place of code points.
    utf16: bool = False

    def order(self) -> Column:
        category = F.col("category")
        # Big-endian units compare as bytes.
        return F.encode(category, "UTF-16BE") if self.utf16 else category


# Columns that one aggregate counts; more are counted in several.
_TOGETHER = 16


def learn_mapping(
    dataset: DataFrame, column: str, index_type: T.DataType, limits: Limits
) -> Mapping:
    """Number the distinct non-null values of ``column`` in ascending order."""
    return learn_mappings(dataset, [Wanted(column, index_type, limits)])[0]


def learn_mappings(dataset: DataFrame, wanted: list[Wanted]) -> list[Mapping]:
    """Number the distinct non-null values of each column in ascending order.

    One scan reads the columns, and one aggregate counts the values of all of them. Each task
    adds up its own duplicates before the one shuffle, so a value that fills a third of the
    table costs one row per task. The counts tell the frequent values, exactly.
    """
    if dataset.isStreaming:
        raise ValueError("fit needs a batch table, not a stream")
    dataset = source_of(dataset, [w.column for w in wanted])
    learned = []
    for start in range(0, len(wanted), _TOGETHER):
        learned += _learn_together(dataset, wanted[start : start + _TOGETHER])
    return learned


def _learn_together(dataset: DataFrame, wanted: list[Wanted]) -> list[Mapping]:
    names = [f"c{i}" for i in range(len(wanted))]
    counted = _counted(dataset, [w.column for w in wanted], names).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        slices = [
            counted.where(F.col("slot") == i).select(F.col(name).alias("category"), "n")
            for i, name in enumerate(names)
        ]
        sizes = []
        for i, name in enumerate(names):
            mine = F.col("slot") == i
            size = stored_bytes(F.col(name), counted.schema[name].dataType)
            sizes += [
                F.count_if(mine),
                F.coalesce(F.sum(F.when(mine, size)), F.lit(0)),
                F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)),
            ]
        found = counted.agg(*sizes).head()
        cached = sum(memory_bytes(found[3 * i], found[3 * i + 1]) for i in range(len(wanted)))
        return [
            _number(values, w, cached, *found[3 * i : 3 * i + 3])
            for i, (values, w) in enumerate(zip(slices, wanted))
        ]
    finally:
        counted.unpersist()


def _counted(dataset: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    """``slot, n`` and a column for each name: the distinct non-null values of each column.

    A row has a value in the column of its slot alone. Several columns are grouped by one at
    a time in the same aggregate. Of texts that a collation holds equal, the first by code point
    stands for all.
    """
    renamed = dataset.select(*[F.col(quoted(c)).alias(name) for c, name in zip(columns, names)])
    n = F.count(F.lit(1)).alias("n")
    collated = {f.name: f.dataType for f in renamed.schema.fields if is_collated(f.dataType)}
    least = [F.min(F.collate(name, "UTF8_BINARY")).alias(f"least_{name}") for name in collated]

    def chosen(name: str) -> Column:
        if name not in collated:
            return F.col(name)
        here = F.when(F.col(name).isNotNull(), F.col(f"least_{name}"))
        return F.collate(here, collated[name].collation).alias(name)

    if len(names) == 1:
        present = renamed.where(F.col(names[0]).isNotNull())
        return present.groupBy(names[0]).agg(n, *least).select(chosen(names[0]), "n", F.lit(0).alias("slot"))
    grouped = renamed.groupingSets([[F.col(name)] for name in names], *names).agg(
        *[F.grouping(name).alias(f"other_{name}") for name in names], n, *least
    )
    slot = F.coalesce(
        *[F.when((F.col(f"other_{name}") == 0) & F.col(name).isNotNull(), i) for i, name in enumerate(names)]
    )
    return grouped.select(*map(chosen, names), "n", slot.alias("slot")).where(F.col("slot").isNotNull())


def _number(
    counted: DataFrame, wanted: Wanted, cached: int, labels: int, key_bytes: int, rows: int
) -> Mapping:
    """The mapping of one column's counted values, held or written as its size calls for.

    ``cached`` is the counted size of all columns' values, among which these lie.
    """
    index_type, limits = wanted.index_type, wanted.limits
    values = counted.select("category")
    key_type = values.schema["category"].dataType
    if isinstance(index_type, T.IntegerType) and labels > _INT_LABELS:
        raise ValueError(f"{labels} labels do not fit an int index")
    if may_hold(key_type, labels, key_bytes, limits):
        return _held(_gathered(values, cached, limits), wanted, labels, key_bytes)
    if memory_bytes(labels, key_bytes) <= limits.one_task_bytes:
        return _sorted_table(_gathered(values, cached, limits), wanted, labels, key_bytes)
    mapping = _ranked_table(values, wanted, labels, key_bytes)
    if mapping.broadcastable(limits) or limits.hot_labels < 1 or is_collated(key_type):
        return mapping
    # No more than ``hot_labels`` values can have that share of the rows.
    hot = counted.where(F.col("n") * limits.hot_labels >= rows)
    hashes = hot.select(steady_hash(F.col("category"), key_type).alias("hash")).distinct().collect()
    return replace(mapping, hot=tuple(row["hash"] for row in hashes))


def _gathered(values: DataFrame, cached: int, limits: Limits) -> DataFrame:
    """One column's values, few enough for one task, in one partition.

    The task picks them out of all that is cached, or is sent them where that is more than one
    task should read.
    """
    return values.coalesce(1) if cached <= limits.one_task_bytes else values.repartition(1)


def _held(values: DataFrame, wanted: Wanted, labels: int, key_bytes: int) -> Mapping:
    index_type = wanted.index_type
    # Few enough, as counted, for one task; a sort over all would be a job more.
    ordered = values.sortWithinPartitions(wanted.order()).toArrow()
    indexes = pa.array(range(labels), pa.int64()).cast(
        pa.float64() if isinstance(index_type, T.DoubleType) else pa.int32()
    )
    key_type = values.schema["category"].dataType
    held = ordered.append_column("idx", indexes)
    return Mapping(key_type, index_type, labels, key_bytes, held=held)


def _sorted_table(values: DataFrame, wanted: Wanted, labels: int, key_bytes: int) -> Mapping:
    """Sort in one task what was counted to fit there."""
    index_type = wanted.index_type
    spark = values.sparkSession
    folder = new_folder(spark, "mapping")
    # The row number of the only partition is the rank.
    rank = F.monotonically_increasing_id().cast(index_type)
    values.sortWithinPartitions(wanted.order()).select(
        "category", rank.alias("idx")
    ).write.parquet(folder)
    key_type = values.schema["category"].dataType
    return Mapping(key_type, index_type, labels, key_bytes, folder=folder)


def _ranked_table(values: DataFrame, wanted: Wanted, labels: int, key_bytes: int) -> Mapping:
    """Sort over all executors and number each slice; no task sees the whole domain.

    Slice bounds are sampled, so a second run could cut elsewhere. The positions
    are therefore written once, and the slice sizes are counted from that table.
    """
    spark = values.sparkSession
    key_type = values.schema["category"].dataType
    folder = new_folder(spark, "ranked")
    with _bounded_sample(spark, labels, key_bytes, wanted.limits):
        values.orderBy(wanted.order()).select(
            "category", F.monotonically_increasing_id().alias("position")
        ).write.parquet(folder)
    sizes = (
        read_positions(spark, folder, key_type)
        .groupBy(F.shiftright("position", SLICE_BITS).alias("slice"))
        .agg(F.count(F.lit(1)).alias("size"))
        .orderBy("slice")
        .collect()
    )
    starts = list(accumulate((row["size"] for row in sizes), initial=0))
    return Mapping(
        key_type,
        wanted.index_type,
        labels,
        key_bytes,
        folder=folder,
        slice_starts=pa.table(
            {"slice": [row["slice"] for row in sizes], "start": starts[:-1]},
            pa.schema([("slice", pa.int64()), ("start", pa.int64())]),
        ),
    )


# Fits may run in threads of one session, which share its options.
_SAMPLING = threading.Lock()


@contextmanager
def _bounded_sample(
    spark: SparkSession, labels: int, key_bytes: int, limits: Limits
) -> Iterator[None]:
    """Let a sort of long keys sample fewer of them to the driver.

    Spark draws up to three times the setting for each partition, in whole keys.
    Fewer samples make slices less even, not less right. One sort at a time has the
    option, and it is left as it was found.
    """
    partitions = int(
        spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        or spark.conf.get("spark.sql.shuffle.partitions")
    )
    room = limits.sample_bytes * labels // (3 * partitions * max(key_bytes, 1))
    with _SAMPLING:
        was_set = spark.conf.getAll.get(_SAMPLE_SETTING)
        usual = int(spark.conf.get(_SAMPLE_SETTING))
        spark.conf.set(_SAMPLE_SETTING, str(max(2, min(usual, room))))
        try:
            yield
        finally:
            if was_set is None:
                spark.conf.unset(_SAMPLE_SETTING)
            else:
                spark.conf.set(_SAMPLE_SETTING, was_set)


def hot_values(rows: DataFrame, column: str, limits: Limits) -> tuple[int, ...]:
    """Hashes of the values that hold at least one in ``hot_labels`` of the rows, about.

    One aggregate over a sketch of fixed size finds them: the values themselves are not
    shuffled. A value of any type and length counts by its hash. The hashes only steer the
    lookup, so a value that is missed or added changes no result.
    """
    value = F.col(quoted(column))
    data_type = rows.schema[column].dataType
    if limits.hot_labels < 1 or is_collated(data_type):
        return ()
    hashes = rows.where(value.isNotNull()).select(steady_hash(value, data_type).alias("hash"))
    tracked = min(1_000_000, max(1024, 8 * limits.hot_labels))
    found, total = hashes.agg(
        F.expr(f"approx_top_k(hash, {min(limits.hot_labels, tracked)}, {tracked})"),
        F.count(F.lit(1)),
    ).head()
    return tuple(row["item"] for row in found if row["count"] * limits.hot_labels >= total)
