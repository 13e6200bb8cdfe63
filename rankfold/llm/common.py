"""What the operators of this folder share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import rankfold
from rankfold.functions.names import fresh
from rankfold.sources.store import new_folder, remove_folder


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    On a cluster the package is installed, or sent with ``--py-files``; then the added
    path is simply not there.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(rankfold.__file__)))
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def in_arrow(frame: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    reach_workers(frame.sparkSession)
    return frame.mapInArrow(function, schema)


#: Folders written by the operators that are at work in this thread, the innermost last.
_AT_WORK: ContextVar[tuple[list[str], ...]] = ContextVar("_AT_WORK", default=())


@contextmanager
def inner_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside once the block ends, but those written to ``keep``.

    What the block returns must not read them any more.
    """
    folders: list[str] = []
    token = _AT_WORK.set((*_AT_WORK.get(), folders))
    try:
        yield
    finally:
        _AT_WORK.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def written(frame: DataFrame, kind: str, keep: bool = False) -> DataFrame:
    """The same rows, kept in a table that outlives any executor.

    Inside ``inner_tables`` the table goes when the block ends; one to ``keep``, when the
    block around that one does. Shuffle files go as soon as the table is there.
    """
    path = new_folder(frame.sparkSession, kind)
    open_blocks = _AT_WORK.get()
    if keep:
        open_blocks = open_blocks[:-1]
    if open_blocks:
        open_blocks[-1].append(path)
    with _shuffles_removed(frame.sparkSession):
        frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_REMOVAL_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let a query's shuffle files go at its end, when what it computed is written."""
    before = spark.conf.getAll.get(_REMOVAL_SETTING)
    spark.conf.set(_REMOVAL_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVAL_SETTING)
        else:
            spark.conf.set(_REMOVAL_SETTING, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: str | Column) -> Column:
    """A text column; null is the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def column(name: str) -> Column:
    """A column by its exact name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Texts that one call of a text function takes at once.
TEXTS_AT_ONCE = 256


def map_texts(docs: DataFrame, make, schema: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row out for each row in: the keys, and the columns a text function gives.

    ``make`` is called once in each task and returns a function from a list of texts
    (UTF-8; null is the empty text) to a list of columns named in ``schema``.
    """
    import pyarrow as pa

    frame = docs.select(*[column(key).alias(key) for key in keys], whole(column(text)).cast("binary").alias("text"))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in frame.drop("text").dtypes)
    width = len(keys)

    def mapped(batches):
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                made = work(part.column(width).to_pylist())
                names = [*part.schema.names[:width], *made]
                yield pa.record_batch([*part.columns[:width], *(c[0] if isinstance(c[0], pa.Array) else pa.array(*c) for c in made.values())], names=names)

    return in_arrow(frame, mapped, f"{fields}, {schema}")


def rewrite_texts(docs: DataFrame, make) -> DataFrame:
    """The same rows and columns; ``text`` is rewritten and ``n_chars``, if there is one, its new length.

    ``make`` is called once in each task and returns a function from one text to another.
    Null texts stay null, and so does their length.
    """
    import pyarrow as pa

    names = docs.columns
    text, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    kinds = {"text": "string", "n_chars": "bigint"}
    schema = ", ".join(f"`{name.replace('`', '``')}` {kinds.get(name, kind)}" for name, kind in docs.dtypes)

    def rewritten(batches):
        rewrite = make()
        for batch in batches:
            columns = list(batch.columns)
            made = [None if value is None else rewrite(value) for value in columns[text].to_pylist()]
            columns[text] = pa.array(made, pa.string())
            if length is not None:
                columns[length] = pa.array([None if value is None else len(value) for value in made], pa.int64())
            yield pa.record_batch(columns, names=batch.schema.names)

    return in_arrow(docs, rewritten, schema)


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key that tells its rows apart by text and by all other columns, and its name.

    The text counts by 128 bits, the rest by 64; a null text and an empty one differ.
    """
    key = fresh("row_key")
    others = [column(name) for name, kind in docs.dtypes if name != "text" and "map<" not in kind and "variant" not in kind]
    text = F.coalesce(F.unhex(F.md5(column("text").cast("binary"))), F.lit("").cast("binary"))
    return docs.withColumn(key, F.concat(text, F.unhex(F.hex(F.xxhash64(*others))))), key


def only_rows(keyed: DataFrame, key: str, rows: DataFrame, how: str) -> DataFrame:
    """The rows of ``keyed`` that are among ``rows`` (``left_semi``) or not (``left_anti``)."""
    name, named = fresh("id"), fresh("key")
    rows = rows.select(F.col("doc_id").alias(name), F.col(key).alias(named))
    same = keyed["doc_id"].eqNullSafe(F.col(name)) & (keyed[key] == F.col(named))
    return keyed.join(rows, same, how).drop(key)


#: A key that meets more than one in so many of the rows, and so many rows, is broadcast.
HOT_SHARE, HOT_ROWS = 1000, 1000


def spread_join(rows: DataFrame, keyed: DataFrame, on: list[str], total: int, wanted: str = "true") -> DataFrame:
    """``rows`` joined with the ``wanted`` of ``keyed``; its ``n_met`` says how many of ``total`` rows a key meets.

    Keys that meet more than one in ``HOT_SHARE`` of the rows, so fewer than that many, are
    broadcast and their rows stay where they are.
    """
    bound = max(HOT_ROWS, total // HOT_SHARE)
    hot, rest = keyed.where(F.col("n_met") > bound), keyed.where((F.col("n_met") <= bound) & F.expr(wanted)).drop("n_met")
    if not hot.limit(1).count():
        return rows.join(rest, on)
    others = rows.join(F.broadcast(hot.select(*on).distinct()), on, "left_anti")
    return rows.join(F.broadcast(hot.where(wanted).drop("n_met")), on).unionByName(others.join(rest, on))
