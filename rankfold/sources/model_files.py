"""Saved models: ``metadata/`` by Spark's own writer, the mapping as Parquet.

``data/`` holds ``category, idx``; ``hot/`` the hashes of the most frequent values, if any.
A large mapping is read where it was saved; one inside another saved model is copied, since a
chain that is overwritten removes its stages' files before they are written. With a mapping
store there is no ``data/`` for large ones: the metadata name a version, which is never copied.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from rankfold.operators.limits import Limits
from rankfold.operators.mapping import Mapping, may_hold
from rankfold.sources.bucketed import read_buckets, write_buckets
from rankfold.sources.store import inside_saved, new_folder, qualified
from rankfold.sources.versions import is_version, new_version, store_of


class MappingModelWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def save(self, path: str) -> None:
        mapping = self.instance._frozen()
        if mapping.folder is not None and not mapping.own_folder:
            source, target = (qualified(self.sparkSession, p) for p in (mapping.folder, path))
            if source == target or source.startswith(target.rstrip("/") + "/"):
                # Its own files are about to be removed: take the mapping over first.
                self.instance._mapping = copied(self.sparkSession, mapping)
        super().save(path)

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        mapping = self.instance._frozen()
        version = self._version(mapping)
        DefaultParamsWriter.saveMetadata(
            self.instance,
            path,
            spark,
            extraMetadata={
                "mapping": {
                    "schema": mapping.schema().jsonValue(),
                    "labels": mapping.labels,
                    "keyBytes": mapping.key_bytes,
                    "hot": len(mapping.hot),
                    "buckets": mapping.buckets.count if mapping.buckets else 0,
                    "version": version,
                }
            },
        )
        if version is None:
            self._write(mapping, f"{path}/data")
        if mapping.hot:
            mapping.hot_frame(spark).coalesce(1).write.parquet(f"{path}/hot")

    def _version(self, mapping: Mapping) -> str | None:
        """The mapping's version in the session's store, written if it is not there yet."""
        spark = self.sparkSession
        store = store_of(spark)
        if store is None or mapping.held is not None:
            return None
        # A version that has been dealt into buckets since is another one.
        dealt = mapping.buckets is not None and mapping.buckets.folder != mapping.folder
        if is_version(spark, mapping.folder, store) and not dealt:
            return mapping.folder
        version = new_version(store)
        self._write(mapping, version)
        return version

    def _write(self, mapping: Mapping, folder: str) -> None:
        frame = mapping.frame(self.sparkSession)
        if mapping.held is not None:
            frame = frame.coalesce(1)
        if mapping.buckets is not None:
            write_buckets(frame, folder, mapping.buckets.count).forget(self.sparkSession)
        else:
            frame.write.parquet(folder)


class MappingModelReader(MLReader):
    def __init__(self, model_class):
        super().__init__()
        self.model_class = model_class

    def load(self, path: str):
        spark = self.sparkSession
        name = f"{self.model_class.__module__}.{self.model_class.__name__}"
        metadata = DefaultParamsReader.loadMetadata(path, spark, name)
        model = self.model_class()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._mapping = self._load_mapping(path, metadata["mapping"], model._limits(spark))
        return model

    def _load_mapping(self, path: str, saved: dict, limits: Limits) -> Mapping:
        spark = self.sparkSession
        schema = T.StructType.fromJson(saved["schema"])
        key_type, index_type = schema["category"].dataType, schema["idx"].dataType
        labels, key_bytes = saved["labels"], saved["keyBytes"]
        folder = saved.get("version") or f"{path}/data"
        mapping = Mapping(
            key_type, index_type, labels, key_bytes, folder=folder, own_folder=False
        )
        if may_hold(key_type, labels, key_bytes, limits):
            frame = mapping.frame(spark).coalesce(1).sortWithinPartitions("idx")
            mapping = replace(mapping, folder=None, own_folder=True, held=frame.toArrow())
        else:
            if saved.get("buckets"):
                dealt = read_buckets(spark, qualified(spark, folder), schema, saved["buckets"])
                mapping = replace(mapping, buckets=dealt)
            if not saved.get("version") and inside_saved(spark, path):
                mapping = copied(spark, mapping)
        if saved.get("hot"):
            hot = spark.read.schema("hash bigint").parquet(f"{path}/hot").toArrow()
            mapping = replace(mapping, hot=tuple(hot["hash"].to_pylist()))
        return mapping


def copied(spark: SparkSession, mapping: Mapping) -> Mapping:
    """The same mapping in a working table."""
    folder = new_folder(spark, "mapping")
    buckets = None
    if mapping.buckets is not None:
        buckets = write_buckets(mapping.frame(spark), folder, mapping.buckets.count)
        mapping.buckets.forget(spark)
    else:
        mapping.frame(spark).write.parquet(folder)
    return replace(mapping, folder=folder, slice_starts=None, own_folder=True, buckets=buckets)
