"""Mappings kept once, as immutable versions that saved models name.

With ``spark.rankfold.mappingStore`` set, a large mapping is saved as a folder of its own in
that store and a model's metadata is the manifest that names it. Saving a model again, alone or in a
chain, names the same version; overwriting or removing a saved model takes a manifest away and
no version, so whoever has loaded it goes on reading. A version is whole before a manifest
names it. The store must not lie inside a saved model.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from rankfold.sources.store import children, exists, qualified, remove_folder

STORE_SETTING = "spark.rankfold.mappingStore"

_PREFIX = "version-"


def store_of(spark: SparkSession) -> str | None:
    """The session's store, as a whole address."""
    store = spark.conf.get(STORE_SETTING, None)
    return qualified(spark, store).rstrip("/") if store else None


def new_version(store: str) -> str:
    return f"{store}/{_PREFIX}{uuid.uuid4().hex}"


def is_version(spark: SparkSession, folder: str | None, store: str) -> bool:
    return folder is not None and qualified(spark, folder).startswith(f"{store}/{_PREFIX}")


def remove_unused_versions(spark: SparkSession, saved: list[str]) -> list[str]:
    """Remove the versions of the session's store that none of the ``saved`` models names.

    ``saved`` are the folders of all models and chains saved with this store; a folder that holds
    no model is an error. Nothing may be saved, and no model in use may rest on a version
    that is not named, while this runs. Returns the folders removed.
    """
    store = store_of(spark)
    if store is None:
        raise ValueError(f"{STORE_SETTING} is not set")
    named = {version for path in saved for version in _named(spark, path)}
    unused = [folder for folder in children(spark, store) if is_version(spark, folder, store) and folder not in named]
    for folder in unused:
        remove_folder(spark, folder)
    return unused


def _named(spark: SparkSession, path: str) -> set[str]:
    """The versions that a saved model names, or a chain's stages do."""
    if not exists(spark, f"{path}/metadata"):
        raise ValueError(f"no saved model in {path}")
    saved = json.loads(spark.read.text(f"{path}/metadata").head()[0])
    found = {saved["mapping"]["version"]} if saved.get("mapping", {}).get("version") else set()
    for inner in children(spark, path):
        name = inner.rsplit("/", 1)[1]
        parts = children(spark, inner) if name == "stages" else [inner]
        for part in parts:
            if exists(spark, f"{part}/metadata"):
                found |= _named(spark, part)
    return found
