"""Near copies by SimHash fingerprints and Golay keys.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. When two fingerprints
differ in few bits, the errors cannot be many in every segment: for two bits one segment is
equal and another differs in at most two, for five bits two segments differ in at most two
each. So a key is made of one segment as it is and a Golay key of another, or of Golay keys
of two; near fingerprints share one. Fingerprints that share a key are joined, and their
distance is taken. Only different fingerprints are joined, whatever the number of copies.

Keys that very many fingerprints share are refined: the fingerprint is cut into more parts
than bits may differ, and the parts that must then be equal join the key. A key, fingerprint or
node that a thousandth of the rows share is met by broadcast, and its rows are not gathered.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm import golay
from rankfold.llm.common import column, in_arrow, inner_tables, map_texts, spread_join, written
from rankfold.llm.components import components

#: Lowest bit and width of each segment.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Members above which a key is refined, and the equal parts that then join it.
CROWDED, EQUAL_PARTS = 1000, 6
_BLOCK = 1 << 16


def shingle_hashes(text: bytes, size: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words, A-Z lower-cased, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, ">u8")
    joined, ends = b" ".join(words), []
    at = -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends[: max(0, len(words) - size)])]
    stops = ends[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], ">u8")


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed long."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start : start + _BLOCK]
        counts += np.unpackbits(block.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``fp`` of every row, besides ``keys``; a text without words, null too, has zero."""

    def make():
        return lambda texts: {"fp": ([fingerprint(shingle_hashes(text)) for text in texts], pa.int64())}

    return map_texts(docs, make, "fp bigint", keys=keys)


def _segment(values: np.ndarray, k: int) -> np.ndarray:
    low, width = SEGMENTS[k]
    return (values >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)


def golay_keys(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``(position of the fingerprint, key)``."""
    parts = [_segment(values, k) for k in range(3)]
    fuzzy = [golay.keys(part) for part in parts]
    rows, found = [], []
    places = np.arange(len(values))
    if max_bits <= 2:
        for tag, (exact, near) in enumerate(((0, 1), (1, 0), (2, 0))):
            for c in range(6):
                some = fuzzy[near][:, c] >= 0
                rows.append(places[some])
                found.append((tag << 36 | parts[exact] << 12 | fuzzy[near][:, c])[some])
    else:
        for tag, (a, b) in enumerate(combinations(range(3), 2)):
            for c in range(6):
                for d in range(6):
                    some = (fuzzy[a][:, c] >= 0) & (fuzzy[b][:, d] >= 0)
                    rows.append(places[some])
                    found.append((tag << 36 | fuzzy[a][:, c] << 12 | fuzzy[b][:, d])[some])
    return np.concatenate(rows), np.concatenate(found)


def _keyed(values: DataFrame, max_bits: int) -> DataFrame:
    def keyed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                fps = batch.column(0).slice(start, 2000).to_numpy(zero_copy_only=False)
                at, keys = golay_keys(fps.view(np.uint64), max_bits)
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(fps[at], pa.int64())], names=["key", "fp"])

    return in_arrow(values.select("fp"), keyed, "key bigint, fp bigint")


def _refined(crowded: DataFrame, max_bits: int) -> DataFrame:
    """``key, part, same, fp``: each choice of parts that may be the equal ones."""
    count = max_bits + EQUAL_PARTS
    edges = [round(64 * i / count) for i in range(count + 1)]
    masks = [
        sum(((1 << edges[p + 1]) - 1) ^ ((1 << edges[p]) - 1) for p in chosen)
        for chosen in combinations(range(count), EQUAL_PARTS)
    ]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    choices = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(mask).cast("long").alias("mask")) for i, mask in enumerate(signed)])
    return crowded.withColumn("choice", F.explode(choices)).select(
        *crowded.columns, F.col("choice.part").alias("part"), F.col("fp").bitwiseAND(F.col("choice.mask")).alias("same")
    )


def near_pairs(values: DataFrame, max_bits: int = 2, crowded: int = CROWDED) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints in ``fp`` that differ in at most ``max_bits``.

    ``values`` holds each fingerprint once. ``max_bits`` is at most 5.
    """
    keyed = shared_keys(values, max_bits)
    errors = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    near = (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(errors) <= max_bits)
    # A pair that shares keys of several kinds is told by one kind alone.
    near = near & (F.shiftright("x.key", 36) == _first_kind(errors, max_bits))
    pair = [F.col("x.fp").alias("a"), F.col("y.fp").alias("b")]
    few = keyed.where(F.col("n") <= crowded)
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & near).select(*pair)
    many = keyed.where(F.col("n") > crowded)
    if many.limit(1).count():
        fine = written(_refined(many, max_bits), "refined")
        same = [F.col(f"x.{name}") == F.col(f"y.{name}") for name in ("key", "part", "same")]
        more = fine.alias("x").join(fine.alias("y"), same[0] & same[1] & same[2] & near).select(*pair)
        pairs = pairs.unionAll(more)
    return written(pairs.distinct(), "near")


def _first_kind(errors: Column, max_bits: int) -> Column:
    """The first kind of key that two fingerprints with these errors are certain to share."""
    a, b, c = (
        F.bit_count(F.shiftrightunsigned(errors, low).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
        for low, width in SEGMENTS
    )
    if max_bits <= 2:
        return F.when(a == 0, 0).when(b == 0, 1).otherwise(2)
    return F.when((a <= 2) & (b <= 2), 0).when((a <= 2) & (c <= 2), 1).otherwise(2)


def shared_keys(values: DataFrame, max_bits: int) -> DataFrame:
    """``key, fp, n`` of the keys that two fingerprints or more have, ``n`` of them."""
    if not 0 < max_bits <= 5:
        raise ValueError("max_bits must be from 1 to 5")
    keyed = written(_keyed(values, max_bits), "keys")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(shared.withColumn("n_met", F.col("n")), "shared")
    return written(spread_join(keyed, shared, ["key"], keyed.count()), "shared-keys")


def link_fingerprints(
    docs: DataFrame, max_bits: int = 2, crowded: int = CROWDED, keys: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per document: ``keys, fp, root, component_id``, the smallest id it is linked to.

    ``root`` names the group by one of its fingerprints. Null ids are passed over where there
    are others. Documents whose fingerprints are equal are linked, those without words too.
    ``keys`` holds ``doc_id``; other columns of ``docs`` than these and the text are not read.
    """
    with inner_tables(docs.sparkSession):
        rows = written(fingerprints(docs, keys), "fingerprints", keep=True)
        each = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_met"))
        firsts = written(each, "firsts")
        roots = components(near_pairs(firsts, max_bits, crowded))
        placed = firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "first", "n_met", F.coalesce("root", "fp").alias("root")
        )
        smallest = placed.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
        named = placed.join(smallest, F.col("root") == F.col("r")).select("fp", "root", "component_id", "n_met")
        named = written(named, "groups", keep=True)
    return spread_join(rows, named, ["fp"], rows.count()).select(*[column(key) for key in keys], "fp", "root", "component_id")
