"""Passages that recur, found and removed with sharded phrase automata.

A window of ``window`` words that stands in two places has, in both, the same smallest hash
among its runs of ``anchor`` words. So only those runs, the anchors, are counted over all
documents: about a tenth of the places. Documents are dealt into shards of bounded size. In
each shard an Aho-Corasick automaton is compiled from the anchors that recur anywhere and
stand in the shard; all its documents stream through it, and the windows around its hits are
counted over all shards by 128-bit keys. Windows that turn out to stand once are sent back;
a second stream through the automata takes all others as recurring, and removes them.

A shard gets an anchor or a window once, however often it stands there, so no passage
gathers in one place because many documents share it.
"""

from __future__ import annotations

import hashlib
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import column, in_arrow, partitions, reach_workers, whole, written

#: Bytes of text in a shard, about.
SHARD_BYTES = 4 << 20

_BASES = tuple(np.uint64(base) for base in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(33)) * _MIX
    return values ^ values >> np.uint64(29)


def _powers_of(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2**64."""
    known = _powers.get(k)
    if known is None or len(known[0]) < n:
        size = max(1 << 15, 1 << (n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASES[k]), -1, 1 << 64))
        known = tuple(np.full(size, base, np.uint64) for base in (_BASES[k], inverse))
        for row in known:
            row[0] = 1
            np.cumprod(row, out=row)
        if size <= 1 << 20:
            _powers[k] = known
    return known


def run_hashes(words: np.ndarray, size: int, k: int = 0) -> np.ndarray:
    """A hash of every run of ``size`` words, from running sums."""
    n = len(words)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = _powers_of(k, n)
    values = words if k == 0 else _mixed(words + _BASES[k])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * down[:n], dtype=np.uint64)))
    return _mixed((sums[size:] - sums[:-size]) * up[: n - size + 1])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The smallest or largest of every ``width`` neighbours."""
    out, size = values, 1
    while 2 * size <= width:
        out, size = pick(out[:-size], out[size:]), 2 * size
    if size < width:
        out = pick(out[: len(out) - (width - size)], out[width - size :])
    return out


def anchor_places(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs that have the smallest hash of a window, and their hashes."""
    runs = run_hashes(hashes, anchor)
    width = window - anchor + 1
    if len(runs) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = _sliding(runs, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), width, np.maximum) == runs)
    return chosen, runs[chosen]


def _grouped(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where equal rows start in sorted order, and the order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        held = key[order]
        new[1:] |= held[1:] != held[:-1]
    return np.flatnonzero(new), order


def _anchors(window: int, anchor: int):
    def anchors(batches):
        for batch in batches:
            shards, texts = batch.column(0).to_pylist(), batch.column(2)
            uids = batch.column(1).to_numpy(zero_copy_only=False)
            parts = []
            for i in range(batch.num_rows):
                places, found = anchor_places(word_hashes(_words(texts[i])), window, anchor)
                if len(places):
                    parts.append((found, np.full(len(found), shards[i]), np.full(len(found), uids[i]), places))
            if not parts:
                continue
            found, shard, uid, place = map(np.concatenate, zip(*parts))
            starts, order = _grouped([found, shard])
            counts = np.diff(np.append(starts, len(order)))
            first = order[starts]
            yield pa.record_batch(
                [
                    pa.array(found[first].view(np.int64)),
                    pa.array(shard[first], pa.int32()),
                    pa.array(uid[first], pa.int64()),
                    pa.array(place[first], pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["anchor", "shard", "uid", "place", "n"],
            )

    return anchors


class PhraseAutomaton:
    """Finds phrases of a fixed number of words in documents.

    Each known word is a code of equally many letters of a small alphabet, since the
    automaton looks through a node's branches one by one.
    """

    LETTERS = "abcdefghijklmnopqrstuvwxyz012345"

    def __init__(self, phrases: set[tuple[bytes, ...]], size: int):
        self.size, self.codes = size, {}
        known = {word for phrase in phrases for word in phrase}
        self.width = 1
        while len(self.LETTERS) ** self.width < len(known):
            self.width += 1
        for word, letters in zip(known, product(self.LETTERS, repeat=self.width)):
            self.codes[word] = "".join(letters)
        self.other = "." * self.width
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in phrases:
            self.automaton.add_word("".join([self.codes[word] for word in phrase]))
        self.automaton.make_automaton()

    def places(self, words: list[bytes]) -> np.ndarray:
        """Where phrases start."""
        if not self.codes or len(words) < self.size:
            return np.empty(0, np.int64)
        get, other, width = self.codes.get, self.other, self.width
        found = self.automaton.iter("".join([get(word, other) for word in words]))
        # A hit that does not end with a word's code is none.
        ends = np.array([end for end, _ in found if (end + 1) % width == 0], np.int64)
        return (ends + 1) // width - self.size


def _compiled(docs: pa.Table, phrases: pa.Table, anchor: int) -> PhraseAutomaton:
    """The automaton of a shard; phrases are named by a document and a place."""
    wanted: dict[int, list[int]] = {}
    for uid, place in zip(phrases["uid"].to_pylist(), phrases["place"].to_pylist()):
        wanted.setdefault(uid, []).append(place)
    found = set()
    for uid, packed in zip(docs["uid"].to_pylist(), docs["packed"]):
        if places := wanted.pop(uid, None):
            words = _words(packed)
            found.update(tuple(words[place : place + anchor]) for place in places)
    return PhraseAutomaton(found, anchor)


def _words(packed) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed.as_py()).split()


def candidate_windows(places: np.ndarray, n_words: int, window: int, anchor: int) -> np.ndarray:
    """Starts of the windows that hold one of the phrases found."""
    last = n_words - window
    if last < 0 or not len(places):
        return np.empty(0, np.int64)
    change = np.zeros(last + 2, np.int64)
    low, high = np.maximum(places - (window - anchor), 0), np.minimum(places, last) + 1
    some = low < high
    np.add.at(change, low[some], 1)
    np.add.at(change, high[some], -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def _keys_at(words: list[bytes], starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    hashes = word_hashes(words)
    return run_hashes(hashes, window, 0)[starts], run_hashes(hashes, window, 1)[starts]


def _windows(window: int, anchor: int):
    def windows(docs: pa.Table, phrases: pa.Table) -> pa.Table:
        parts = []
        if phrases.num_rows:
            automaton = _compiled(docs, phrases, anchor)
            for packed in docs["packed"]:
                words = _words(packed)
                starts = candidate_windows(automaton.places(words), len(words), window, anchor)
                if len(starts):
                    parts.append(_keys_at(words, starts, window))
        first, second = map(np.concatenate, zip(*parts)) if parts else (np.empty(0, np.uint64),) * 2
        starts, order = _grouped([first, second])
        chosen = order[starts]
        return pa.table(
            {
                "one": pa.array(first[chosen].view(np.int64)),
                "two": pa.array(second[chosen].view(np.int64)),
                "shard": pa.array(np.full(len(chosen), docs["shard"][0].as_py() if docs.num_rows else 0), pa.int32()),
                "n": pa.array(np.diff(np.append(starts, len(order))), pa.int64()),
            }
        )

    return windows


def _removed(window: int, anchor: int):
    def removed(docs: pa.Table, known: pa.Table) -> pa.Table:
        lone = known.filter(pa.compute.equal(known["kind"], 1))
        phrases = known.filter(pa.compute.equal(known["kind"], 0))
        first, second = (lone[name].to_numpy().view(np.uint64) for name in ("uid", "place"))
        order = np.argsort(first, kind="stable")
        first, second = first[order], second[order]
        automaton = _compiled(docs, phrases, anchor) if phrases.num_rows else None
        counts, gone, digests = [], [], []
        for packed in docs["packed"]:
            words = _words(packed)
            places = automaton.places(words) if automaton else np.empty(0, np.int64)
            starts = candidate_windows(places, len(words), window, anchor)
            if len(starts) and len(first):
                one, two = _keys_at(words, starts, window)
                at = np.minimum(np.searchsorted(first, one), len(first) - 1)
                starts = starts[(first[at] != one) | (second[at] != two)]
            if len(starts):
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + window, -1)
                keep = np.cumsum(change[:-1]) == 0
                kept = [word for word, stays in zip(words, keep.tolist()) if stays]
            else:
                kept = words
            counts.append(len(words))
            gone.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    return removed


def _packed(batches):
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = pa.array([packer.compress(text.as_py()) for text in batch.column(3)], pa.binary())
        yield pa.record_batch([*batch.columns[:3], packed], names=["doc_id", "shard", "uid", "packed"])


def dealt_into_shards(docs: DataFrame) -> DataFrame:
    """``doc_id, shard, uid, packed`` of every row, written: compressed texts in shards of like size.

    A row's shard comes from its place in the input, so rows repeated whole spread like any
    others. It is written once; no later task deals anew.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select(column("doc_id").alias("doc_id"), whole(column("text")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    shards = max(2 * partitions(spark), size // SHARD_BYTES + 1)
    dealt = texts.select(
        "doc_id",
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64("doc_id", "text").alias("uid"),
        F.col("text").cast("binary").alias("text"),
    )
    return written(in_arrow(dealt, _packed, f"doc_id {kind}, shard int, uid bigint, packed binary"), "packed")


def remove_repeats(docs: DataFrame, window: int = 35, anchor: int = 8) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row.

    A word goes if a window of ``window`` words that covers it also stands anywhere else,
    in the same document too. Rows repeated whole count each. A null text has no words.
    """
    reach_workers(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    packed = dealt_into_shards(docs)

    anchors = in_arrow(
        packed.select("shard", "uid", "packed"),
        _anchors(window, anchor),
        "anchor bigint, shard int, uid bigint, place bigint, n bigint",
    )
    anchors = anchors.groupBy("anchor", "shard").agg(
        F.sum("n").alias("n"), F.min(F.struct("uid", "place")).alias("at")
    )
    everywhere = Window.partitionBy("anchor")
    recurring = anchors.withColumn("n", F.sum("n").over(everywhere)).where("n > 1")
    phrases = written(recurring.select("shard", "at.uid", "at.place"), "phrases")

    windows = packed.groupBy("shard").cogroup(phrases.groupBy("shard")).applyInArrow(
        _windows(window, anchor), "one bigint, two bigint, shard int, n bigint"
    )
    lone = windows.groupBy("one", "two").agg(F.sum("n").alias("n"), F.min("shard").alias("shard")).where("n = 1")
    lone = written(lone.select("shard", F.col("one").alias("uid"), F.col("two").alias("place")), "lone")

    known = phrases.withColumn("kind", F.lit(0)).unionByName(lone.withColumn("kind", F.lit(1)))
    return packed.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(
        _removed(window, anchor), f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    )
