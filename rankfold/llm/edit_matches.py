"""Benchmark items in documents, with edits, by pieces and bit-parallel distance.

Texts and items are compared as words: lower case, letters and digits only. An item may
differ in one word of ``share``; that is its budget. Cut into one piece more than the budget,
at least one piece must stand in the text unchanged. So the pieces are looked up, and around
each hit the edit distance to the whole item is taken with Myers' bit vectors, one bit for
each word of the item.

Items are written once and read by the tasks in blocks of bounded size, whatever their number:
neither the driver nor a task holds all of them. One scan takes the documents through all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import column, in_arrow, whole, written
from rankfold.llm.licence_spans import words_of

#: Bytes of item texts in a block.
BLOCK_BYTES = 4 << 20

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def normal_words(text: bytes) -> list[bytes]:
    return words_of(text.decode().lower().encode())


def distances(pattern: list[int], text: list[int]) -> list[int]:
    """For each word of the text, the distance of the pattern to the best run that ends there."""
    m = len(pattern)
    where: dict[int, int] = {}
    for i, word in enumerate(pattern):
        where[word] = where.get(word, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, found = full, 0, m, []
    for word in text:
        equal = where.get(word, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (full & ~(horizontal | up)), up & horizontal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = rise << 1, fall << 1
        up = (fall | ~(vertical | rise)) & full
        down = rise & vertical & full
        found.append(score)
    return found


def pieces_of(n_words: int, budget: int) -> list[tuple[int, int]]:
    """Start and end of ``budget + 1`` pieces of nearly equal size."""
    edges = [n_words * i // (budget + 1) for i in range(budget + 2)]
    return list(zip(edges, edges[1:]))


def _run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    runs = np.zeros(len(ids) - size + 1, np.uint64)
    for i in range(size):
        runs = runs * _BASE + ids[i : i + len(runs)]
    runs = (runs ^ runs >> np.uint64(33)) * _MIX
    return runs ^ runs >> np.uint64(29)


class ItemFinder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, bytes]], share: int):
        self.numbers: dict[bytes, int] = {}
        self.items = []
        places: dict[int, dict[int, list]] = {}
        for item, text in items:
            words = normal_words(text)
            if not words:
                continue
            ids = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in words]
            budget = len(ids) // share
            for start, end in pieces_of(len(ids), budget):
                run = np.array(ids[start:end], np.uint64)
                hashed = int(_run_hashes(run, end - start)[0])
                places.setdefault(end - start, {}).setdefault(hashed, []).append((len(self.items), start))
            self.items.append((item, ids, budget))
        self.places = [(size, np.array(sorted(known), np.uint64), known) for size, known in sorted(places.items())]

    def find(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """``(item, distance, first word, end word)`` of the best place of each item found."""
        words = normal_words(text)
        get = self.numbers.get
        ids = np.fromiter((get(word, 0) for word in words), np.uint64, len(words))
        known_words = np.concatenate(([0], np.cumsum(ids > 0)))
        starts: dict[int, list[int]] = {}
        for size, hashes, places in self.places:
            if len(ids) < size:
                continue
            # Only runs all of whose words some item has.
            runs = np.flatnonzero(known_words[size:] - known_words[:-size] == size)
            if not len(runs):
                continue
            hashed = np.zeros(len(runs), np.uint64)
            for i in range(size):
                hashed = hashed * _BASE + ids[runs + i]
            hashed = (hashed ^ hashed >> np.uint64(33)) * _MIX
            hashed ^= hashed >> np.uint64(29)
            at = np.minimum(np.searchsorted(hashes, hashed), len(hashes) - 1)
            for k in np.flatnonzero(hashes[at] == hashed):
                for number, offset in places[int(hashed[k])]:
                    starts.setdefault(number, []).append(int(runs[k]) - offset)
        found = []
        for number, begins in starts.items():
            item, pattern, budget = self.items[number]
            best = None
            for low, high in self._stretches(sorted(begins), len(pattern), budget, len(ids)):
                stretch = ids[low:high].tolist()
                scores = distances(pattern, stretch)
                least = min(scores, default=budget + 1)
                if least <= budget and (best is None or least < best[1]):
                    end = scores.index(least) + 1
                    back = distances(pattern[::-1], stretch[max(0, end - len(pattern) - budget) : end][::-1])
                    best = (item, least, low + end - back.index(min(back)) - 1, low + end)
            if best is not None:
                found.append(best)
        return found

    @staticmethod
    def _stretches(begins: list[int], size: int, budget: int, n_words: int):
        """Where an item may stand around its hits, joined where that overlaps."""
        low = high = None
        for begin in begins:
            a, b = max(0, begin - budget), min(n_words, begin + size + budget)
            if high is None or a > high:
                if high is not None:
                    yield low, high
                low, high = a, b
            high = max(high, b)
        if high is not None:
            yield low, high


def find_items(docs: DataFrame, benchmark: DataFrame, share: int = 5, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each document and item found in it: keys, ``item_id, distance, first_word, end_word``.

    ``share``: an item may differ in one of so many words. Null texts and items without
    words match nothing; of several places the nearest, then first, is told; items repeated
    whole are told once each.
    """
    items = benchmark.select(
        column("item_id").cast("long").alias("item_id"), whole(column("text")).cast("binary").alias("text")
    )
    files = written(items, "items").inputFiles()
    frame = docs.select(*[column(key).alias(key) for key in keys], whole(column("text")).cast("binary").alias("text"))
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in frame.drop("text").dtypes)
    schema = f"{kinds}, item_id bigint, distance bigint, first_word bigint, end_word bigint"
    return in_arrow(frame, _finding(files, share, len(keys), BLOCK_BYTES), schema)


def blocks_of(files: list[str], block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """The written items, in blocks of ``block_bytes`` of text or one longer item."""
    block, size = [], 0
    for address in files:
        system, path = pyarrow.fs.FileSystem.from_uri(address)
        with system.open_input_file(path) as stream:
            for batch in pyarrow.parquet.ParquetFile(stream).iter_batches(64, columns=["item_id", "text"]):
                for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if block and size + len(text) > block_bytes:
                        yield block
                        block, size = [], 0
                    block.append((item, text))
                    size += len(text)
    if block:
        yield block


def _finding(files: list[str], share: int, width: int, block_bytes: int):
    def finders() -> Iterator[ItemFinder]:
        for block in blocks_of(files, block_bytes):
            yield ItemFinder(block, share)

    def finding(batches):
        # A benchmark of one block is read once in a task, a larger one for each batch.
        first = list(islice(finders(), 2))
        held = first if len(first) < 2 else None
        del first
        for batch in batches:
            for finder in held if held is not None else finders():
                at, hits = [], []
                for i, text in enumerate(batch.column(width)):
                    for hit in finder.find(text.as_py()):
                        at.append(i)
                        hits.append(hit)
                if at:
                    chosen = batch.select(list(range(width))).take(pa.array(at))
                    columns = [pa.array(c, pa.int64()) for c in zip(*hits)]
                    names = [*chosen.schema.names, "item_id", "distance", "first_word", "end_word"]
                    yield pa.record_batch([*chosen.columns, *columns], names=names)

    return finding
