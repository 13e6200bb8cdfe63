"""The best documents for each item of a query set, found by presence masks.

Two passes over the documents, neither of which shuffles them. The first counts documents,
words and the documents that hold each term of the items. The second takes the documents in
chunks of bounded size. Within a chunk every term has a bitmap of the documents that hold
it; the bitmaps of an item's terms, laid side by side, give each document the mask of the
terms it matches, and documents are grouped by mask. What a mask's documents can score at
most is the sum of the best its terms do in the chunk. Masks are evaluated from the highest
such sum down, and the rest is left once it is below the task's last kept score. A task keeps
``best`` documents an item over all its chunks, so little is sent to the final ranking.

Terms are the maximal runs of ASCII letters, digits and characters outside ASCII; only A-Z is
lower-cased. With ``N`` documents that have a term, ``L`` terms in all, ``n`` in the document,
``df`` documents holding a term and ``tf`` places of it in the document:
``w = floor(1000 ln((2N + 2) / (2df + 1)))``, ``m = 25 + 75 n N div L``, and the score sums
``w * (10^9 tf div (1000 tf + 8 m))`` over the item's terms, repeats included.

Null and empty texts have no terms: such a document is never ranked, such an item has no rows.
Equal scores go by ascending id, a null id after others; rows repeated whole are ranked each
by itself, among themselves in any order, and an item repeated whole has its rows each time.
Other columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.llm.common import column, in_arrow, whole, written

_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_PLAIN = bytes(byte if byte in _KEPT else 32 for byte in bytes(range(256)).lower())

#: Bounds of a chunk: documents, and places of items' terms in them.
CHUNK_DOCS, CHUNK_PLACES = 8192, 1 << 20
#: Bits of an item's masks that are laid out at once.
MASK_BITS = 1 << 25
#: Text of the items that go to every task together; more items are another pass.
BLOCK_BYTES = 4 << 20
#: Rows of one item are first ranked in this many parts.
PARTS = 64


def terms(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Query:
    """An item's different terms, by number, and what one unit of impact of each is worth."""

    def __init__(self, numbers: list[int], worth: list[int]):
        self.numbers, self.worth = numbers, np.array(worth, np.int64)


class Chunk:
    """Documents, and where the items' terms stand in them."""

    def __init__(self):
        self.ids: list = []
        self.length_norms = array("q")
        self.places: dict[int, tuple[array, array]] = {}
        self.size = 0

    def add(self, doc_id, counts: Counter, numbers: dict[bytes, int], norm: int) -> None:
        at = len(self.ids)
        self.ids.append(doc_id)
        self.length_norms.append(norm)
        for term, times in counts.items():
            number = numbers.get(term)
            if number is not None:
                docs, often = self.places.setdefault(number, (array("i"), array("q")))
                docs.append(at)
                often.append(times)
                self.size += 1

    def full(self) -> bool:
        return len(self.ids) >= CHUNK_DOCS or self.size >= CHUNK_PLACES

    def index(self) -> None:
        """For each term: its documents, their impacts, and the documents as a bitmap."""
        norms = np.array(self.length_norms, np.int64)
        self.docs, self.impact, self.bitmap = {}, {}, {}
        for number, (docs, often) in self.places.items():
            docs, often = np.array(docs, np.int64), np.array(often, np.int64)
            held = np.zeros(len(self.ids), bool)
            held[docs] = True
            self.docs[number], self.bitmap[number] = docs, np.packbits(held)
            self.impact[number] = 1_000_000_000 * often // (1000 * often + 8 * norms[docs])


def same_masks(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For columns of bits: the first column of each different one, and every column's group."""
    packed = np.packbits(bits, axis=0)
    groups = np.zeros(bits.shape[1], np.int64)
    for start in range(0, len(packed), 8):
        word = np.zeros((bits.shape[1], 8), np.uint8)
        part = packed[start : start + 8]
        word[:, : len(part)] = part.T
        _, values = np.unique(word.view(np.uint64).ravel(), return_inverse=True)
        # Groups so far, split by the next 64 terms; both numbers are below the columns' count.
        _, groups = np.unique(groups * bits.shape[1] + values, return_inverse=True)
    _, firsts = np.unique(groups, return_index=True)
    return firsts, groups


class Best:
    """The highest scores so far; equal ones by id, null last."""

    def __init__(self, size: int):
        self.size, self.rows = size, []

    def floor(self) -> int:
        """A score below this is not kept any more."""
        return -self.rows[-1][0] if len(self.rows) == self.size else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        some = scores >= self.floor()
        rows = [(-int(s), i is None, 0 if i is None else i) for s, i, keep in zip(scores, ids, some) if keep]
        self.rows = sorted(self.rows + rows)[: self.size]


def rank_chunk(chunk: Chunk, query: Query, best: Best) -> int:
    """Add the chunk's documents to ``best``; returns how many were evaluated."""
    there = [i for i, number in enumerate(query.numbers) if number in chunk.docs]
    if not there:
        return 0
    numbers, worth = [query.numbers[i] for i in there], query.worth[there]
    most = np.array([chunk.impact[number].max() for number in numbers], np.int64) * worth
    if most.sum() < best.floor():
        return 0
    evaluated, step = 0, max(64, MASK_BITS // len(there) // 64 * 64)
    for start in range(0, len(chunk.ids), step):
        width = min(step, len(chunk.ids) - start)
        bytes_of = slice(start // 8, (start + width + 7) // 8)
        bits = np.unpackbits(np.stack([chunk.bitmap[n][bytes_of] for n in numbers]), axis=1, count=width)
        matched = np.flatnonzero(bits.any(0))
        if not len(matched):
            continue
        bits = bits[:, matched]
        firsts, groups = same_masks(bits)
        bounds = np.zeros(len(firsts), np.int64)
        for row, gain in zip(bits[:, firsts], most):
            bounds += row * gain
        order = np.argsort(-bounds, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # Columns in the order of their masks' bounds; whole masks are taken at a time.
        columns = np.argsort(place[groups], kind="stable")
        ends = np.cumsum(np.bincount(place[groups], minlength=len(order)))
        mask, done, amount = 0, 0, 32
        while mask < len(order) and bounds[order[mask]] >= best.floor():
            last = min(int(np.searchsorted(ends, done + amount)), len(order) - 1)
            chosen = columns[done : ends[last]]
            scores = np.zeros(len(chosen), np.int64)
            docs = start + matched[chosen]
            for number, gain, row in zip(numbers, worth, bits):
                held = np.flatnonzero(row[chosen])
                if len(held):
                    scores[held] += gain * chunk.impact[number][np.searchsorted(chunk.docs[number], docs[held])]
            best.add(scores, [chunk.ids[doc] for doc in docs])
            evaluated += len(chosen)
            mask, done, amount = last + 1, int(ends[last]), 2 * amount
    return evaluated


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """Items in blocks of bounded text; the driver holds one block and one partition at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        size += len(row["text"])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _counted(docs: DataFrame, vocabulary: frozenset) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, their terms in all, and the documents that hold each item term."""

    def count(batches):
        with_terms, words, holding = 0, 0, Counter()
        for batch in batches:
            for text in batch.column(1):
                found = terms(text.as_py())
                with_terms += bool(found)
                words += len(found)
                holding.update(vocabulary.intersection(found))
        names = [None, *holding]
        yield pa.record_batch(
            [
                pa.array(names, pa.binary()),
                pa.array([with_terms, *holding.values()], pa.int64()),
                pa.array([words] + [0] * len(holding), pa.int64()),
            ],
            names=["term", "docs", "words"],
        )

    counted = in_arrow(docs, count, "term binary, docs bigint, words bigint")
    # No more rows than the block has terms.
    rows = counted.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).collect()
    totals = [(row["docs"], row["words"]) for row in rows if row["term"] is None]
    held = {bytes(row["term"]): row["docs"] for row in rows if row["term"] is not None}
    return (*totals[0], held) if totals else (0, 0, held)


def _queries(block: list, with_terms: int, held: dict[bytes, int]) -> tuple[dict[bytes, int], list[Query]]:
    numbers: dict[bytes, int] = {}
    queries = []
    for row in block:
        counts = Counter(term for term in terms(bytes(row["text"])) if term in held)
        worth = [
            times * math.floor(1000 * math.log((2 * with_terms + 2) / (2 * held[term] + 1)))
            for term, times in counts.items()
        ]
        queries.append(Query([numbers.setdefault(term, len(numbers)) for term in counts], worth))
    return numbers, queries


def _ranked_in_tasks(
    docs: DataFrame, with_terms: int, words: int, numbers: dict[bytes, int], queries: list[Query], best: int
) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()

    def rank(batches):
        kept = [Best(best) for _ in queries]

        def finish(chunk):
            chunk.index()
            for query, found in zip(queries, kept):
                rank_chunk(chunk, query, found)

        chunk, id_type = Chunk(), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_py())
                if not found:
                    continue
                chunk.add(doc_id, Counter(found), numbers, 25 + 75 * len(found) * with_terms // words)
                if chunk.full():
                    finish(chunk)
                    chunk = Chunk()
        if chunk.ids:
            finish(chunk)
        rows = [(i, None if null else doc, -score) for i, f in enumerate(kept) for score, null, doc in f.rows]
        if rows:
            number, doc, score = zip(*rows)
            yield pa.record_batch(
                [pa.array(number, pa.int64()), pa.array(doc, id_type), pa.array(score, pa.int64())],
                names=["number", "doc_id", "score"],
            )

    return in_arrow(docs, rank, f"number bigint, doc_id {kind}, score bigint")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    best: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``best`` highest documents, rank from 1.

    Each block of items is two passes over the documents; its result is written.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(column(doc_id).alias("id"), whole(column("text")).cast("binary").alias("text"))
    items = items.select(column(item_id).alias("item_id"), whole(column("text")).cast("binary").alias("text"))
    item_type = items.schema["item_id"].dataType
    result = None
    for block in _blocks(items, block_bytes):
        vocabulary = frozenset(term for row in block for term in terms(bytes(row["text"])))
        with_terms, words, held = _counted(docs, vocabulary)
        numbers, queries = _queries(block, with_terms, held)
        found = _ranked_in_tasks(docs, with_terms, words, numbers, queries, best)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        # An item has up to ``best`` rows from every task: rank them in parts, then the parts.
        found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
        for keys in (["number", "part"], ["number"]):
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            found = found.withColumn("rank", place).where(F.col("rank") <= best)
        names = spark.createDataFrame(
            [(i, row["item_id"]) for i, row in enumerate(block)],
            T.StructType([T.StructField("n", T.LongType()), T.StructField("item_id", item_type)]),
        )
        ranked = found.join(F.broadcast(names), F.col("number") == F.col("n"))
        ranked = written(ranked.select("item_id", "rank", "doc_id", "score"), "ranking")
        result = ranked if result is None else result.unionAll(ranked)
    if result is None:
        schema = T.StructType(
            [
                T.StructField("item_id", item_type),
                T.StructField("rank", T.IntegerType()),
                T.StructField("doc_id", docs.schema["id"].dataType),
                T.StructField("score", T.LongType()),
            ]
        )
        result = spark.createDataFrame([], schema)
    return result
