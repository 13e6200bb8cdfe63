"""Removing bytes that repeat an earlier string of ``window`` bytes, by suffix order.

Equal strings of ``window`` bytes must meet in one task. Every window has an anchor: of its
runs of ``ANCHOR`` bytes the leftmost with the smallest hash. Equal windows have equal anchors
at equal places, so a window's equals lie among the windows of the same anchor. Anchors are
counted over all documents, once for each shard of texts; where one recurs, the stretch of
text that its windows cover, the passage, is collected by anchor. Passages of one anchor are
lined up by it, and a task takes a collection of several anchors' passages.

A collection's passages are short documents, and their suffix order is built column
by column, from the last to the first: a round inserts one symbol of each document. The
symbols in the order of the round before are that column of the collection's Burrows-Wheeler
transform; counting them gives each suffix its new place (a stable sort by the symbol), and
the common prefix of neighbours with the same symbol is one more than the least common prefix
between their old places. Only suffixes that start in the same column are ever compared, so the
transform is kept by columns, and a round costs as much as there are documents, not as there
are suffixes so far. A round reads order and common prefixes from the file of the round before
and writes its own, both from start to end; the files lie in the shared folder and go with
the collection. Neighbours that share ``window`` symbols or more make a class of equal windows: all
but the one that stands first are removed.

Of a passage that stands in many places only the first and the last enter, and the verdict on
the last holds for all that follow the first. Where an anchor still has more than ``CROWDED``
different passages, its windows are dealt by a longer core: those that reach far to the left by
more bytes to the left, the others by more to the right. A core that has grown to a window
has one passage, so this ends.

A document's bytes are those of its text in UTF-8, null as empty; matches do not cross
documents. Rows go by id, a null id first, rows with one id by their place in the table as it
is read. Texts shorter than a window lose nothing. Other columns are not read.
"""

from __future__ import annotations

import uuid
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import column, in_arrow, inner_tables, partitions, reach_workers, spread_join, whole, written
from rankfold.llm.warc_archives import qualified
from rankfold.sources.store import new_folder

#: Bytes of an anchor.
ANCHOR = 32
#: Texts that a task holds at once, in bytes.
SHARD_BYTES = 4 << 20
#: Documents of a collection, about, and the most that one anchor may give to it.
COLLECTION, CROWDED = 1 << 15, 1 << 16

#: A place: the partition that read a row, above these bits the shard in it, then the row.
_PART_BITS, _ROW_BITS = 23, 17
#: What a row counts besides its text, so that a shard's rows fit their bits.
_ROW_BYTES = 64
_SLICE = 1 << 19
_PLACE_BITS = 20
#: Fixed: an odd base and its inverse modulo 2**64, and odd factors that mix the bits.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: The symbol of a document that has none in a column; it equals no other.
_NONE = 256


@cache
def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def run_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` bytes."""
    count = -(-len(data) >> 12) << 12
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * _powers(_BASE, count)[: len(data)], dtype=np.uint64, out=sums[1:])
    hashes = (sums[size:] - sums[:-size]) * _powers(_INVERSE, count)[: len(data) - size + 1]
    for shift, factor in zip((31, 29), _MIX):
        hashes ^= hashes >> np.uint64(shift)
        hashes *= np.uint64(factor)
    return hashes ^ hashes >> np.uint64(32)


def anchors(text: bytes, window: int, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """``hash, at, first, last``: each anchor and the starts of the windows whose anchor it is.

    An anchor's windows follow each other. Long texts are taken in slices of windows; an anchor
    may then come twice, with different windows.
    """
    found = []
    for start in range(0, len(text) - window + 1, _SLICE):
        data = np.frombuffer(text, np.uint8, min(_SLICE + window - 1, len(text) - start), start)
        hashes = run_hashes(data, size)
        ranked = hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)
        ranked |= np.arange(len(hashes), dtype=np.uint64)
        span, width, least = window - size + 1, 1, ranked
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        windows = len(data) - window + 1
        least = np.minimum(least[:windows], least[span - width : span - width + windows])
        chosen = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        firsts = np.flatnonzero(np.diff(chosen, prepend=-1))
        lasts = np.append(firsts[1:] - 1, windows - 1)
        at = chosen[firsts]
        found.append((hashes[at].view(np.int64), at + start, firsts + start, lasts + start))
    if not found:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(part) for part in zip(*found))


class RoundFile:
    """Order and common prefixes of one round at a time, on the storage all executors share."""

    def __init__(self, folder: str):
        self.system, base = pyarrow.fs.FileSystem.from_uri(folder)
        self.base = f"{base}/{uuid.uuid4().hex}"
        self.system.create_dir(self.base, recursive=True)
        self.number = 0

    def write(self, order: np.ndarray, common: np.ndarray) -> None:
        with self.system.open_output_stream(f"{self.base}/{self.number + 1}", compression=None) as stream:
            stream.write(pa.py_buffer(order))
            stream.write(pa.py_buffer(common))
        if self.number:
            self.system.delete_file(f"{self.base}/{self.number}")
        self.number += 1

    def read(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        with self.system.open_input_stream(f"{self.base}/{self.number}", compression=None) as stream:
            order = np.frombuffer(stream.read(4 * count), np.int32)
            return order, np.frombuffer(stream.read(2 * count), np.uint16)

    def remove(self) -> None:
        self.system.delete_dir(self.base)


def least_between(values: np.ndarray, before: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """The least of ``values[before + 1 : upto + 1]`` for each pair."""
    result = np.empty(len(before), values.dtype)
    lengths = upto - before
    level, reach = values, 1
    while len(lengths):
        here = (lengths >= reach) & (lengths < 2 * reach)
        result[here] = np.minimum(level[before[here] + 1], level[upto[here] - reach + 1])
        if not (lengths >= 2 * reach).any():
            break
        level = np.minimum(level[:-reach], level[reach:])
        reach *= 2
    return result


def insert_column(symbols: np.ndarray, order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round: the order of the suffixes one symbol longer, and their common prefixes.

    ``symbols`` holds each document's symbol, ``common`` for each place of ``order`` what its
    suffix shares with that of the place before.
    """
    transform = symbols[order]
    moved = np.argsort(transform, kind="stable")
    sorted_symbols = transform[moved]
    longer = np.zeros(len(order), np.uint16)
    same = np.flatnonzero((sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] != _NONE)) + 1
    longer[same] = least_between(common, moved[same - 1], moved[same]) + 1
    return order[moved], longer


def repeated_windows(
    texts: list[bytes], cores: np.ndarray, rank: np.ndarray, window: int, files: RoundFile
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``document, start, end`` of the bytes in windows that a document of lower rank has too.

    ``cores`` is where the core that the documents are lined up by starts in each.
    """
    count = len(texts)
    lengths = np.array([len(text) for text in texts], np.int64)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum(lengths) - lengths
    left = int(cores.max())
    repeated = np.zeros((left + 2, count), bool)
    # Before the first round all suffixes are empty.
    files.write(np.arange(count, dtype=np.int32), np.zeros(count, np.uint16))
    for place in range(left + int((lengths - cores).max()) - 1, -1, -1):
        at = cores + (place - left)
        there = (at >= 0) & (at < lengths)
        symbols = np.full(count, _NONE, np.uint16)
        symbols[there] = flat[offsets[there] + at[there]]
        order, common = insert_column(symbols, *files.read(count))
        files.write(order, common)
        if place <= left:
            bounds = np.flatnonzero(common < window)
            ranked = rank[order]
            least = np.repeat(np.minimum.reduceat(ranked, bounds), np.diff(bounds, append=count))
            repeated[place, order] = ranked > least
    change = np.diff(repeated.astype(np.int8), axis=0, prepend=0)
    # By document, so that starts and ends come in pairs.
    document, first = np.nonzero(change.T == 1)
    _, after = np.nonzero(change.T == -1)
    shift = left - cores[document]
    return document, first - shift, after - 1 - shift + window


class Texts:
    """A shard's rows in a file of their own, compressed together."""

    @staticmethod
    def write(folder: str, ids: pa.Array, texts: list[bytes]) -> str:
        system, base = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.arrow"
        table = pa.table({"id": ids, "text": pa.array(texts, pa.large_binary())})
        packing = pa.ipc.IpcWriteOptions(compression="zstd")
        with system.open_output_stream(f"{base}/{name}", compression=None) as stream:
            with pa.ipc.new_stream(stream, table.schema, options=packing) as writer:
                writer.write_table(table)
        return f"{folder}/{name}"

    @staticmethod
    def read(address: str) -> tuple[pa.ChunkedArray, list[bytes]]:
        system, path = pyarrow.fs.FileSystem.from_uri(address)
        with system.open_input_stream(path, compression=None) as stream:
            table = pa.ipc.open_stream(stream).read_all()
        return table["id"], table["text"].to_pylist()


def _shards(docs: DataFrame) -> DataFrame:
    """``shard, file``: the rows in files of bounded size, in the order of their ids.

    A row's place is its shard and its row in it, in one number; places have the rows' order.
    The table of shards names the files of tasks that ended well.
    """
    order = [F.col("id").asc_nulls_first(), F.col("row")]
    docs = docs.withColumn("row", F.monotonically_increasing_id()).orderBy(*order).drop("row")
    folder = qualified(docs.sparkSession, new_folder(docs.sparkSession, "texts"))

    def dealt(batches):
        part = TaskContext.get().partitionId()
        shards, files = [], []

        def finish(ids, texts):
            shards.append(part << _PART_BITS | len(shards))
            files.append(Texts.write(folder, pa.concat_arrays(ids), texts))

        ids, texts, held = [], [], 0
        for batch in batches:
            for row, text in enumerate(batch.column(1)):
                text = text.as_py()
                if held and held + len(text) > SHARD_BYTES:
                    finish(ids, texts)
                    ids, texts, held = [], [], 0
                held += len(text) + _ROW_BYTES
                texts.append(text)
                ids.append(batch.column(0).slice(row, 1))
        if texts:
            finish(ids, texts)
        yield pa.record_batch([pa.array(shards, pa.int64()), pa.array(files, pa.string())], names=["shard", "file"])

    return written(in_arrow(docs, dealt, "shard bigint, file string"), "shards")


def _anchor_counts(shards: DataFrame, window: int) -> DataFrame:
    """``key, shard, n``: how often each anchor stands in a shard."""

    def counted(batches):
        for batch in batches:
            for shard, file in zip(*(part.to_pylist() for part in batch.columns)):
                found = [anchors(text, window)[0] for text in Texts.read(file)[1]]
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                here = np.full(len(keys), shard, np.int64)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in (keys, here, n)], names=["key", "shard", "n"])

    spread = shards.repartition(partitions(shards.sparkSession), "shard")
    return in_arrow(spread, counted, "key bigint, shard bigint, n bigint")


def _by_shard(shards: DataFrame, rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on each shard's file and the rows that concern it."""
    reach_workers(shards.sparkSession)
    return shards.groupBy("shard").cogroup(rows.groupBy("shard")).applyInArrow(work, schema)


#: What names a passage: its core's hash, a hash of its text, where the core starts, its length.
NAME = ["key", "sub", "core", "length"]
_NAME_TYPES = "key bigint, sub bigint, core bigint, length bigint"


def _occurrences(shards: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """Every passage of a recurring anchor: its name, ``place``, and ``at``, where the anchor stands."""

    def collect(shard: pa.Table, keys: pa.Table) -> pa.Table:
        wanted, parts = np.sort(keys["key"].to_numpy()), []
        texts = Texts.read(shard["file"][0].as_py())[1]
        first_place = shard["shard"][0].as_py() << _ROW_BITS
        for row, text in enumerate(texts if len(wanted) else ()):
            hashes, at, firsts, lasts = anchors(text, window)
            near = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
            kept = wanted[near] == hashes
            at, firsts, afters = at[kept], firsts[kept], lasts[kept] + window
            subs = [xxhash.xxh64_intdigest(text[a:b]) for a, b in zip(firsts.tolist(), afters.tolist())]
            subs = np.array(subs, np.uint64).view(np.int64)
            place = np.full(len(at), first_place + row, np.int64)
            parts.append((hashes[kept], subs, at - firsts, afters - firsts, place, at))
        columns = [np.concatenate(part) for part in zip(*parts)] if parts else [np.empty(0, np.int64)] * 6
        return pa.table(columns, names=[*NAME, "place", "at"])

    return _by_shard(shards, found, collect, f"{_NAME_TYPES}, place bigint, at bigint")


def _strings(passages: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Each passage once: its first and last place, and how often it stands, ``n``."""
    order = F.struct("place", "at")
    grouped = passages.groupBy(*NAME).agg(
        F.min(order).alias("first"),
        F.max(order).alias("last"),
        F.count(F.lit(1)).alias("n"),
        *[F.any_value(name).alias(name) for name in extra],
    )
    ends = [f"{end}.{name} AS {end}_{name}" for end in ("first", "last") for name in ("place", "at")]
    return written(grouped.selectExpr(*NAME, "n", *ends, *extra), "strings")


def _spelled(shards: DataFrame, strings: DataFrame) -> DataFrame:
    """The passages ``strings`` with their ``text``, and ``size``, the bytes of their core."""
    names = [*NAME, "n", "first_place", "first_at", "last_place", "last_at"]

    def spell(shard: pa.Table, block: pa.Table) -> pa.Table:
        texts = Texts.read(shard["file"][0].as_py())[1] if len(block) else []
        rows = block["first_place"].to_numpy() & (1 << _ROW_BITS) - 1
        starts = block["first_at"].to_numpy() - block["core"].to_numpy()
        stops = starts + block["length"].to_numpy()
        found = [texts[row][a:b] for row, a, b in zip(rows.tolist(), starts.tolist(), stops.tolist())]
        columns = {name: block[name] for name in names}
        return pa.table({**columns, "text": pa.array(found, pa.binary()), "size": np.full(len(found), ANCHOR, np.int64)})

    schema = (
        f"{_NAME_TYPES}, n bigint, first_place bigint, first_at bigint, last_place bigint, last_at bigint, "
        "text binary, size bigint"
    )
    return _by_shard(shards, strings.withColumn("shard", F.shiftright("first_place", _ROW_BITS)), spell, schema)


def _in_collections(strings: DataFrame, count: int, window: int) -> DataFrame:
    """Names, ``which, start, end`` of the bytes to go from each passage of a collection."""
    spark = strings.sparkSession
    if not count:
        return spark.createDataFrame([], f"{_NAME_TYPES}, which int, start bigint, end bigint")
    folder = qualified(spark, new_folder(spark, "rounds"))
    shards = max(partitions(spark), -(-count // COLLECTION))

    def work(block: pa.Table) -> pa.Table:
        # The first place of each passage, and the last of those that have several.
        again = block.filter(pc.greater(block["n"], 1))
        places = pa.concat_tables(
            [
                pa.table({name: part[f"{which}_{name}"] for name in ("place", "at")})
                for part, which in ((block, "first"), (again, "last"))
            ]
        )
        rank = np.empty(len(places), np.int64)
        rank[np.lexsort((places["at"].to_numpy(), places["place"].to_numpy()))] = np.arange(len(places))
        texts = block["text"].to_pylist() + again["text"].to_pylist()
        cores = np.concatenate([block["core"].to_numpy(), again["core"].to_numpy()])
        files = RoundFile(folder)
        try:
            document, start, end = repeated_windows(texts, cores, rank, window, files)
        finally:
            files.remove()
        names = {name: np.concatenate([block[name].to_numpy(), again[name].to_numpy()])[document] for name in NAME}
        which = (document >= len(block)).astype(np.int32)
        return pa.table({**names, "which": which, "start": start, "end": end})

    reach_workers(spark)
    dealt = strings.withColumn("collection", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("collection")
    return dealt.applyInArrow(work, f"{_NAME_TYPES}, which int, start bigint, end bigint")


def _longer_cores(crowded: DataFrame, window: int) -> DataFrame:
    """The passages of crowded cores, each place of them by itself, with cores longer on one side.

    Windows that start ``more`` bytes or more before the core hold that many bytes to its left;
    the others end so late that they hold about as many to its right.
    """
    core, length = F.col("core"), F.length("text").cast("long")
    more = F.ceil((F.lit(window) - F.col("size") + 1) / 2)
    cut = core - more
    left = F.struct(
        F.lit("left").alias("side"),
        F.lit(0).cast("long").alias("start"),
        F.least(cut + window, length).alias("stop"),
        cut.alias("low"),
        (core + F.col("size")).alias("high"),
    )
    right = F.struct(
        F.lit("right").alias("side"),
        F.greatest(cut + 1, F.lit(0).cast("long")).alias("start"),
        length.alias("stop"),
        core.alias("low"),
        (cut + 1 + window).alias("high"),
    )
    sides = F.array(
        F.when(cut >= 0, left), F.when(F.greatest(cut + 1, F.lit(0).cast("long")) + window <= length, right)
    )
    places = [
        F.struct(F.lit(number).alias("which"), *[F.col(f"{name}_{part}").alias(part) for part in ("place", "at")])
        for number, name in enumerate(("first", "last"))
    ]
    dealt = (
        crowded.withColumn("owner", F.explode(F.array(places[0], F.when(F.col("n") > 1, places[1]))))
        .withColumn("part", F.explode(sides))
        .where("owner IS NOT NULL AND part IS NOT NULL")
    )

    def piece(start: str, stop: str) -> Column:
        return F.expr(f"substring(text, cast({start} + 1 AS int), cast({stop} - {start} AS int))")

    return dealt.select(
        F.xxhash64("key", "part.side", piece("part.low", "part.high")).alias("key"),
        F.xxhash64(piece("part.start", "part.stop")).alias("sub"),
        (F.col("part.low") - F.col("part.start")).alias("core"),
        (F.col("part.stop") - F.col("part.start")).alias("length"),
        piece("part.start", "part.stop").alias("text"),
        (F.col("part.high") - F.col("part.low")).alias("size"),
        *[F.col(f"owner.{name}").alias(name) for name in ("place", "at")],
        F.struct(*NAME, "owner.which").alias("who"),
        F.col("part.start").alias("base"),
    )


def _verdicts(strings: DataFrame, window: int, spell) -> DataFrame:
    """Names, ``which, start, end``: the bytes to go from a passage's first place (0) or last (1).

    ``strings`` holds each passage once, ``spell`` adds their texts.
    """
    members = strings.groupBy("key").agg(F.sum(F.least("n", F.lit(2))).alias("n_met"))
    members = written(members, "members")
    count, most = members.agg(F.coalesce(F.sum("n_met"), F.lit(0)), F.coalesce(F.max("n_met"), F.lit(0))).head()
    if most <= CROWDED:
        return _in_collections(spell(strings), count, window)
    few, many = f"n_met <= {CROWDED}", f"n_met > {CROWDED}"
    found = _in_collections(spell(spread_join(strings, members, ["key"], count, few)), count, window)
    crowd = written(spell(spread_join(strings, members, ["key"], count, many)), "crowd")
    finer = _longer_cores(crowd, window)
    # A core that stands once has nothing to be compared with.
    cores = written(finer.groupBy("key").agg(F.count(F.lit(1)).alias("n_met")), "cores")
    total = cores.agg(F.sum("n_met")).head()[0]
    finer = written(spread_join(finer, cores, ["key"], total, "n_met > 1"), "passages")
    parts = _strings(finer, ("text", "size"))
    told = _told(finer, parts, _verdicts(parts, window, lambda whole_ones: whole_ones))
    return found.unionByName(told.select("who.*", "start", "end"))


def _told(passages: DataFrame, strings: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``who, start, end``: the verdicts on passages told to each place, counted from ``base``."""
    places = strings.select(*NAME, F.col("n").alias("n_met"), F.col("first_place").alias("fp"), F.col("first_at").alias("fa"))
    told = written(verdicts.join(places, NAME), "verdicts")
    total = strings.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    met = spread_join(passages.select(*NAME, "who", "base", "place", "at"), told, NAME, total)
    is_first = (F.col("place") == F.col("fp")) & (F.col("at") == F.col("fa"))
    start, end = (F.col(name) + F.col("base") for name in ("start", "end"))
    return met.where((F.col("which") == 0) == is_first).select("who", start.alias("start"), end.alias("end"))


def _without_repeats(shards: DataFrame, repeats: DataFrame, kind: str) -> DataFrame:
    """Every row's text without the bytes that go, and where they were."""

    def cut(shard: pa.Table, gone: pa.Table) -> pa.Table:
        gone = gone.sort_by([("who", "ascending"), ("start", "ascending")])
        owners, starts, ends = (gone[name].to_numpy() for name in ("who", "start", "end"))
        ids, texts = Texts.read(shard["file"][0].as_py())
        places = (shard["shard"][0].as_py() << _ROW_BITS) + np.arange(len(texts))
        lows, highs = np.searchsorted(owners, places, "left"), np.searchsorted(owners, places, "right")
        kept, spans = [], []
        for text, low, high in zip(texts, lows.tolist(), highs.tolist()):
            mine = []
            if low < high:
                first, after = starts[low:high], np.maximum.accumulate(ends[low:high])
                new = np.flatnonzero(np.append(True, first[1:] > after[:-1]))
                mine = list(zip(first[new].tolist(), after[np.append(new[1:] - 1, high - low - 1)].tolist()))
            stops = [0, *(end for _, end in mine)]
            kept.append(b"".join(text[a:b] for a, b in zip(stops, [*(start for start, _ in mine), len(text)])))
            spans.append([{"start": a, "end": b} for a, b in mine])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        columns = [ids, pa.array([len(text) for text in texts], pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())]
        return pa.table(columns, names=["id", "n_bytes", "spans", "kept"])

    schema = f"id {kind}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return _by_shard(shards, repeats.withColumn("shard", F.shiftright("who", _ROW_BITS)), cut, schema)


def remove_repeats(docs: DataFrame, window: int = 100, doc_id: str = "doc_id") -> DataFrame:
    """One row for each row: ``doc_id, n_bytes, spans, kept``.

    ``spans`` are the maximal runs of bytes that go, ``kept`` is what is left of the text, in
    bytes, since a run may end inside a character.
    """
    if window < ANCHOR:
        raise ValueError(f"a window has {ANCHOR} bytes or more")
    rows = docs.select(column(doc_id).alias("id"), whole(column("text")).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shards = _shards(rows)
    with inner_tables(docs.sparkSession):
        counted = _anchor_counts(shards, window)
        # One row a shard for each anchor, however often it stands there.
        everywhere = F.sum("n").over(Window.partitionBy("key"))
        found = counted.withColumn("n", everywhere).where("n > 1").select("key", "shard")
        passages = written(_occurrences(shards, found, window), "occurrences")
        strings = _strings(passages)
        owners = passages.withColumn("who", F.col("place")).withColumn("base", F.col("at") - F.col("core"))
        told = _told(owners, strings, _verdicts(strings, window, lambda some: _spelled(shards, some)))
        repeats = written(told, "repeats", keep=True)
    return _without_repeats(shards, repeats, kind).withColumnRenamed("id", doc_id)
