"""Web pages in WARC archives under Zstandard, and back.

An archive starts with a skippable frame that holds the dictionary; each record is one frame
of its own. A task writes its rows into archives of bounded size under names of its own; the
table of archives names those of tasks that ended well, so a lost or repeated task leaves
nothing that is read. Archives are opened through the file system their address names.

Of pages with equal payloads of ``revisit_bytes`` or more, the one with the largest id is a
response and the others revisit it. Null texts are empty payloads, a null url leaves out
its header, and rows repeated whole with the largest id are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm.common import HOT_SHARE, column, in_arrow, partitions, whole, written
from rankfold.sources.store import new_folder

SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16

#: Bounds of the sample that the dictionary is made from.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 4096, 1 << 14

#: Most recurring payloads, a digest and two numbers each, that are all broadcast.
KEEPERS_SENT = 100_000


def qualified(spark: SparkSession, path: str) -> str:
    """The address with its scheme, as the cluster's settings complete it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    address = place.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return re.sub("^file:/+", "file:///", address)


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(page_id, url, payload: bytes, sha1: str, refers_to, is_revisit: bool, date: str) -> bytes:
    head = ["WARC/1.1", "WARC-Type: " + ("revisit" if is_revisit else "response")]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    head.append(f"WARC-Date: {date}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode())
    if is_revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = http_head(len(payload)) + (b"" if is_revisit else payload)
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _need(holds: bool, what: str) -> None:
    if not holds:
        raise ValueError(f"damaged archive: {what}")


def _headers(lines: bytes) -> dict[str, str]:
    pairs = [line.partition(":") for line in lines.decode().split("\r\n")]
    _need(all(colon for _, colon, _ in pairs), "a header without a colon")
    return {name.lower(): value.strip() for name, _, value in pairs}


def read_record(data: bytes) -> dict:
    """One record, its headers, lengths and digest checked."""
    version, _, rest = data.partition(b"\r\n")
    _need(version in (b"WARC/1.0", b"WARC/1.1"), "no WARC version")
    top, gap, block = rest.partition(b"\r\n\r\n")
    _need(bool(gap), "headers do not end")
    head = _headers(top)
    length = int(head.get("content-length", -1))
    _need(len(block) == length + 4 and block.endswith(b"\r\n\r\n"), "wrong Content-Length")
    status, gap, payload = block[:length].partition(b"\r\n\r\n")
    _need(bool(gap), "HTTP headers do not end")
    size = int(_headers(status.partition(b"\r\n")[2])["content-length"])
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = head.get("warc-type")
    _need(kind in ("response", "revisit"), f"record type {kind}")
    if kind == "response":
        _need(len(payload) == size, "wrong payload length")
        _need(hashlib.sha1(payload).hexdigest() == digest, "wrong payload digest")
    else:
        _need(not payload and head.get("warc-profile") == PROFILE, "a revisit of another profile")
    number = re.fullmatch(r"<urn:page:(-?\d*)>", head["warc-record-id"])
    _need(number is not None, "record id")
    refers = head.get("warc-refers-to")
    return {
        "page_id": int(number[1]) if number[1] else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if refers is None else int(refers.removeprefix("<urn:page:").removesuffix(">")),
        "url": head.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


def read_archive(stream):
    """The records of one open archive, one at a time."""
    start = stream.read(8)
    dictionary, data = None, start
    if len(start) == 8 and struct.unpack("<I", start[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", start[4:])[0]
        body = stream.read(size)
        _need(len(body) == size, "the dictionary is cut off")
        if body.startswith(FRAME):
            body = zstandard.ZstdDecompressor().decompress(body)
        dictionary, data = zstandard.ZstdCompressionDict(body), b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        data = data or stream.read(CHUNK)
        if not data:
            return
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                break
            data = stream.read(CHUNK)
            _need(bool(data), "a frame is cut off")
        data = frame.unused_data
        yield read_record(b"".join(parts))


def dictionary_for(pages: DataFrame) -> bytes:
    """A dictionary from the starts of the first ``SAMPLE_ROWS`` pages; empty if they are too few."""
    texts = pages.where(column("html") != "").select(F.substring(column("html"), 1, SAMPLE_BYTES).alias("start"))
    sample = texts.limit(SAMPLE_ROWS).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [row.start.encode() for row in sample]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _with_keepers(rows: DataFrame, revisit_bytes: int) -> DataFrame:
    """``rows`` and the page ``keeper`` that stands for all with their payload; null where there is one.

    Which payloads recur is settled on digests alone. Those that recur in more than one of
    ``HOT_SHARE`` rows are broadcast, and so are all where they are no more than ``KEEPERS_SENT``:
    then no payload is shuffled, and archives are written from the scan's own order.
    """
    same = ["sha1", "size"]
    keepers = (
        rows.where(F.col("size") >= revisit_bytes)
        .groupBy(*same)
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    keepers = written(keepers, "keepers")
    found, met = keepers.agg(F.count(F.lit(1)), F.sum("n")).head()
    if found <= KEEPERS_SENT:
        return rows.join(F.broadcast(keepers.drop("n")), same, "left")
    # No more than HOT_SHARE payloads can have that share of the rows.
    hot = F.broadcast(keepers.where(F.col("n") * HOT_SHARE > met).drop("n"))
    rest = rows.join(hot, same, "left_anti")
    return rows.join(hot, same).unionByName(rest.join(keepers.drop("n"), same, "left"))


def write_archives(
    pages: DataFrame, revisit_bytes: int = 1000, archive_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """Write the pages; returns the table of archives: ``archive, records``."""
    spark = pages.sparkSession
    rows = pages.select(
        column("page_id").cast("long").alias("page_id"),
        column("url").alias("url"),
        whole(column("html")).cast("binary").alias("payload"),
    ).withColumns({"sha1": F.sha1("payload"), "size": F.length("payload")})
    rows = _with_keepers(rows, revisit_bytes).select(
        "page_id", "url", "payload", "sha1", "keeper",
        F.coalesce(~F.col("page_id").eqNullSafe(F.col("keeper")) & F.col("keeper").isNotNull(), F.lit(False)).alias("again"),
    )
    folder, words = qualified(spark, new_folder(spark, "warc")), dictionary_for(pages)

    def write(batches):
        system, base = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        known = zstandard.ZstdCompressionDict(words) if words else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True)
        packed = zstandard.ZstdCompressor(level=19).compress(words)
        leading = struct.pack("<II", SKIPPABLE, len(packed)) + packed if words else b""
        names, counts, stream = [], [], None
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    stream = system.open_output_stream(f"{base}/{name}", compression=None)
                    stream.write(leading)
                    names.append(f"{folder}/{name}")
                    counts.append(0)
                stream.write(packer.compress(record(*values, date)))
                counts[-1] += 1
                if stream.tell() >= archive_bytes:
                    stream.close()
                    stream = None
        if stream is not None:
            stream.close()
        yield pa.record_batch(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["archive", "records"]
        )

    return written(in_arrow(rows, write, "archive string, records bigint"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives named in ``archive``, checked, with its payload."""
    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, url string, payload binary"
    )
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows):
        columns = zip(*(row.values() for row in rows))
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=list(rows[0]))

    def read(batches):
        for batch in batches:
            for address in batch.column(0).to_pylist():
                system, path = pyarrow.fs.FileSystem.from_uri(address)
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for row in read_archive(stream):
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held >= 1 << 22:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    dealt = archives.select("archive").repartition(partitions(archives.sparkSession), "archive")
    return in_arrow(dealt, read, schema)
