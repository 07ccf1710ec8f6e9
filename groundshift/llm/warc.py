"""WARC archives in zstandard with an embedded dictionary.

An archive starts with a skippable frame that holds the dictionary, itself a
zstandard frame; each record is one frame compressed with it. The writer makes
``response`` records, and ``revisit`` records for payloads that the archive set
holds already. The reader loads the dictionary from the leading frame, decodes
frame by frame, and checks header lines, block lengths, payload lengths and
payload digests.

Of records with equal payloads of at least ``least_bytes`` the one with the
largest id is the response, the others revisit it; smaller payloads are all
responses. Rows that share that largest id are responses each. A null payload
is an empty one. Null ids are smaller than all others, and if all ids of a
payload are null, all its records are responses. Repeated rows give repeated
records, an empty table no archive. Columns other than id, url and payload are
ignored; a null url is written as an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from groundshift.llm.scratch import filesystem, one_task_each, stored

#: Magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: Payloads the dictionary is trained on, octets read of each, and its size.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 500, 16 << 10, 64 << 10
VERSION = b"WARC/1.1"
#: Octets read from an archive at a time.
CHUNK = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, revisits: int | None) -> bytes:
    """One record. A revisit keeps the HTTP header, with the payload's length, and leaves the payload out."""
    kind = "response" if revisits is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if revisits is None else http
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{kind}')}>"),
        ("WARC-Target-URI", "".join(c for c in url if c.isprintable())),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisits is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{revisits}>")]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict[str, str | int | None]:
    """Fields of one record; raises ValueError where header, lengths or digests don't agree."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError(f"no {VERSION.decode()} record: {data[:20]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, mark, value = line.decode().partition(": ")
        if not mark or not name or name.lower() in fields:
            raise ValueError(f"header line {line[:80]!r}")
        fields[name.lower()] = value
    for name in ("warc-type", "warc-record-id", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise ValueError(f"no {name}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} octets, its header says {length}")
    block = rest[:length]
    if fields.get("warc-block-digest") not in (None, f"sha1:{digest(block)}"):
        raise ValueError("the block's digest differs from its header's")
    http, mark, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x[16:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: ")]
    if not mark or len(sizes) != 1:
        raise ValueError("the HTTP header has no length")
    if fields["warc-type"] == "response":
        if len(payload) != sizes[0] or fields["warc-payload-digest"] != f"sha1:{digest(payload)}":
            raise ValueError("the payload differs from its header")
    elif fields["warc-type"] != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError("a revisit has a payload, or refers to nothing")
    page_id = fields.get("x-page-id")
    refers = fields.get("warc-refers-to")
    return {
        "page_id": None if page_id is None else int(page_id),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": sizes[0],
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "record_type": fields["warc-type"],
        "refers_to": None if refers is None else int(refers.removeprefix("<urn:x-page:").removesuffix(">")),
    }


def archive_head(dictionary: bytes) -> bytes:
    """The leading skippable frame."""
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def read_archive(file: BinaryIO) -> Iterator[bytes]:
    """Records of an archive, one frame at a time, from any stream with ``read``."""

    def exactly(n: int) -> bytes:
        data = file.read(n)
        if len(data) != n:
            raise ValueError("the archive is cut off")
        return data

    magic, size = struct.unpack("<II", exactly(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with its dictionary")
    data = exactly(size)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        data = zstandard.ZstdDecompressor().decompress(data)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
    left = b""
    while chunk := left or file.read(CHUNK):
        frame, parts, left = unpacker.decompressobj(), [], b""
        while not frame.eof:
            if not chunk:
                raise ValueError("the last frame is cut off")
            parts.append(frame.decompress(chunk))
            chunk = b"" if frame.eof else file.read(CHUNK)
        left = frame.unused_data
        yield b"".join(parts)


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary trained on the ``SAMPLE_PAGES`` payloads with the smallest hash of their id."""
    chosen = pages.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES).distinct()
    some = pages.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))  # SAMPLE_PAGES ids
    rows = some.select("page_id", F.substring("html", 1, SAMPLE_BYTES).alias("html")).sort("page_id").collect()
    samples = [(r.html or "").encode() for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (VERSION * 2 + b"".join(samples))[-DICTIONARY_BYTES:]


def with_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, url, html, revisits``: the id of the response that holds the same payload, null for a response.

    Only digests that occur twice are joined, one row each; the join splits a hot one.
    """
    key = F.sha1(F.encode("html", "utf-8"))
    size = F.octet_length("html")
    pages = pages.withColumn("key", F.when(size >= least_bytes, F.concat_ws("-", key, size)))
    shared = pages.groupBy("key").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    shared = shared.where(F.col("key").isNotNull() & (F.col("n") > 1)).select("key", "last")
    joined = pages.join(shared, "key", "left")
    other = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("last")).alias("revisits"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 3) -> DataFrame:
    """Write one archive per task to ``folder``; returns the list of archives: ``path, records``.

    A task writes a file of a name of its own and returns it; the list is a
    table written once, so a repeated task leaves at most a file nobody lists.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    dictionary = train_dictionary(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = filesystem(folder)
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        name = f"{path}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        out, n = None, 0
        for batch in batches:
            for row in zip(*(column for column in batch.columns), strict=True):
                page_id, url, html, revisits = (x.as_py() for x in row)
                if out is None:
                    out = files.open_output_stream(name)
                    out.write(archive_head(dictionary))
                out.write(packer.compress(record(page_id, url, html.encode(), revisits)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": pa.array([n], pa.int64())})

    return stored(with_revisits(pages, least_bytes).mapInArrow(run, "path string, records long"), "archives")


def read(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` of every record of the listed archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = filesystem(folder)
        for batch in batches:
            for path, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with files.open_input_stream(path) as file:
                    rows = [parse(data) for data in read_archive(file)]
                if len(rows) != n:
                    raise ValueError(f"{path} has {len(rows)} records, {n} were written")
                yield pa.RecordBatch.from_pylist(rows, kinds)

    kinds = pa.schema([(c, pa.string() if t == "string" else pa.int64()) for c, t in (x.split() for x in SCHEMA.split(", "))])
    return one_task_each(archives, archives.count()).mapInArrow(run, SCHEMA)


SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
