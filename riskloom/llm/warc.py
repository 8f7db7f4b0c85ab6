"""WARC archives compressed with Zstandard and a shared dictionary.

Method (Zstandard archive reader): an archive begins with a skippable frame that carries the
dictionary; then follows one frame per record. The reader loads the dictionary from the leading
frame, decodes one frame at a time, and validates each record's version line, headers, block length
and digests. Archives hold about ``archive_bytes``, so a task keeps one archive at a time.

Spark has no sink for raw bytes, so archives are rows ``(archive, content)`` of a Parquet table in
the shared folder; :func:`read_archives` takes any frame with a ``content`` column, thus also files
read by the ``binaryFile`` source.

Edge cases: a null html is an empty payload; empty payloads are equal payloads like others; a null
page_id sorts before every other and is written without an id; of repeated rows of one id each
becomes a record; a null url is an empty target; an empty table gives an empty archive table;
further columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DICTIONARY_MAGIC = 0x184D2A5D
ARCHIVES = "archive string, records long, content binary"
RECORDS = (
    "page_id long, record_id string, record_type string, target_uri string, date string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)
DATE = "2024-01-01T00:00:00Z"
READ = 1 << 14


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id) -> str:
    return "" if page_id is None else f"<urn:page:{page_id}>"


def _line(value: str | None) -> str:
    return "".join((value or "").split())


def encode_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit that holds the response's HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _uri(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _uri(refers_to)),
        ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in raw.decode("utf-8").split("\r\n") if line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _page(uri: str | None):
    return int(uri[len("<urn:page:") : -1]) if uri else None


def decode_record(raw: bytes) -> tuple:
    """The fields of ``RECORDS``; ValueError where headers, lengths or digests don't hold."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, fields = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("not a WARC record")
    header = _headers(fields)
    kind, length = header.get("warc-type"), header.get("content-length", "")
    if kind not in ("response", "revisit") or not length.isdigit():
        raise ValueError("a record needs a known type and a length")
    block, tail = rest[: int(length)], rest[int(length) :]
    if len(block) != int(length) or tail != b"\r\n\r\n":
        raise ValueError("the block doesn't have its length")
    if header.get("warc-block-digest") != f"sha1:{digest(block)}":
        raise ValueError("the block doesn't have its digest")
    http, gap, payload = block.partition(b"\r\n\r\n")
    size = _headers(http.partition(b"\r\n")[2]).get("content-length", "")
    named = header.get("warc-payload-digest", "")
    if not gap or not size.isdigit() or not named.startswith("sha1:"):
        raise ValueError("the block isn't an HTTP response with a payload digest")
    if kind == "response" and (len(payload) != int(size) or named != f"sha1:{digest(payload)}"):
        raise ValueError("the payload doesn't have its length and digest")
    if kind == "revisit" and (payload or not header.get("warc-refers-to")):
        raise ValueError("a revisit has no payload and names its response")
    record_id = header.get("warc-record-id") or None
    return (
        _page(record_id), record_id, kind, header.get("warc-target-uri"), header.get("warc-date"), int(size), named[5:],
        _page(header.get("warc-refers-to")), payload if kind == "response" else None,
    )


def train_dictionary(samples: list[bytes], size: int = 32_768) -> bytes:
    """A Zstandard dictionary; from few samples a plain one of their bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"".join(samples) + encode_record(0, "http://", b"", None))[-size:]


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def open_archive(content: bytes):
    """``(decompressor, offset of the first record)``."""
    import zstandard

    if len(content) < 8:
        raise ValueError("an archive begins with a dictionary frame")
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC or len(content) < 8 + size:
        raise ValueError("an archive begins with a whole dictionary frame")
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8 : 8 + size])), 8 + size


def frames(content: bytes):
    """Decoded frames, one by one."""
    decompressor, at = open_archive(content)
    while at < len(content):
        reader, parts = decompressor.decompressobj(), []
        while not reader.eof:
            piece = content[at : at + READ]
            if not piece:
                raise ValueError("a frame ends early")
            parts.append(reader.decompress(piece))
            at += len(piece)
        at -= len(reader.unused_data)
        yield b"".join(parts)


def write_archives(records: DataFrame, dictionary: bytes, archive_bytes: int = 4 << 20) -> DataFrame:
    """Archives of ``records (page_id, url, html, refers_to)``; a task fills one at a time."""

    def write(batches):
        import uuid

        import zstandard
        from pyspark import TaskContext

        compressor = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        lead = dictionary_frame(dictionary)
        parts, size, count, number = [lead], len(lead), 0, 0
        part = TaskContext.get().partitionId() if TaskContext.get() else uuid.uuid4().hex

        def flush():
            name = f"part-{part:05d}-{number:05d}.warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64()), pa.array([b"".join(parts)], pa.binary())], names=["archive", "records", "content"])

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "html", "refers_to"))
            for page_id, url, html, refers_to in zip(*columns):
                frame = compressor.compress(encode_record(page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), refers_to.as_py()))
                parts.append(frame)
                size, count = size + len(frame), count + 1
                if size >= archive_bytes:
                    yield flush()
                    parts, size, count, number = [lead], len(lead), 0, number + 1
        if count:
            yield flush()

    return records.select("page_id", "url", "html", "refers_to").mapInArrow(write, ARCHIVES)


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """The records of archives (a frame with ``content``), validated; payloads only if asked for."""

    def read(batches):
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in RECORDS.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for raw in frames(content.as_buffer().to_pybytes()):
                    row = decode_record(raw)
                    rows.append(row if payload else (*row[:-1], None))
                    size += len(raw) if payload else 300
                    if size > 1 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    # an archive at a time: the reader's batches hold whole contents
    return archives.select("content").mapInArrow(read, RECORDS)


def resolve_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, refers_to``: of equal payloads the largest page_id stays a response."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    digests = pages.select("page_id", F.sha2("html", 256).alias("payload"))
    owners = digests.groupBy("payload").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).filter("n > 1").drop("n")
    links = (
        digests.join(owners, "payload")
        .filter(F.col("page_id") < F.col("owner"))
        .select("page_id", "payload", F.col("owner").alias("refers_to"))
        .distinct()
    )
    # by id, not by payload: copies of one payload stay spread; the payload tells rows of one id apart
    return (
        pages.withColumn("payload", F.sha2("html", 256)).join(links, ["page_id", "payload"], "left").select("page_id", "url", "html", "refers_to")
    )


def dictionary_of(pages: DataFrame, sample: int = 256) -> bytes:
    """A dictionary trained on the ``sample`` pages with the least hashes of their ids.

    The ids are chosen first, so a task sends no page to the driver that isn't in the sample.
    """
    filled = pages.filter("html is not null and page_id is not null")
    ids = [r[0] for r in filled.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample).collect()]
    if not ids:
        return train_dictionary([])
    rows = filled.filter(F.col("page_id").isin(ids)).select("html").limit(sample).collect()
    return train_dictionary([r["html"].encode() for r in rows if r["html"]])


def archive_round_trip(pages: DataFrame, archive_bytes: int = 4 << 20) -> DataFrame:
    """Write every page as a record, read the archives back, and return what the records say."""
    from riskloom.workspace import written

    spark = pages.sparkSession
    archives = write_archives(resolve_revisits(pages), dictionary_of(pages), archive_bytes)
    stored = written(spark, archives, "warc")
    return read_archives(stored).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
