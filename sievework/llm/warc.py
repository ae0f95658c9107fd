"""WARC archives compressed record by record with a shared Zstandard dictionary."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ddl, first_by_hash, stage, text_of

#: Fixed values of the formats: the skippable frame that carries a dictionary, Zstandard's own frame and dictionary.
SKIPPABLE = 0x184D2A5D
DICTIONARY_MAGIC = 0xEC30A437

_ARCHIVE = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("content", pa.binary())])
_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
    ]
)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, kind: str, digest: str, refers_to: int | None, size: int) -> bytes:
    """One uncompressed WARC/1.1 record. A revisit names its response and carries no payload."""
    name = "none" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {'' if url is None else url.replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if url is None:
        head.pop(4)
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    fields["version"] = lines[0]
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    return fields, rest[:size]


def train_dictionary(samples: list[bytes], size: int = 65_536) -> bytes:
    """A Zstandard dictionary from sample records; too few of them serve as raw content themselves."""
    if sum(map(len, samples)) >= 8 * size and len(samples) >= 50:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def archive_head(dictionary: bytes) -> bytes:
    """The leading skippable frame: the dictionary, itself compressed."""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    trained = len(data) >= 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def read_archive(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, uncompressed record) of each member, by the dictionary that the archive carries."""
    magic, size = struct.unpack("<II", content[:8])
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    raw = zstandard.ZstdDecompressor().decompress(content[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)) if raw else zstandard.ZstdDecompressor()
    at, view = 8 + size, memoryview(content)
    while at < len(content):
        member = reader.decompressobj()
        data = member.decompress(view[at:])
        used = len(content) - at - len(member.unused_data)
        yield at, data
        at += used


def write_archives(pages: DataFrame, min_revisit: int = 1000, archive_bytes: int = 2 << 20, sample_rows: int = 1500, sample_bytes: int = 4 << 20) -> DataFrame:
    """Pages as WARC archives: rows (archive, records, content), each content a complete .warc.zst file of
    about archive_bytes at most (a longer record gets its own).

    Of pages whose equal payloads have min_revisit bytes or more, the one with the largest page_id is the
    response (rows that repeat its id too), the others are revisits without payload; shorter ones are all
    responses, as are pages of a group without ids. The dictionary is trained on a sample of sample_rows
    pages at most, by hash of page_id, and of sample_bytes; every page is written.

    Only payloads that occur twice are joined back, by digest; a group of copies is counted before the
    shuffle. Null html: empty. Null url: no target header. No rows: none.
    """
    full = pages.select("page_id", "url", text_of("html").alias("html"))
    keyed = full.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("size"))
    groups = keyed.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("copies"))
    groups = stage(groups.where("copies > 1 and leader is not null").select(F.col("digest").alias("g_digest"), "leader"), "warc-groups")
    typed = full.withColumn("digest", F.sha1(F.col("html").cast("binary"))).join(groups, F.col("digest") == F.col("g_digest"), "left")
    revisit = F.col("leader").isNotNull() & ~F.col("leader").eqNullSafe(F.col("page_id"))
    typed = typed.select(
        "page_id",
        "url",
        F.octet_length("html").cast("long").alias("size"),
        "digest",
        F.when(revisit, F.col("leader")).alias("refers_to"),
        F.when(revisit, F.lit("")).otherwise(F.col("html")).alias("html"),
    )
    # ids and sizes first, as many as the dictionary has room for; only the pages that they name are then read, whole
    sized = full.where("page_id is not null").groupBy(F.col("page_id").alias("c_id")).agg(F.max(F.octet_length("html")).cast("long").alias("c_size")).where(F.col("c_size") <= sample_bytes)
    chosen, room = [], sample_bytes
    for r in first_by_hash(sized, "c_id", sample_rows).collect():
        if r.c_size <= room:
            chosen.append((r.c_id,))
            room -= r.c_size
    samples = []
    if chosen:
        ids = pages.sparkSession.createDataFrame(chosen, "c_id long")
        picked = full.join(F.broadcast(ids), full["page_id"] == ids["c_id"]).select("page_id", full["url"], "html")  # sample_rows ids at most
        for r in sorted(picked.collect(), key=lambda r: (r.page_id, r.url or "", r.html)):
            body = r.html.encode()
            samples.append(record_bytes(r.page_id, r.url, body, "response", hashlib.sha1(body).hexdigest(), None, len(body)))
    dictionary = train_dictionary(samples)
    head = archive_head(dictionary)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = {"dict_data": _dictionary(dictionary)} if dictionary else {}
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True, **extra)
        part, number = TaskContext.get().partitionId(), 0
        frames: list[bytes] = []
        held = 0

        def flush():
            nonlocal number, frames, held
            out = pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:06d}-{number:05d}.warc.zst"]), pa.array([len(frames)], pa.int64()), pa.array([head + b"".join(frames)], pa.binary())], schema=_ARCHIVE
            )
            number, frames, held = number + 1, [], 0
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500).to_pydict()
                for page, url, size, digest, refers, html in zip(*(rows[c] for c in ("page_id", "url", "size", "digest", "refers_to", "html")), strict=True):
                    kind = "response" if refers is None else "revisit"
                    frame = squeeze.compress(record_bytes(page, url, html.encode(), kind, digest, refers, size))
                    if frames and held + len(frame) > archive_bytes:
                        yield flush()
                    frames.append(frame)
                    held += len(frame)
        if frames:
            yield flush()

    return typed.mapInArrow(write, ddl(_ARCHIVE))


def read_archives(archives: DataFrame) -> DataFrame:
    """One row for each record of (archive, content) rows; digest and size of a response are computed from
    the payload that was read."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive"), batch.column("content"), strict=True):
                rows = []
                for at, data in read_archive(content.as_py()):
                    head, body = parse_record(data)
                    page = head["WARC-Record-ID"][10:-1]
                    size, digest = len(body), hashlib.sha1(body).hexdigest()
                    if head["WARC-Type"] == "revisit":
                        size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
                    elif head["WARC-Payload-Digest"] != "sha1:" + digest:
                        raise ValueError(f"payload of {page} does not match its digest")
                    refers = head.get("WARC-Refers-To")
                    rows.append(
                        (None if page == "none" else int(page), head.get("WARC-Target-URI"), size, digest, head["WARC-Type"], refers and int(refers[10:-1]), name.as_py(), at)
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RECORD, strict=True)], schema=_RECORD)

    return archives.select("archive", "content").mapInArrow(read, ddl(_RECORD))


def export_archives(archives: DataFrame, folder: str) -> None:
    """Write each archive as a file of its own into a folder that all executors mount."""
    import os

    def save(rows):
        for r in rows:
            temp = os.path.join(folder, f".{r.archive}.{os.getpid()}")
            with open(temp, "wb") as f:
                f.write(r.content)
            os.replace(temp, os.path.join(folder, r.archive))

    os.makedirs(folder, exist_ok=True)
    archives.select("archive", "content").foreachPartition(save)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder, then read those back."""
    return read_archives(stage(write_archives(pages), "archives"))
