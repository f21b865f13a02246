"""WARC archives in Zstandard: a dictionary in a leading skippable frame, one frame per record."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import or_empty, save, store

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
DICTIONARY = 0xEC30A437
VERSION = b"WARC/1.1"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes after which a task closes an archive and begins the next.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16


class ArchiveError(ValueError):
    """An archive that breaks a rule of its format; says at which byte."""


@dataclass
class Record:
    """One record: its place in the archive, its headers, and of an HTTP message the headers and payload."""

    offset: int
    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def _headers(lines: list[bytes], offset: int) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"byte {offset}: a malformed header line")
        if (key := name.decode("ascii", "replace").title()) in out:
            raise ArchiveError(f"byte {offset}: header {key} twice")
        out[key] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(raw: bytes, offset: int = 0) -> Record:
    """One decompressed frame to a record; validates version, mandatory headers, lengths and digests."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or first not in (b"WARC/1.0", VERSION):
        raise ArchiveError(f"byte {offset}: no WARC version line")
    headers = _headers(lines, offset)
    for name in MANDATORY:
        if name.title() not in headers:
            raise ArchiveError(f"byte {offset}: no {name}")
    length = headers["Content-Length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ArchiveError(f"byte {offset}: the block's length is not {length}")
    record = Record(offset, headers, rest[:-4])
    if headers.get("Content-Type", "").startswith("application/http"):
        top, gap, record.payload = record.block.partition(b"\r\n\r\n")
        if not gap:
            raise ArchiveError(f"byte {offset}: an HTTP message without an end of its headers")
        record.http = _headers(top.split(b"\r\n")[1:], offset)
    if headers["Warc-Type"] == "response":
        said = record.http.get("Content-Length")
        if said is not None and said != str(len(record.payload)):
            raise ArchiveError(f"byte {offset}: the payload's length is not {said}")
        said = headers.get("Warc-Payload-Digest", "")
        if said.startswith("sha256:") and said[7:] != hashlib.sha256(record.payload).hexdigest():
            raise ArchiveError(f"byte {offset}: the payload's digest differs")
    return record


def read_archive(stream) -> Iterator[Record]:
    """Records of one archive, in order; reads ``stream`` in pieces and holds one record at a time."""
    held, at = b"", 0

    def more() -> bool:
        nonlocal held
        piece = stream.read(READ_BYTES)
        held += piece
        return bool(piece)

    def need(size: int) -> bool:
        while len(held) < size:
            if not more():
                return False
        return True

    dictionary = None
    while need(1):
        if not need(4):
            raise ArchiveError(f"byte {at}: a cut frame")
        (magic,) = struct.unpack_from("<I", held)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if not need(8) or not need(8 + (size := struct.unpack_from("<I", held, 4)[0])):
                raise ArchiveError(f"byte {at}: a cut skippable frame")
            if magic == DICTIONARY_FRAME and at == 0:
                body = held[8 : 8 + size]
                if body[:4] == struct.pack("<I", FRAME):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                if body[:4] != struct.pack("<I", DICTIONARY):
                    raise ArchiveError("byte 0: no dictionary in the leading frame")
                dictionary = zstandard.ZstdCompressionDict(body)
            held, at = held[8 + size :], at + 8 + size
            continue
        if magic != FRAME:
            raise ArchiveError(f"byte {at}: no frame")
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts, used = [], 0
        try:
            while True:
                piece, held = held, b""
                parts.append(frame.decompress(piece))
                used += len(piece)
                if frame.eof:
                    held = frame.unused_data
                    used -= len(held)
                    break
                if not more():
                    raise ArchiveError(f"byte {at}: a cut frame")
        except zstandard.ZstdError as e:
            raise ArchiveError(f"byte {at}: {e}") from e
        yield parse_record(b"".join(parts), at)
        at += used


def format_record(kind: str, record_id: str, uri: str, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    """A response, or a revisit of an identical payload: it has the HTTP headers, which tell the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    lines = [
        VERSION.decode(),
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if refers_to:
        lines[6:6] = [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {IDENTICAL}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _uri(url: str | None, record_id: str) -> str:
    """A target without white space or control characters."""
    safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    return safe or record_id


def train_dictionary(payloads: DataFrame, sample: int = 400, largest: int = 32 << 10, size: int = 64 << 10) -> bytes:
    """A dictionary of at most ``size`` bytes from at most ``sample`` payloads of up to ``largest`` bytes.

    Those of smallest digest are taken, so at most ``sample`` * ``largest`` bytes come to the driver.
    Without enough of them there is no dictionary (empty bytes).
    """
    small = payloads.where(F.length("payload").between(1, largest))
    chosen = [bytes(r["payload"]) for r in small.orderBy("digest").select("payload").limit(sample).collect()]
    if len(chosen) < 20 or sum(map(len, chosen)) < 8 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, chosen).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(
    pages: DataFrame, folder: str, dedup_from: int = 100, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Writes one record per row below ``folder``; returns the archives (file, records, bytes) that count.

    The payload is the text in UTF-8, a null text the empty payload.  Of rows of equal payloads of at
    least ``dedup_from`` bytes, that of the smallest key is a response and the others revisit it; rows
    that share the smallest key, and rows of smaller payloads, are all responses.  Null keys come
    last; if all are null, all rows are responses.  Extra columns are not written.

    Scale: only digests that two rows share are joined back, by digest, with map-side minima before;
    rows of one hot payload are spread by the join's skew handling.  A task streams its rows
    into archives of about ``ARCHIVE_BYTES`` under names of its own.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
        F.encode(or_empty(F.col(html).cast("string")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    dictionary = train_dictionary(rows)
    long_ones = rows.where(F.length("payload") >= dedup_from)
    firsts = long_ones.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    firsts, _ = save(firsts.where("n > 1 and first is not null").select(F.col("digest").alias("of"), "first"), "warc-firsts")
    rows = rows.join(firsts, F.col("digest") == F.col("of"), "left")
    rows = rows.withColumn("refers", F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")))
    rows = rows.select("key", "url", "payload", "digest", "refers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        system.create_dir(root, recursive=True)
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=trained)
        out, name, count, size, made = None, "", 0, 0, []
        for batch in batches:
            for k, address, payload, digest, refers in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name, count, size = f"pages-{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(f"{root}/{name}")
                    if dictionary:
                        out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                        size += 8 + len(dictionary)
                record_id = f"urn:page:{'' if k is None else k}"
                kind = "response" if refers is None else "revisit"
                to = None if refers is None else f"urn:page:{refers}"
                raw = format_record(kind, record_id, _uri(address, record_id), digest, len(payload), payload, to)
                frame = squeeze.compress(raw)
                out.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    made.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            made.append((name, count, size))
        columns = list(zip(*made)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["file", "records", "bytes"]
        )

    manifest = f"{folder}/manifest"
    rows.mapInArrow(run, "file string, records long, bytes long").write.parquet(manifest)
    return spark.read.parquet(manifest)


def read_archives(spark: SparkSession, files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the archives named in ``files`` (column ``file``), one row each.

    (file, offset, record_type, record_id, target_uri, refers_to, payload_digest, payload_bytes[, payload]).
    The digest of a response is computed from its payload; that of a revisit, and the length of
    the full payload, are what its headers tell.  An archive that breaks a rule fails the job with the byte
    where it does.  A task reads one archive at a time and holds one record.
    """
    schema = (
        "file string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
        "payload_digest string, payload_bytes long" + ", payload binary" * with_payload
    )
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()][: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{root}/{name}") as stream:
                    for r in read_archive(stream):
                        h, response = r.headers, r.headers["Warc-Type"] == "response"
                        digest = hashlib.sha256(r.payload).hexdigest() if response else h.get("Warc-Payload-Digest", "").removeprefix("sha256:")
                        size = len(r.payload) if response else int(r.http.get("Content-Length", 0))
                        rows.append((name, r.offset, h["Warc-Type"], h["Warc-Record-Id"], h.get("Warc-Target-Uri"), h.get("Warc-Refers-To"), digest, size, r.payload))
                        held += len(r.payload) if with_payload else 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names_only = files.select("file")
    return names_only.repartition(max(1, names_only.count())).mapInArrow(run, schema)
