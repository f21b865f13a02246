import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from stayline.llm import warc
from stayline.llm.common import new_path
from stayline.llm.warc import ArchiveError, format_record, parse_record, read_archive, read_archives, write_archives


def record(payload=b"<p>hello</p>", kind="response", **change):
    return format_record(kind, "urn:page:1", "http://a/", hashlib.sha256(payload).hexdigest(), len(payload), payload, change.get("to"))


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("digest", F.lit("x")).withColumn("key", F.lit(1)).withColumn("payload", F.lit(None).cast("int"))


def truth(rows):
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first.get(body) if first.get(body) != i else None
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def digest(records):
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    return sorted(
        ((number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in records), key=str
    )


@pytest.mark.parametrize("archive_bytes", [1000, 64 << 20])
def test_round_trip(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    rows = [(i, f"http://h/{i}", f"<html>page {i % 40} " + "é<b>text</b>\r\n\r\n" * (i % 40) + "</html>") for i in range(300)]
    rows += [(900, None, None), (901, "a b\r\nX: y", ""), (902, "u", "z" * 300_000), (None, "n", "q" * 200), (903, "n", "q" * 200), (903, "n", "q" * 200), (904, "n", "q" * 200)]
    folder = new_path(spark, "test")
    files = write_archives(pages(spark, rows), folder)
    found = read_archives(spark, files, folder).collect()
    assert digest(found) == truth(rows)
    bodies = {(html or "").encode() for _, _, html in rows}
    assert all(bytes(r["payload"]) in bodies for r in found if r["record_type"] == "response")
    assert files.agg(F.sum("records")).first()[0] == len(rows)


def test_empty_table(spark):
    folder = new_path(spark, "test")
    assert read_archives(spark, write_archives(pages(spark, []), folder), folder).count() == 0


def test_dictionary_frames():
    sample = [b"some words %d and other words" % i * 9 for i in range(500)]
    trained = zstandard.train_dictionary(4096, sample)
    squeeze = zstandard.ZstdCompressor(dict_data=trained)
    frames = b"".join(squeeze.compress(record(s)) for s in sample[:5])
    raw = trained.as_bytes()
    for body in (raw, zstandard.ZstdCompressor().compress(raw)):
        archive = struct.pack("<II", warc.DICTIONARY_FRAME, len(body)) + body + frames
        assert [r.payload for r in read_archive(io.BytesIO(archive))] == sample[:5]
    other = struct.pack("<II", 0x184D2A51, 3) + b"abc"
    plain = zstandard.ZstdCompressor().compress(record())
    assert len(list(read_archive(io.BytesIO(plain + other + plain)))) == 2
    assert list(read_archive(io.BytesIO(b""))) == []
    with pytest.raises(ArchiveError):
        list(read_archive(io.BytesIO(frames)))
    for broken in (plain[:-3], plain + b"\x01", b"abcdefgh", struct.pack("<II", warc.DICTIONARY_FRAME, 9) + b"no", struct.pack("<II", warc.DICTIONARY_FRAME, 4) + b"nope"):
        with pytest.raises(ArchiveError):
            list(read_archive(io.BytesIO(broken)))


def test_invalid_records():
    good = record()
    assert parse_record(good).payload == b"<p>hello</p>"
    revisit = parse_record(record(kind="revisit", to="urn:page:0"))
    assert revisit.payload == b"" and revisit.http["Content-Length"] == "12" and revisit.headers["Warc-Refers-To"] == "<urn:page:0>"
    for old, new in ((b"WARC/1.1", b"WARC/9"), (b"WARC-Date", b"X-Date"), (b"hello", b"jello"), (b"Content-Length: 12", b"Content-Length: 13"), (b"\r\n\r\n", b""), (b"</p>", b"</p>x"), (b"WARC-Type", b"WARC-Date"), (b"WARC-Type:", b"WARC-Type")):
        with pytest.raises(ArchiveError):
            parse_record(good.replace(old, new))
