"""Token ids as a wavelet matrix per shard: access, counting and look-up from one compressed file."""

from __future__ import annotations

import functools
import itertools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.bpe import PRE_TOKEN, Spelling, pack
from stayline.llm.common import frugal, or_empty, store

#: Fixed values of the format: the file's first bytes, and the bits of a plane that are compressed together.
MAGIC = b"WMX1"
BLOCK = 1 << 17
#: Ids that are put in their places together, so few that they stay in the processor's cache.
STRETCH = 1 << 16
#: Ids after which a task closes a file and begins the next; a document is never divided.
FILE_IDS = 4_000_000
#: Files that a reading task takes at most, unless there are few of them.
FILES_READ = 16
#: Chunks and pre-tokens whose ids a worker remembers in each of two generations.
CHUNKS, PIECES = 100_000, 400_000
#: Fixed value: blocks whose classes no version of Unicode changes any more.
_SETTLED = re.compile("[\\x09-\\x0D\\x20-\u024f\u2010-\u2027]*")
#: Header: first bytes, ids, documents, levels, bytes of the directory.
HEAD = struct.Struct("<4sQQBQ")


def _planes(ids: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, int]]:
    """Bits of each level from the highest down, and the number of zeros; zeros then go first, in order."""
    for level in range(levels - 1, -1, -1):
        ones = (ids & ids.dtype.type(1 << level)).astype(bool)
        count = len(ids) - int(np.count_nonzero(ones))
        yield np.packbits(ones, bitorder="little"), count
        below, zero, one = np.empty_like(ids), 0, count
        for start in range(0, len(ids), STRETCH):
            some, bits = ids[start : start + STRETCH], ones[start : start + STRETCH]
            places = np.flatnonzero(~bits)
            np.take(some, places, out=below[zero : zero + len(places)], mode="clip")
            zero += len(places)
            places = np.flatnonzero(bits)
            np.take(some, places, out=below[one : one + len(places)], mode="clip")
            one += len(places)
        ids = below


def encode_shard(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """One file: header, compressed directory, compressed blocks.

    The directory holds the documents (identities, lengths) and for each plane the number of zeros, the
    ones before each block and the place of each block.  A block is stored as it is if compression
    does not shorten it.
    """
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    ids = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    zeros, ranks, places, blocks, at = [], [], [], [], 0
    size = BLOCK // 8
    for plane, count in _planes(ids, levels):
        zeros.append(count)
        ones = 0
        for start in range(0, len(plane), size):
            raw = plane[start : start + size]
            packed = squeeze(raw.tobytes())
            packed = packed if len(packed) < len(raw) else raw.tobytes()
            ranks.append(ones)
            places.append(at)
            blocks.append(packed)
            at += len(packed)
            ones += int(np.bitwise_count(raw).sum())
    places.append(at)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    directory = b"".join(
        [
            np.array(zeros, "<i8").tobytes(),
            np.array(ranks, "<i8").tobytes(),
            np.array(places, "<i8").tobytes(),
            known.tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array(lengths, "<i8").tobytes(),
        ]
    )
    directory = zstandard.ZstdCompressor(level=3).compress(directory)
    return HEAD.pack(MAGIC, len(ids), len(doc_ids), levels, len(directory)) + directory + b"".join(blocks)


class Shard:
    """A file of ``encode_shard``; ``read(offset, length)`` gets bytes of it, so that queries touch few blocks."""

    def __init__(self, read: Callable[[int, int], bytes]):
        magic, self.n, docs, self.levels, size = HEAD.unpack(read(0, HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        raw = zstandard.ZstdDecompressor().decompress(read(HEAD.size, size))
        per = self.per = -(-self.n // BLOCK)
        shapes = [("zeros", "<i8", self.levels), ("ranks", "<i8", self.levels * per), ("places", "<i8", self.levels * per + 1),
                  ("known", "u1", docs), ("identities", "<i8", docs), ("lengths", "<i8", docs)]
        at, parts = 0, {}
        for name, kind, count in shapes:
            parts[name] = np.frombuffer(raw, kind, count, at)
            at += parts[name].nbytes
        self.zeros, self.ranks, self.places, self.lengths = (parts[k] for k in ("zeros", "ranks", "places", "lengths"))
        self.doc_ids = [int(d) if k else None for d, k in zip(parts["identities"], parts["known"])]
        self.read, self.base, self.held = read, HEAD.size + size, {}

    def block(self, level: int, number: int) -> np.ndarray:
        """Bytes of one block of a plane; the last few stay in memory."""
        key = level * self.per + number
        if key not in self.held:
            if len(self.held) >= 256:
                self.held.clear()
            start, end = int(self.places[key]), int(self.places[key + 1])
            raw = self.read(self.base + start, end - start)
            size = (min(BLOCK, self.n - number * BLOCK) + 7) // 8
            raw = raw if len(raw) == size else zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
            self.held[key] = np.frombuffer(raw, np.uint8)
        return self.held[key]

    def ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if not i:
            return 0
        number, left = divmod(i - 1, BLOCK)
        left += 1
        raw = self.block(level, number)
        count = int(self.ranks[level * self.per + number]) + int(np.bitwise_count(raw[: left // 8]).sum())
        return count + (int(raw[left // 8] & ((1 << left % 8) - 1)).bit_count() if left % 8 else 0)

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit = int(self.block(level, i // BLOCK)[i % BLOCK // 8]) >> i % 8 & 1
            value = value << 1 | bit
            ones = self.ones(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the token's occurrences among the first ``i`` stand after the last level."""
        start, end = 0, i
        for level in range(self.levels):
            a, b = self.ones(level, start), self.ones(level, end)
            if token >> (self.levels - 1 - level) & 1:
                start, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token among the first ``i`` ids."""
        if token < 0 or token >> self.levels:
            return 0
        start, end = self._range(token, min(i, self.n))
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the occurrence number ``k`` (from 0)."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(token, 0)[0] + k
        for level in range(self.levels - 1, -1, -1):
            one = token >> (self.levels - 1 - level) & 1
            at = self._find(level, at - int(self.zeros[level]) if one else at, one)
        return at

    def _find(self, level: int, k: int, one: int) -> int:
        """Place of bit number ``k`` (from 0) that is one, or zero, in a plane."""
        before = self.ranks[level * self.per : (level + 1) * self.per]
        if not one:
            before = np.arange(self.per) * BLOCK - before
        number = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.block(level, number), bitorder="little")[: min(BLOCK, self.n - number * BLOCK)]
        return number * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[number])])

    def all(self) -> np.ndarray:
        """Every id, plane by plane from the lowest up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        ids = np.zeros(self.n, dtype=kind)
        for level in range(self.levels - 1, -1, -1):
            raw = np.concatenate([self.block(level, b) for b in range(self.per)]) if self.per else np.zeros(0, np.uint8)
            ones = np.unpackbits(raw, count=self.n, bitorder="little").view(bool)
            out = np.empty_like(ids)
            zero, one = 0, int(self.zeros[level])
            ids[one:] |= kind(1 << (self.levels - 1 - level))
            for start in range(0, self.n, STRETCH):
                some, bits = out[start : start + STRETCH], ones[start : start + STRETCH]
                places = np.flatnonzero(~bits)
                some[places] = ids[zero : zero + len(places)]
                zero += len(places)
                places = np.flatnonzero(bits)
                some[places] = ids[one : one + len(places)]
                one += len(places)
            ids = out
        return ids


class _Library(Spelling):
    """Ids of texts by the tokenizers library, as packed 32-bit integers.

    Of a byte-level BPE tokenizer, the library's model sees each distinct pre-token once while it is
    remembered.  Texts that hold an added token, and other kinds of tokenizer, go through the library whole.
    """

    def __init__(self, path: str):
        # The library would start a thread for every core in each worker.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        split = self.tokenizer.pre_tokenizer
        self.plain = (
            self.tokenizer.normalizer is None
            and isinstance(self.tokenizer.model, models.BPE)
            and isinstance(split, pre_tokenizers.ByteLevel)
            and split.use_regex
            and not split.add_prefix_space
        )
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.split = self.tokenizer.model, getattr(split, "pre_tokenize_str", None)
        self.stands_for = dict(enumerate(_byte_letters()))
        self.find = regex.compile(PRE_TOKEN).findall
        super().__init__(CHUNKS, PIECES)

    def _piece(self, piece: str) -> bytes:
        # Printable characters of ASCII but the blank stand for themselves.
        if piece.isascii() and piece.isprintable():
            return self._mapped(piece.replace(" ", self.stands_for[0x20]))
        return self._mapped(piece.encode().decode("latin-1").translate(self.stands_for))

    def _mapped(self, piece: str) -> bytes:
        return pack([t.id for t in self.model.tokenize(piece)])

    def _whole(self, chunk: str) -> bytes:
        if _SETTLED.fullmatch(chunk):
            return b"".join([self.pieces[p] for p in self.find(chunk)])
        return b"".join([self._mapped(mapped) for mapped, _ in self.split(chunk)])

    def _apart(self, texts: pa.Array) -> np.ndarray:
        apart = np.full(len(texts), not self.plain)
        for added in self.added:
            apart |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False)
        return apart

    def encode(self, text: str) -> bytes:
        if text and (not self.plain or any(a in text for a in self.added)):
            return pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return super().encode(text)


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level BPE: printable ones themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(0x100)
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def _library(path: str) -> _Library:
    """One for all tasks of a worker process, with what it remembers."""
    return _Library(path)


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end: int = 2, text: str = "text", identity: str = "doc_id") -> DataFrame:
    """Encodes texts and writes shard files below ``folder``; returns one row per file: its name, place in order and ids.

    Documents stand in ascending order of identity (null first, equal ones by a hash of the text, then by text),
    over all files.  A null text is the empty text; a text that holds an added token's string is
    encoded as the library encodes it by default.  Every document ends with the id ``end``.  A very long text is
    encoded whole, in a file of its own if it has more than ``FILE_IDS`` ids; repeated rows are documents of
    their own; an empty table makes no file and an empty result; other columns are not read, so their names do
    not matter.  A task writes files of about ``FILE_IDS`` ids under names of its own, so what a
    repeated task writes never mixes with the result; the rows returned name the files that count.
    They are saved beside them.
    """
    rows = docs.select(F.col(identity).cast("long").alias("id"), or_empty(F.col(text).cast("string")).alias("text"))
    # The hash divides rows of one identity (or none) among tasks.
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie")
    rows = rows.sortWithinPartitions("id", "tie", "text").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, library = TaskContext.get().partitionId(), _library(tokenizer)
        system, root = store(folder)
        system.create_dir(root, recursive=True)
        stop = np.array([end], dtype="<u4").tobytes()
        parts: list[bytes] = []
        ids: list[int | None] = []
        number, held, made = 0, 0, []

        def close():
            name = f"shard-{part:06d}-{number:04d}-{uuid.uuid4().hex}.wmx"
            body = encode_shard(np.frombuffer(b"".join(parts), dtype="<u4"), ids, [len(p) // 4 for p in parts])
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(body)
            made.append((name, part, number, sum(len(p) // 4 for p in parts), len(body)))
            parts.clear()
            ids.clear()

        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), library.encode_batch(batch.column(1))):
                if parts and held + len(packed) // 4 > FILE_IDS:
                    close()
                    number, held = number + 1, 0
                parts.append(packed + stop)
                ids.append(i)
                held += len(packed) // 4 + 1
        if parts:
            close()
        columns = list(zip(*made)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "part", "number", "ids", "bytes"]
        )

    manifest = f"{folder}/manifest"
    rows.mapInArrow(frugal(run), "file string, part long, number long, ids long, bytes long").write.parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


def read_documents(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files that ``manifest`` names.

    ``start`` counts the ids of all documents before: a running sum over the writing tasks, one row each,
    and within a task over its files.  A task reads up to ``FILES_READ`` files, one at a time.
    """
    spark = manifest.sparkSession
    files = manifest.count()
    tasks = max(min(files, 4 * spark.sparkContext.defaultParallelism), -(-files // FILES_READ), 1)
    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", before(Window.orderBy("part")).alias("base"))
    starts = manifest.withColumn("within", before(Window.partitionBy("part").orderBy("number"))).join(parts, "part")
    slices = starts.select("file", (F.col("base") + F.col("within")).alias("start")).repartition(tasks)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{root}/{name}") as file:
                    shard = Shard(lambda at, size: file.read_at(size, at))
                    ids = shard.all().astype("<u4")
                ends = np.cumsum(shard.lengths)
                packed = [ids[b - n : b].tobytes() for n, b in zip(shard.lengths, ends)]
                columns = [
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(start + ends - shard.lengths, pa.int64()),
                    pa.array(shard.lengths, pa.int64()),
                    pa.array([zlib.crc32(p) for p in packed], pa.int64()),
                    pa.array(packed, pa.binary()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns[: 4 + with_ids], names[: 4 + with_ids])

    return slices.mapInArrow(frugal(run), schema)
