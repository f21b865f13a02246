"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import Boxed, frugal, or_empty

#: Chunks and pre-tokens whose ids a worker remembers in each of two generations, and the longest of them.
CHUNKS, PIECES = 50_000, 200_000
LONG_CHUNK = 64
#: Rows whose results are held together, and bytes of texts that are encoded together.
BATCH_ROWS = 256
BATCH_BYTES = 1 << 22
#: The pre-token pattern of byte-level BPE, and the marks that are one pre-token where they stand together
#: behind a word: those of ASCII but the apostrophe.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A word of Latin letters and the marks behind it.
_SIMPLE = re.compile(f"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([{re.escape(MARKS)}]*)")
#: Little-endian packing of as many ids as the place in the row.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(2 * LONG_CHUNK)]
_MASK = (1 << 64) - 1
#: A blank beside other white space, where a text may not be cut into chunks.
_BESIDE = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def chunks_of(text: str) -> list[str]:
    """Parts of a text that the pre-token pattern matches alike alone and in the text.

    A text may be cut before a blank that stands between two characters that are not white space: no
    match crosses that place, none looks further back, and none of the matches that look ahead
    (white space) ends there.  All parts but the first begin with their blank.
    """
    parts = _CUT.split(text) if _BESIDE.search(text) or text[:1] == " " or text[-1:] == " " else text.split(" ")
    return parts


class PerfectHash:
    """Minimal perfect hash of byte strings by displacement: n keys to the slots 0 to n - 1.

    Keys fall into buckets; the fullest first, each bucket tries displacements until its keys hit free
    slots.  Buckets of one key take a free slot, kept as a negative displacement.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        self.buckets = n // 4 + 1
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            groups[h % self.buckets].append(i)
        self.displace, self.keys, self.values = [0] * self.buckets, [b""] * n, [-1] * n
        taken = bytearray(n)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free = None
        for b in order:
            group = groups[b]
            if not group:
                break
            if len(group) == 1:
                free = free or iter([s for s in range(n) if not taken[s]])
                slots, self.displace[b] = [next(free)], 0
                self.displace[b] = -slots[0] - 1
            else:
                d = 1
                while True:
                    slots = [self.slot(hashes[i], d) for i in group]
                    if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                        break
                    d += 1
                self.displace[b] = d
            for i, s in zip(group, slots):
                taken[s], self.keys[s], self.values[s] = 1, keys[i], i

    def slot(self, h: int, d: int) -> int:
        return (((h ^ (d * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 & _MASK) >> 24) % self.n

    def find(self, key: bytes) -> int:
        """The number of the key, or -1 if it is none of the keys."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displace[h % self.buckets]
        s = -d - 1 if d < 0 else self.slot(h, d)
        return self.values[s] if self.keys[s] == key else -1


class Vocabulary:
    """Tokens by rank, a perfect hash over them, and the pattern of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        ordered = sorted(ranks, key=ranks.__getitem__)
        self.ids = [ranks[t] for t in ordered]
        self.hash, self.pattern = PerfectHash(ordered), pattern
        self.tokens = dict(zip(self.ids, ordered))
        self.merges, self.sizes = ranks, {r: len(t) for t, r in ranks.items()}

    def rank(self, token: bytes) -> int:
        i = self.hash.find(token)
        return self.ids[i] if i >= 0 else -1

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.rank(piece)
        if whole >= 0:
            return [whole]
        return self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Merges the pair of lowest rank, the leftmost of equals, until no pair is a token.

        ``end[i]`` is the end of the token that starts at byte i (0: none starts there), ``before[i]``
        the start of the token ahead of it.  The heap holds pairs as numbers, the rank above the start; an entry
        is stale unless two tokens still make up exactly the bytes of its token.
        """
        n, rank, push, sizes = len(piece), self.merges.get, heapq.heappush, self.sizes
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            first = heapq.heappop(heap)
            i = first & 0xFFFFFFFF
            middle, stop = end[i], i + sizes[first >> 32]
            if not i < middle < stop or end[middle] != stop:
                continue
            end[middle], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i : end[stop]])) is not None:
                    push(heap, r << 32 | i)
            if (ahead := before[i]) >= 0 and (r := rank(piece[ahead:stop])) is not None:
                push(heap, r << 32 | ahead)
        ids, i = [], 0
        while i < n:
            ids.append(rank(piece[i : end[i]]))
            i = end[i]
        return ids


class Memo(dict):
    """What ``make`` gives for a string, remembered in two generations of up to ``entries`` strings of ``LONG_CHUNK`` at most.

    When the younger one is full it becomes the older one, whose entries come back as they are asked for.
    """

    def __init__(self, make: Callable[[str], bytes | None], entries: int):
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key: str) -> bytes | None:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= LONG_CHUNK:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class Uncut(Exception):
    """A chunk beside a blank begins or ends with white space, so that the text has to be cut with more care."""


def pack(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


class Spelling:
    """Ids of texts, as packed 32-bit integers, from those of their pre-tokens by ``PRE_TOKEN``.

    A subclass tells the ids of one pre-token (``_piece``) and of a chunk that is no word with marks (``_whole``),
    and which texts ``encode`` takes whole.
    """

    def __init__(self, chunks: int, pieces: int):
        self.pieces = Memo(self._piece, pieces)
        self.first = Memo(self._head, chunks // 8)
        self.rest = Memo(self._tail, chunks)
        self.known = Memo(self._known, pieces)

    def _piece(self, piece: str) -> bytes:
        raise NotImplementedError

    def _whole(self, chunk: str) -> bytes:
        raise NotImplementedError

    def _apart(self, texts: pa.Array) -> np.ndarray:
        """Which texts ``encode`` takes whole."""
        return np.zeros(len(texts), bool)

    def _known(self, part: str) -> bytes | None:
        """Ids of a simple word behind a blank, or of marks behind a word; None for other parts."""
        if not part or part[-1] in MARKS:
            return self._piece(part) if part else b""
        simple = part.isalpha() if part.isascii() else _SIMPLE.fullmatch(part)
        return self._piece(" " + part) if simple else None

    def _tail(self, chunk: str, lead: str = " ") -> bytes:
        """Ids of a chunk behind ``lead``; most are a word and marks."""
        if chunk.isascii():
            word = chunk.rstrip(MARKS)
            simple = word.isalpha()
        elif simple := _SIMPLE.fullmatch(chunk):
            word = simple[1]
        if simple:
            ids = self.pieces[lead + word]
            return ids + self.pieces[chunk[len(word) :]] if len(word) < len(chunk) else ids
        if lead and chunk[:1] == "\n":
            # Alone between two characters that are not white space, a line feed is a pre-token.
            return self.pieces["\n"] + self._tail(chunk[1:], "")
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Uncut
        return self._whole(lead + chunk)

    def _head(self, chunk: str) -> bytes:
        if not chunk or chunk[-1].isspace():
            raise Uncut
        return self._whole(chunk)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            # Lines begin chunks of their own, unless some are empty; then no chunk may begin with a line feed.
            if "\n\n" not in text:
                chunks = iter(text.replace("\n", " \n").split(" "))
            elif " \n" not in text:
                chunks = iter(text.split(" "))
            else:
                raise Uncut
            return self.first[next(chunks)] + b"".join(map(self.rest.__getitem__, chunks))
        except Uncut:
            head, *tail = chunks_of(text)
            return self._whole(head) + b"".join([self._whole(" " + c) for c in tail])

    def encode_batch(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of every text (none is null), some ``BATCH_BYTES`` of them at a time."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(texts):
            before = int(sizes[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + BATCH_BYTES, side="right")))
            if stop == start + 1:
                yield self.encode(texts[start].as_py())
            else:
                few = texts.slice(start, stop - start)
                body, ends, alone = self._together(few)
                for i, (whole, a, b) in enumerate(zip(alone, ends, ends[1:])):
                    yield self.encode(few[i].as_py()) if whole else bytes(body[a:b])
            start = stop

    def _together(self, texts: pa.Array) -> tuple[memoryview, list[int], list[bool]]:
        """Ids of the texts one after the other, where each text's begin and end, and the texts that ``encode`` has to take.

        Each distinct chunk, and each word and marks in one, is looked up once.
        """
        empty_lines = pc.match_substring(texts, "\n\n")
        lines = pc.replace_substring(texts, "\n", " \n")
        split = pc.split_pattern(pc.if_else(empty_lines, texts, lines), " ")
        beside = pc.and_(empty_lines, pc.match_substring(texts, " \n"))
        alone = self._apart(texts) | beside.to_numpy(zero_copy_only=False)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(pc.list_value_length(split).to_numpy(), out=bounds[1:])
        flat = split.flatten()
        coded = flat.dictionary_encode()
        chunks, at = coded.dictionary, coded.indices.to_numpy().copy()
        count = len(chunks)
        # Offsets that end each chunk's word as well: words stand at even places, the marks behind them at odd ones.
        sizes = pc.binary_length(pc.ascii_rtrim(chunks, MARKS)).to_numpy()
        cuts = np.empty(2 * count + 1, np.int32)
        cuts[::2] = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset : chunks.offset + count + 1]
        cuts[1::2] = cuts[:-1:2] + sizes
        parts = pa.StringArray.from_buffers(2 * count, pa.py_buffer(cuts), chunks.buffers()[2]).dictionary_encode()
        # NumPy's strings are made much faster than a list of Arrow's.
        names = parts.dictionary.to_numpy(zero_copy_only=False)
        known = pa.array(list(map(self.known.__getitem__, names)), pa.binary())
        found = known.take(parts.indices)
        simple = found.is_valid().to_numpy(zero_copy_only=False)[::2] & (sizes > 0)
        ends = np.frombuffer(found.buffers()[1], np.int32)[: 2 * count + 1 : 2].copy()
        found = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(ends), found.buffers()[2]])
        others = np.flatnonzero(~simple)
        uncut = np.zeros(count + len(others) + len(texts), bool)

        def tried(memo: Memo, names: np.ndarray, base: int) -> pa.Array:
            out = []
            for i, name in enumerate(names, base):
                try:
                    out.append(memo[name])
                except Uncut:
                    out.append(b"")
                    uncut[i] = True
            return pa.array(out, pa.binary())

        heads = np.arange(len(texts)) + count + len(others)
        rest = tried(self.rest, chunks.take(pa.array(others)).to_numpy(zero_copy_only=False), count)
        first = tried(self.first, flat.take(pa.array(bounds[:-1])).to_numpy(zero_copy_only=False), count + len(others))
        place = np.arange(count, dtype=np.int32)
        place[others] = count + np.arange(len(others))
        at = place[at]
        at[bounds[:-1]] = heads
        alone |= np.logical_or.reduceat(uncut[at], bounds[:-1])
        ids = pa.concat_arrays([found, rest, first]).take(pa.array(at))
        ends = np.frombuffer(ids.buffers()[1], np.int32)[bounds]
        return memoryview(ids.buffers()[2] or b""), ends.tolist(), alone.tolist()


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, so that few results are held."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


class Encoder(Spelling):
    """Ids by a vocabulary.  Texts under another pattern than ``PRE_TOKEN`` are cut at blanks only."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.vocabulary, self.find = vocabulary, regex.compile(vocabulary.pattern).findall
        self.plain = vocabulary.pattern == PRE_TOKEN
        super().__init__(CHUNKS, PIECES)

    def _piece(self, piece: str) -> bytes:
        return pack(self.vocabulary.encode(piece.encode("utf-8", "replace")))

    def _whole(self, chunk: str) -> bytes:
        return b"".join([self.pieces[p] for p in self.find(chunk)])

    def _apart(self, texts: pa.Array) -> np.ndarray:
        return np.full(len(texts), not self.plain)

    def encode(self, text: str) -> bytes:
        if self.plain:
            return super().encode(text)
        head, *tail = chunks_of(text)
        return self._whole(head) + b"".join([self._whole(" " + c) for c in tail])


@functools.lru_cache(maxsize=1)
def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One for all tasks of a worker process, with what it remembers."""
    return Encoder(vocabulary)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` plus ``ids`` (packed little-endian unsigned 32-bit integers) and ``n_tokens``.

    Every match of the pattern is encoded by itself: a pre-token that is in the vocabulary by one
    look-up in a minimal perfect hash, others by merging bytes with a heap.  A null text is the
    empty text and has no ids; repeated rows are encoded alike; an empty table stays empty;
    result columns replace equal names.  Scale: one pass without a shuffle; the vocabulary is
    bounded by its file.
    """
    box = Boxed(docs, "ids", "n_tokens")
    body = box.name(text)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = box.df.withColumn("whole", or_empty(F.col(body).cast("string")))
    schema = T.StructType(
        [*box.df.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    )
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("whole")
            encoded = encoder.encode_batch(batch.column(at))
            for few in _short([batch]):
                ids = list(itertools.islice(encoded, few.num_rows))
                columns = [c for i, c in enumerate(few.columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())], names
                )

    return box.restored(rows.mapInArrow(frugal(run), schema))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``rows`` plus ``decoded``: the bytes of the tokens in ``ids``; null ids are none.

    An id outside the vocabulary, or a number of bytes that is not a multiple of four, raises.
    """
    box = Boxed(rows, "decoded")
    own = box.name(ids)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([*box.df.schema.fields, T.StructField("decoded", T.BinaryType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.tokens.__getitem__
        for batch in _short(batches):
            packed = batch.column(batch.schema.get_field_index(own))
            out = [b"".join(map(token, np.frombuffer(p.as_py() or b"", dtype="<u4").tolist())) for p in packed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names)

    return box.restored(box.df.mapInArrow(frugal(run), schema))
