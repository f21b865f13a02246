import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from stayline.llm import wavelet
from stayline.llm.common import new_path
from stayline.llm.wavelet import Shard, encode_shard, read_documents, write_shards

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "\n", " a", "a ", "a  b", "\u00a0x \u00a0 y", "<|endoftext|>", "hello <|endoftext|> world", "x<|endoftext|>",
    "Don't. they'll, 1st 22nd  x\ty\r\nz", "ünï cödé, naïve!", "日本語 テスト 1２３ ½²", "a\n b \nc", "....!? ,, ;x", "e\u0301 👍🏽 \u200b\ufeff",
    "tail \x1c x\x1cy \x85 z", "a\x85 b", "\u2028x \u2028", " lead", "ends in blank ", "x\n", "\n\n x", "¼ ½x ª º µ×÷ﬁ ǅ", "y" * 500, "<|endoftext", "it's 'S 'll I'LL",
]


@pytest.mark.parametrize("n,top", [(0, 5), (1, 0), (10, 1), (300_000, 50_000), (131_072, 70_000), (1000, 3)])
def test_shard(n, top):
    r = np.random.default_rng(n)
    ids = r.integers(0, top + 1, n).astype(np.uint32)
    body = encode_shard(ids, [5, None], [n // 2, n - n // 2])
    shard = Shard(lambda at, size: body[at : at + size])
    assert (shard.all() == ids).all() and shard.doc_ids == [5, None]
    for i in r.integers(0, n, 20) if n else []:
        token = int(ids[i])
        assert shard.access(int(i)) == token and shard.count(token) == (ids == token).sum()
        before = int((ids[:i] == token).sum())
        assert shard.rank(token, int(i)) == before and shard.select(token, before) == i
    assert shard.count(10**9) == 0
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.select(0, n + 1)


def test_reads_few_blocks():
    ids = np.random.default_rng(1).integers(0, 50_000, 2_000_000).astype(np.uint32)
    body, read = encode_shard(ids, [1], [len(ids)]), []
    shard = Shard(lambda at, size: read.append(size) or body[at : at + size])
    directory = sum(read)
    assert shard.access(1_234_567) == ids[1_234_567] and sum(read) - directory < len(body) / 4


def test_wrong_file():
    with pytest.raises(ValueError):
        Shard(lambda at, size: b"x" * size)


def test_library_by_chunks(monkeypatch):
    """The same ids as an untouched tokenizer, whatever is remembered."""
    tokenizer = Tokenizer.from_file(PATH)
    for bound in (100_000, 10):
        monkeypatch.setattr(wavelet, "CHUNKS", bound)
        monkeypatch.setattr(wavelet, "PIECES", bound)
        library = wavelet._Library(PATH)
        for text in ODD * 2 + ["".join(ODD), " ".join(ODD)]:
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert library.encode(text) == np.array(ids, "<u4").tobytes(), text


def test_lines_and_marks_share_words():
    """Every line's first word and every line's end are remembered once, not as pairs; the ids stay the library's."""
    tokenizer, library = Tokenizer.from_file(PATH), wavelet._Library(PATH)
    ends, starts = [f"end{'abcdefghij'[i]}xyz.***" for i in range(10)], [f"Anf\u00e4ng{'abcdefghij'[i]}" for i in range(10)]
    text = " ".join(f"{e}\n{s}" for e in ends for s in starts)
    assert library.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(library.first) + len(library.rest) <= 21
    parts = ["a", "B", "\u00e9", "'s", "1", "-", ".", "*'", "\n", "\n\n", " ", "\t", "\u00aa", "_", "\x7f", "\x00", "\u65e5"]
    r = np.random.default_rng(5)
    for _ in range(5000):
        text = "".join(r.choice(parts, r.integers(1, 9)))
        assert library.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_batches_give_the_same(monkeypatch):
    """Texts encoded together have the ids of an untouched tokenizer; a word is handed to it once for all chunks."""
    tokenizer = Tokenizer.from_file(PATH)
    parts = ["a", "B", "\u00e9", "'s", "1", "-", ".", "*'", "\n", "\n\n", " ", " ", "\t", "\u00aa", "_", "\x7f", "\x00", "\u65e5", "<|endoftext|>"]
    r = np.random.default_rng(6)
    many = ODD * 2 + ["".join(ODD), " ".join(ODD)] + ["".join(r.choice(parts, r.integers(1, 12))) for _ in range(3000)]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in many]
    for bound in (100_000, 10):
        monkeypatch.setattr(wavelet, "CHUNKS", bound)
        monkeypatch.setattr(wavelet, "PIECES", bound)
        assert list(wavelet._Library(PATH).encode_batch(pa.array(["before", *many]).slice(1))) == want
    monkeypatch.undo()
    library, calls = wavelet._Library(PATH), []
    mapped = library._mapped
    library._mapped = lambda piece: calls.append(piece) or mapped(piece)
    rows = [" ".join(f"erthon{'abcdefghij'[i]}{m}" for i in range(10)) for m in ["", ".", ",", "###", "$$$", "*)"]]
    for _ in range(2):
        assert len(list(library.encode_batch(pa.array(["On " + t for t in rows])))) == len(rows)
    assert len(calls) == len(set(calls)) == 10 + 5 + 2 and len(library.rest) == 0


def test_other_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, tokenizer = wavelet._Library(path), Tokenizer.from_file(path)
    assert not library.plain
    for text in ODD:
        assert library.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_equal_identities_are_divided(spark, make, monkeypatch):
    """Rows without an identity do not meet in one task."""
    folder = new_path(spark, "test")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = write_shards(make([(None, f"text {i} " * 50) for i in range(400)]), PATH, folder)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.select("part").distinct().count() > 1 and read_documents(manifest, folder).count() == 400


def test_documents(spark, make, monkeypatch):
    monkeypatch.setattr(wavelet, "FILE_IDS", 3000)
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(i * 7 % 100, f"Text number {i}, it's  <|endoftext|> {i * i}.\n\n" * (i % 9)) for i in range(300)]
    rows += [(None, None), (-4, "négatif"), (500, "long " * 20000)]
    rows += [(600 + i, t) for i, t in enumerate(ODD)]
    folder = new_path(spark, "test")
    found = read_documents(write_shards(make(rows), PATH, folder), folder).orderBy("start").collect()
    tie = lambda text: xxhash.xxh64_intdigest((text or "").encode(), 42)
    signed = lambda n: n - (n >> 63 << 64)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(tie(r[1])), r[1] or ""))
    at = 0
    for (identity, text), r in zip(ordered, found, strict=True):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (identity, at, len(ids), zlib.crc32(ids.tobytes()))
        assert bytes(r["ids"]) == ids.tobytes()
        at += len(ids)
    empty = new_path(spark, "test")
    assert read_documents(write_shards(make([]), PATH, empty), empty).count() == 0
