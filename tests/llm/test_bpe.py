import base64
import copy
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from stayline.llm import bpe
from stayline.llm.bpe import Encoder, PerfectHash, Vocabulary, chunks_of, decode, encode

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LETTERS = ["a", "b", " ", " ", "  ", "\n", "\t", "é", "日本", "1", "２", "³", "ⅷ", "　", "\x1c", "\x85", "\xa0", "​", "😀", "'s", "'LL", "the", " The", "!.", "$"]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(1)
    out = ["".join(r.choice(LETTERS) for _ in range(r.randrange(0, 25))) for _ in range(4000)]
    return [*out, "", " ", "x" * 20000, "ab " * 20000, "<|endoftext|> a", "\n" * 500 + "a"]


def test_perfect_hash():
    keys = [b"key%d" % i for i in range(5000)] + [b""]
    table = PerfectHash(keys)
    assert sorted(table.values) == list(range(len(keys)))
    assert [table.find(k) for k in keys] == list(range(len(keys)))
    assert table.find(b"other") == -1 and PerfectHash([]).find(b"x") == -1


def test_chunks_are_whole():
    assert all("".join([c[0], *[" " + x for x in c[1:]]]) == t for t in texts() for c in [chunks_of(t)])


def test_same_ids_as_the_library(vocabulary, library):
    encoder = Encoder(vocabulary)
    for text in texts():
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_batches_give_the_same(monkeypatch, vocabulary, library):
    """Texts encoded together, whatever is remembered, however they are divided and wherever the column begins."""
    many = [*texts(), *(f"{a}\n{b}.*** {a}--" for a in ["the", "Çé", "日", "x1"] for b in ["Ab", "'s", "é9", "\u00a0"]), "\n\n", "a\n\nb", "a \n\n b"]
    want = [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in many]
    column = pa.array(["before", *many]).slice(1)
    for bound, size in ((1000, 1 << 20), (10, 5000), (100_000, 1)):
        monkeypatch.setattr(bpe, "PIECES", bound)
        monkeypatch.setattr(bpe, "CHUNKS", bound)
        monkeypatch.setattr(bpe, "BATCH_BYTES", size)
        assert list(Encoder(vocabulary).encode_batch(column)) == want
    assert list(Encoder(vocabulary).encode_batch(pa.array([], pa.string()))) == []
    other = copy.copy(vocabulary)
    other.pattern = r"\p{L}+|\s?[^\p{L}]"
    assert list(Encoder(other).encode_batch(column)) == [Encoder(other).encode(t) for t in many]


def test_words_are_merged_once(monkeypatch, vocabulary, library):
    """A word's ids serve wherever it stands: before any marks, in any text of a batch; chunks are not remembered for it."""
    words, calls = [f"erthonwh{'abcdefghij'[i]}xyz" for i in range(10)], []
    monkeypatch.setattr(vocabulary, "merge", lambda piece: calls.append(piece) or Vocabulary.merge(vocabulary, piece))
    encoder = Encoder(vocabulary)
    rows = [" ".join(["On", *(w + m for w in words), "."]) for m in ["", ".", ",", "###", "$$$", "*)", "?", "!!"]]
    for _ in range(2):
        found = list(encoder.encode_batch(pa.array(rows)))
        assert found == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in rows]
    assert len(calls) == len(set(calls)) and sum(w.encode() in c for w in words for c in calls) == len(words)
    assert len(encoder.rest) + len(encoder.first) <= 2


def test_heap_alone_gives_the_same(vocabulary):
    for token in list(vocabulary.tokens.values())[:3000]:
        assert vocabulary.merge(token) == [vocabulary.rank(token)]


def test_round_trip(make, vocabulary, library):
    rows = [(1, "Ça va, monde?\n\n  Oui "), (None, None), (2, ""), (2, ""), (3, "word " * 50000), (4, "日本語😀")]
    found = decode(encode(make(rows), vocabulary), vocabulary)
    for r in found.collect():
        text = r["text"] or ""
        assert bytes(r["decoded"]).decode() == text and r["n_tokens"] == len(library.encode_ordinary(text))
    assert encode(make([]), vocabulary).count() == 0


def test_query(spark, library):
    from stayline.llm.queries import op6_byte_bpe

    folder = "/root/testdata/sf0.001"
    whole = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op6_byte_bpe(spark, folder).collect():
        ids = np.array(library.encode_ordinary(whole[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(whole[r["doc_id"]].encode()).hexdigest()
