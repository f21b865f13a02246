"""The pipeline's stages against brute force on small documents, and what the whole of it must keep."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries

SYLLABLES = {"en": "the and ing tion ed er wh", "fr": "le eau é è que ent ou", "de": "der sch ung ß ein ich zu"}


def text(r, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    shared = "This notice of forty characters or more stands in many documents."
    rows = []
    for i in range(240):
        lang = r.choice(["en", "fr", "de"])
        body = text(r, lang, r.randrange(20, 90)) + ("\n" + shared if i % 4 == 0 else "")
        rows.append((i, body, lang if i % 9 else None, f"s{i % 4}" if i % 11 else None))
    words = rows[10][1].split(" ")
    rows += [(300, rows[10][1], "en", "s1"), (301, " ".join([*words[:-1], "changed"]), "en", "s1")]
    rows += [(400, None, "en", "s0"), (401, "", "en", "s0"), (402, "12 34 !", None, None), (403, shared, "en", "s0")]
    path = tmp_path_factory.mktemp("tables")
    df = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages(spark, folder):
    from test_jaccard import brute as components
    from test_line_dedup import brute as lines

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder).cache()
        if i < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        kept.append((docs.collect(), out.collect()))
        docs = out
    before, after = kept[0]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {400, 401, 402} and all(r["lang"] for r in after)
    before, after = kept[1]
    want = {i: (t, d) for i, _, d, t in lines([(r["doc_id"], r["text"]) for r in before])}
    assert {r["doc_id"]: r["text"] for r in after} == {i: t for i, (t, d) in want.items() if not d or t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = kept[2]
    want = [i for i, n, c in components([(r["doc_id"], r["text"]) for r in before], 5, 80) if n == 0 or i == c]
    assert sorted(r["doc_id"] for r in after) == sorted(want) and not {300, 301} & set(want)
    before, after = kept[3]
    sizes = {r["doc_id"]: len(r["text"].encode().split()) for r in before}
    counts = {}
    for r in after:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert max(counts.values()) <= 3
    taken = sum(sizes[i] * n for i, n in counts.items())
    assert abs(taken - sum(sizes.values())) <= 5
    before, after = kept[4]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before)
    for r in after:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(bytes(r["ids"])).hexdigest() and r["n_tokens"] == len(r["ids"]) // 4
    assert public_tokenizers.PATTERN and np.frombuffer(after[0]["ids"], "<u4").max() < 50256


def test_run_is_registered(spark, folder):
    found = queries()["pipeline"](spark, folder)
    assert found.count() > 100 and found.where(F.col("n_tokens") == 0).count() == 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_long_clean_texts_of_a_rare_language_stay(make, spark):
    r = random.Random(3)
    common = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    # Three languages of the same words; the rare one uses one half of them 0.5 to 1 nats more often.
    def body(n, more=()):
        return " ".join(r.choice(more) if more and r.random() < 0.35 else r.choice(common) for _ in range(n))

    rows = [(i, body(40), "en" if i % 5 else "fr", "s") for i in range(2000)]
    rare = [(9000 + i, body(200, common[:50]), "xx", "s") for i in range(40)]
    rows += rare[:2] + [(i, t, None, s) for i, t, _, s in rare[2:]]
    kept = {x["doc_id"]: x["lang"] for x in corpus_pipeline.identify_language(spark, make(rows, extra=False), "").collect()}
    assert all(i in kept for i, *_ in rare)


def test_nothing_learned_keeps_documents_with_letters(make, spark):
    rows = [(1, "clean text", None, "s"), (2, "été 12", None, "s"), (3, "12 34 !", None, "s"), (4, None, None, "s"), (5, "_ -", None, "s")]
    kept = {x["doc_id"]: x["lang"] for x in corpus_pipeline.identify_language(spark, make(rows, extra=False), "").collect()}
    assert kept == {1: "und", 2: "und"}
