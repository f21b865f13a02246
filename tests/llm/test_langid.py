import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex as re
from pyspark.sql import functions as F

from stayline.llm.langid import Model, Scorer, fit, grams_of, held_out, identify, predict, release, words_of
from stayline.llm.queries import op2_word_backoff_langid


def test_words_and_grams():
    assert words_of("It's ÉTÉ, 3 b4d_x") == ["it", "s", "été", "b", "d", "x"]
    assert grams_of("ab", 1) == ["a", "b"] and grams_of("ab", 3) == ["<ab", "ab>"] and grams_of("a", 4) == []


def test_backoff(spark):
    rows = [("xx", "abab abab abba"), ("yy", "cdcd cdcd dccd")] * 5
    model = fit(spark.createDataFrame(rows, "lang string, text string"))
    scorer = Scorer(model)
    assert scorer.score("abab")[0] == "xx" and scorer.score("cdcdcd")[0] == "yy" and scorer.score("ababb")[0] == "xx"
    assert scorer.score("123 !") == ("und", 0.0) and scorer.score("日本")[0] in ("xx", "yy")


@pytest.mark.parametrize("most", [0, 3])
def test_small_model(spark, most):
    rows = [("xx", "aa ab ac"), ("yy", "ba bb bc")] * 3
    model = fit(spark.createDataFrame(rows, "lang string, text string"), max_words=most, max_grams=100)
    assert len(model.words) <= most and Scorer(model).score("aa ab")[0] == "xx"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = op2_word_backoff_langid(spark, folder).where("held_out").join(docs, "doc_id")
    right, total = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 200 and right / total > 0.98


def test_edges(make, spark):
    rows = [(i, "the cat and dog", "en", "s") for i in range(9)] + [(20 + i, "le chat et chien", "fr", "s") for i in range(9)]
    rows += [(50, None, "en", "s"), (51, "", None, "s"), (52, "12 34", "fr", "s"), (None, "le chat", None, "s"), (53, "dog " * 30000, None, "s"), (53, "chien", None, None)]
    df = make(rows)
    found = identify(df)
    assert found.columns == [c for c in df.columns if c != "score"] + ["lang_pred", "score", "held_out"]
    got = {(r["doc_id"], r["text"]): r for r in found.collect()}
    assert [got[(i, t)]["lang_pred"] for i, t in ((50, None), (51, ""), (52, "12 34"))] == ["und"] * 3
    assert got[(None, "le chat")]["lang_pred"] == "fr" and got[(None, "le chat")]["held_out"] is False
    assert got[(53, "dog " * 30000)]["lang_pred"] == "en" and got[(53, "chien")]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert identify(make([])).count() == 0
    unlabelled = identify(make([(1, "text", None, None)])).collect()
    assert (unlabelled[0]["lang_pred"], unlabelled[0]["score"]) == ("und", 0.0)
    nothing = Model([], np.zeros(0), {}, {}, np.zeros((0, 0), dtype=np.float32))
    assert Scorer(nothing).score("abc") == ("und", 0.0)


def skewed(seed=6):
    """Seventy rare languages of near alphabets beside one that fills any table of the most frequent words."""
    import random

    r = random.Random(seed)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randrange(2, 7)))
    rows = [("aa", " ".join(word("abcdefgh") for _ in range(40))) for _ in range(400)]
    for i in range(70):
        own = [word("abcdefgh" + chr(0x100 + i)) for _ in range(30)]
        rows += [(f"m{i:02}", " ".join(r.choice(own) for _ in range(25))) for _ in range(4)]
    return rows


def test_no_word_gram_or_language_is_cut(spark):
    rows = skewed()
    train = spark.createDataFrame(rows[::2] + rows[1::4], "lang string, text string")
    asked = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)] + [(-1, None), (-2, "1 2"), (-3, "日本 zz"), (-4, rows[3][1])], "doc_id long, text string")
    whole = fit(train)
    assert whole.rest is None and len(whole.langs) == 71
    scorer = Scorer(whole)
    for most in (0, 50):
        small = fit(train, max_words=most, max_grams=most)
        assert small.rest and len(small.words) <= most and small.langs == whole.langs
        found = predict(asked, small).collect()
        release(spark, small)
        assert len(found) == len(rows) + 4
        for r in found:
            lang, score = scorer.score(r["text"] or "")
            assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-9)
    got = {r["doc_id"]: r["lang_pred"] for r in found}
    rare = [(i, lang) for i, (lang, _) in enumerate(rows) if lang != "aa"]
    assert sum(got[i] == lang for i, lang in rare) / len(rare) > 0.95


def plain_language_id(rows):
    """Word-first backoff over dictionaries: (doc_id, text, lang) to doc_id -> (held out, language, score)."""
    letters = lambda text: re.findall(r"\p{L}+", text.lower())

    def grams(word, n):
        padded = word if n == 1 else "<" + word + ">"
        return [padded[i : i + n] for i in range(len(padded) - n + 1)]

    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    taught = [(lang, letters(text)) for i, text, lang in rows if lang is not None and text is not None and not held(i)]
    langs = sorted({lang for lang, _ in taught})
    counts = {(k, lang): Counter() for k in range(5) for lang in langs}
    for lang, words in taught:
        for w in words:
            counts[0, lang][w] += 1
            for n in (1, 2, 3, 4):
                counts[n, lang].update(grams(w, n))
    known = {k: set().union(*(counts[k, lang] for lang in langs)) for k in range(5)}

    def weight(k, item, lang):
        own = counts[k, lang]
        return math.log((own[item] + 0.5) / (sum(own.values()) + 0.5 * len(known[k]) + 1))

    out = {}
    for i, text, _ in rows:
        words = letters(text or "")
        if not words or not langs:
            out[i] = (held(i), "und", 0.0)
            continue
        total = {lang: math.log(sum(x == lang for x, _ in taught) / len(taught)) for lang in langs}
        for w in words:
            items = [(0, w)] if w in known[0] else []
            for n in (4, 3, 2, 1):
                items = items or [(n, g) for g in grams(w, n) if g in known[n]]
            for lang in langs:
                total[lang] += sum(weight(k, x, lang) for k, x in items) / max(1, len(items))
        total = {lang: round(t, 6) for lang, t in total.items()}
        best = max(langs, key=lambda lang: (total[lang], -langs.index(lang)))
        out[i] = (held(i), best, 1 / sum(math.exp(t - total[best]) for t in total.values()))
    return out


@pytest.mark.parametrize("bound", [None, 4])
def test_against_plain_reference(spark, make, bound):
    """The same languages and scores as dictionaries give, whatever part of the model tasks hold."""
    r = random.Random(7)
    pieces = {"aa": ["ka", "to", "mi", "é"], "bb": ["ka", "ru", "shi", "日"], "cc": ["to", "ru", "ß", "on"]}
    rows = []
    for i in range(160):
        lang = r.choice(["aa", "aa", "aa", "bb", "cc"])
        text = " ".join("".join(r.choices(pieces[lang] + ["x"], k=r.randint(1, 3))) for _ in range(r.randrange(9)))
        rows.append((i, r.choice([text, text, text.upper(), text + " 12 ² ½ Ⅷ", None]), r.choice([lang, lang, None])))
    rows += [(500, "² ½ Ⅷ", "aa"), (501, "zzz qqq", None), (502, "", "bb"), (503, "kato " * 5000, "cc")]
    docs = make([(i, text, lang, "s") for i, text, lang in rows])
    if bound is None:
        found = identify(docs)
    else:
        model = fit(docs.where(~held_out("doc_id")).where("lang IS NOT NULL AND text IS NOT NULL"), bound, bound)
        assert model.rest is not None
        found = predict(docs, model).withColumn("held_out", held_out("doc_id"))
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in found.collect()}
    want = plain_language_id(rows)
    assert got.keys() == want.keys() and got[500][1] == "und"
    for i in want:
        assert got[i][:2] == want[i][:2] and got[i][2] == pytest.approx(want[i][2], abs=1e-4), rows[i]
