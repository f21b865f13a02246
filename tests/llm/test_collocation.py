import random
import re
from collections import Counter

import numpy as np
import pytest

from stayline.llm import collocation
from stayline.llm.collocation import HatTrie, mine


def brute(rows, longest=5, least=3, top=2000, inside=100):
    """All n-grams in one dictionary, exact integers."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * a >= inside * f[lang, words[i : i + m]]:
                    gone.add((lang, words[i : i + m]))
    scored = {}
    for (lang, words), a in candidates.items():
        if (lang, words) in gone:
            continue
        n = total[lang]
        cuts = [(1000 * a * n // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        scored.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], n))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n, -score)
        for lang, own in scored.items()
        for rank, (score, a, p, l, r, n) in enumerate(sorted(own)[:top], 1)
    )


def found(docs, **options):
    return sorted(tuple(r) for r in mine(docs, **options).collect())


def corpus(seed, n=300):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(25)] + ["New", "York", "é", "日本", "it's", "a\x00b", " "]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for _ in range(n):
        text = r.choice(["", " ", "\t"])
        for w in r.choices(words, weights, k=r.randrange(40)):
            text += w + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! ", "\r\x0b", ";:"])
        rows.append((text + r.choice(["", "the new york times", "The New York Times."]), r.choice(["en", "en", "fr", None, "und", ""])))
    return rows + [(None, "en"), (None, None), ("the new york times " * 300, "de"), ("one two", "xx")] + [("Same copied line of text.", "fr")] * 20


@pytest.mark.parametrize("options", [{}, {"least": 1, "longest": 3}, {"longest": 2}, {"longest": 7, "top": 5}, {"inside": 60}])
def test_against_brute_force(spark, make, options):
    rows = corpus(1)
    docs = make([(i, text, lang, "s") for i, (text, lang) in enumerate(rows)])
    assert found(docs, **{"least": 3, **options}) == brute(rows, **options)


def test_spills_and_narrow_filters(spark, make, monkeypatch):
    """Subtrees that leave early and filters that let nearly all pass change nothing."""
    rows = corpus(2)
    docs = make([(i, text, lang, "s") for i, (text, lang) in enumerate(rows)])
    for name, value in (("ENTRIES", 40), ("WORDS", 12), ("LARGEST_FILTER", 64), ("PLACES", 64), ("PLACES", 1 << 12)):
        monkeypatch.setattr(collocation, name, value)
        assert found(docs, least=3) == brute(rows)


def test_empty_table(spark, make):
    assert found(make([])) == [] and found(make([(1, None, None, None), (2, "", "en", "s")])) == []


def test_products_beyond_64_bits(spark):
    """Counts of a corpus of 10^13 words."""
    a, l, r, n = 40_000_000_000, 90_000_000_000, 70_000_000_003, 10_000_000_000_000
    schema = "lang string, phrase string, a long"
    words = spark.createDataFrame([("en", "new", l), ("en", "york", r)], schema)
    pairs = spark.createDataFrame([("en", "new york", a)], schema)
    totals = spark.createDataFrame([("en", n)], "lang_ string, n long")
    rows = collocation._ranked(words, pairs, totals, 10, 100).collect()
    assert [tuple(x) for x in rows] == [("en", 1, "new york", a, l, r, n, 1000 * a * n // (l * r))]
    assert 1000 * a * n > 2**64 < l * r


@pytest.mark.parametrize("burst", [1, 3, 50, 10_000])
def test_trie(monkeypatch, burst):
    monkeypatch.setattr(collocation, "BURST", burst)
    r = np.random.default_rng(burst)
    trie, want = HatTrie(4), Counter()
    for _ in range(6):
        windows = r.integers(0, 6, (200, 4))
        windows[:, 0] += 1
        trie.add(windows)
        want.update(w.astype(">u4").tobytes() for w in windows)
        assert trie.size == len(want)
    out = Counter()
    for subtree in trie.spill(trie.size // 2):
        out.update(dict(subtree))
    assert trie.size <= len(want) // 2 + 1
    trie.add(np.array([[1, 0, 0, 0]]))
    want[np.array([1, 0, 0, 0], ">u4").tobytes()] += 1
    for subtree in trie.spill():
        out.update(dict(subtree))
    assert out == want and trie.size == 0
