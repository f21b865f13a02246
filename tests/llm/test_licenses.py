import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.licenses import BASE, LEAST_SHARE, TEMPLATES, index, scan, words_of

APACHE = "Licensed under the Apache License, Version 2.0."


def plain_words(text):
    """By hand: letters a-z of any case, digits, and everything beyond ASCII."""
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute(text):
    words = plain_words(text)
    starts, own, labels, score = [], set(), set(), 0.0
    for phrase, label in BASE.items():
        p = plain_words(phrase)
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        if at:
            own.add(label)
    for t in index(TEMPLATES):
        for begin in range(-len(t["words"]), len(words)):
            ok = [0 <= begin + p < len(words) and words[begin + p] == w for p, w in enumerate(t["words"])]
            share = sum(w for w, o in zip(t["weights"], ok) if o) / t["total"]
            if all(ok[p] for p in t["must"]) and share >= LEAST_SHARE:
                labels.add(t["label"])
                score = max(score, share)
    join = lambda found: ",".join(sorted(found))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), join(own), join(own | labels), score)


CASES = [
    None, "", " .,\n", "mit", APACHE, APACHE.upper(), "x" + APACHE, "apache license apache license. APACHE-LICENSE",
    "a mit license; mit-license", "GNU general_public license", "GNU gêneral public license", "gnu general public license, version 3",
    "Released under CC BY-NC 4.0 and CC BY 4.0", "worK under the MİT License", "the MIT Licenſe", "cc by", "cc by", "by cc",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including', "permission is hereby granted, free of charge, to anyone",
    "Redistribution and use in source and binary forms, with or without\n modification, are permitted provided that the following conditions are met:",
    "License: Apache License, Version 2.0", "日本 mit license 日本", "version 2.0 apache license", "mit " * 3000 + "license",
]


def test_templates():
    assert words_of("CC BY-NC 4.0") == ["cc", "by", "nc", "4", "0"]
    assert all(t["words"][t["at"]] == t["lead"] and t["at"] in t["must"] for t in index(TEMPLATES))
    with pytest.raises(ValueError):
        index([("x", "some words", ["other words"])])


@pytest.mark.parametrize("label,text,_", TEMPLATES)
def test_each_template_is_found(spark, label, text, _):
    assert label in brute("so " + text + " then")[5].split(",")


def test_against_brute_force(spark, make):
    r = random.Random(1)
    pieces = [w for _, t, _ in TEMPLATES for w in t.split()] + ["und", "mit", "License", "ünder"]
    texts = CASES + [" ".join(r.choice(pieces) for _ in range(60)) for _ in range(60)]
    for _ in range(120):
        words = r.choice(TEMPLATES)[1].split()
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = r.choice(pieces)
        if r.random() < 0.3:
            words.insert(r.randrange(len(words)), "and")
        texts.append(r.choice(["", "x y. "]) + r.choice([" ", ", ", "\n"]).join(words) + r.choice(["", " z"]))
    docs = make([(i, t) for i, t in enumerate(texts)] + [(0, None), (3, "mit")]).withColumn("LABELS", F.lit(1))
    rows = scan(docs).collect()
    assert len(rows) == len(texts) + 2
    assert sum(c.lower() == "labels" for c in rows[0].asDict()) == 1
    for row in rows:
        got = tuple(row[n] for n in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
        want = brute(row["text"])
        assert got[:6] == want[:6] and abs(got[6] - want[6]) < 1e-12, row["text"]


def test_native_and_without_shuffle(spark, make):
    plan = scan(make([(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_empty_table(spark, make):
    found = scan(make([]))
    assert found.count() == 0 and isinstance(found.schema["score"].dataType, T.DoubleType)
