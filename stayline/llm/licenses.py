"""Licence notices in texts: rare words of licence templates, looked up by position, with key phrases verified."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import Boxed, or_empty

#: Phrases that count wherever they stand, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Fixed values: (label, words of a notice, key phrases that must stand in it).
TEMPLATES = [
    ("agpl-3.0", "licensed under the GNU Affero General Public License version 3", ["affero general public license version 3"]),
    ("apache-2.0", "licensed under the Apache License version 2.0", ["apache license version 2.0"]),
    ("apache-2.0", "you may obtain a copy of the license at http www.apache.org licenses LICENSE-2.0", ["apache.org licenses license-2.0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met", ["redistribution and use in source and binary forms", "provided that the following conditions are met"]),
    ("cc-by-4.0", "licensed under CC BY 4.0", ["cc by 4.0"]),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4.0"]),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", ["cc by-nc 4.0"]),
    ("cc-by-nc-nd-4.0", "licensed under CC BY-NC-ND 4.0", ["cc by-nc-nd 4.0"]),
    ("cc-by-nc-sa-4.0", "licensed under CC BY-NC-SA 4.0", ["cc by-nc-sa 4.0"]),
    ("cc-by-nd-4.0", "licensed under CC BY-ND 4.0", ["cc by-nd 4.0"]),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", ["cc by-sa 4.0"]),
    ("cc0-1.0", "released under CC0 1.0 Universal", ["cc0 1.0"]),
    ("gpl-2.0", "licensed under the GNU General Public License version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the GNU General Public License version 3", ["gnu general public license version 3"]),
    ("gpl-or-later", "redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software "
                     "Foundation either version", ["gnu general public license as published by the free software foundation"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
            ["for any purpose with or without fee is hereby granted"]),
    ("lgpl-2.1", "licensed under the GNU Lesser General Public License version 2.1", ["lesser general public license version 2.1"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "the software to deal in the software without restriction", ["permission is hereby granted free of charge", "without restriction"]),
    ("mit", "released under the MIT License", ["mit license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the Mozilla Public License v. 2.0", ["mozilla public license v. 2.0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software released into the public domain"]),
]
#: Rarest words of a template that must all stand in their places.
ANCHORS = 3
#: Least share of a template's weight that a place must show.
LEAST_SHARE = 0.6
#: Fixed value: what words consist of, after A-Z are lower-cased.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def index(templates: list[tuple[str, str, list[str]]]) -> list[dict]:
    """Postings of the templates: the rarest word of each and where it stands, which places must agree, and weights.

    A word's weight is its inverse document frequency over the templates, in thousandths.
    """
    split = [(label, words_of(text), [words_of(p) for p in phrases]) for label, text, phrases in templates]
    found_in = Counter(w for _, words, _ in split for w in set(words))
    weight = {w: round(1000 * math.log(1 + len(split) / n)) for w, n in found_in.items()}
    out = []
    for label, words, phrases in split:
        rarest = sorted(range(len(words)), key=lambda i: (-weight[words[i]], i))[:ANCHORS]
        must = set(rarest)
        for phrase in phrases:
            at = next((i for i in range(len(words)) if words[i : i + len(phrase)] == phrase), None)
            if at is None:
                raise ValueError(f"{' '.join(phrase)!r} is not in the template of {label}")
            must |= set(range(at, at + len(phrase)))
        weights = [weight[w] for w in words]
        out.append({"label": label, "lead": words[rarest[0]], "at": rarest[0], "words": words, "weights": weights,
                    "must": sorted(must), "total": sum(weights)})
    return out


def _literal(value) -> Column:
    if isinstance(value, dict):
        return F.struct(*[_literal(v).alias(k) for k, v in value.items()])
    return F.array(*map(_literal, value)) if isinstance(value, list) else F.lit(value)


def scan(docs: DataFrame, templates: list[tuple[str, str, list[str]]] = TEMPLATES, base: dict[str, str] = BASE, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, n_base, first_word, last_word, base_labels, labels and score.

    Base: places where a base phrase's words stand one after the other; their number, the smallest and largest
    start (words from 0, null without any) and their labels.  Method: a place of a template's rarest word
    tells where the template would begin; it counts if all its anchors and key phrases stand in their places from there and
    words of at least ``LEAST_SHARE`` of its weight agree.  ``labels`` adds these templates' labels; ``score``
    is the largest such share, 0 without one.  Labels are distinct, sorted and joined by commas.

    Null and empty texts have no words and no labels; repeated rows are rated alike; an empty table stays
    empty; result columns replace equal names, whatever their case.

    Scale: every row is rated by itself in the JVM, without a shuffle, whatever keys or copies the
    table holds; the templates are a literal.  The work for a text is one pass for its words and, for each place
    of a rarest word, one look at the templates that word leads.
    """
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    box = Boxed(docs, *made)
    body = or_empty(F.col(box.name(text)).cast("string"))
    # The Kelvin sign is the one letter that lower() would turn into a word's ASCII letter.
    body = F.lower(F.replace(body, F.lit("\u212a"), F.lit("\u0138")))
    df = box.df.withColumn("words_", F.regexp_extract_all(body, F.lit(WORD), 0))

    postings = index(templates)
    phrases = [(words_of(p), label) for p, label in base.items()]
    wanted = sorted({p["lead"] for p in postings} | {words[0] for words, _ in phrases})
    word = lambda at: F.get("words_", at)
    # size() - 1 is -1 for no words; the filter then finds none.
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size("words_") - 1, F.lit(0))), lambda i: word(i).isin(wanted))
    df = df.withColumn("places_", places)

    def starts(words: list[str]) -> Column:
        follow = lambda i: [F.coalesce(word(i + k) == w, F.lit(False)) for k, w in enumerate(words)]
        return F.filter("places_", lambda i: _all(follow(i)))

    for n, (words, _) in enumerate(phrases):
        df = df.withColumn(f"base{n}_", starts(words))
    every = F.concat(*[F.col(f"base{n}_") for n in range(len(phrases))])
    own = F.array_compact(F.array(*[F.when(F.size(f"base{n}_") > 0, label) for n, (_, label) in enumerate(phrases)]))

    def agrees(i: Column, t: Column, p: Column) -> Column:
        return F.coalesce(word(i - t["at"] + p) == F.get(t["words"], p), F.lit(False))

    def share(i: Column, t: Column) -> Column:
        each = F.sequence(F.lit(0), F.size(t["words"]) - 1)
        sum_ = F.aggregate(each, F.lit(0), lambda total, p: total + F.when(agrees(i, t, p), F.get(t["weights"], p)).otherwise(0))
        return F.struct(t["label"].alias("label"), (sum_ / t["total"]).alias("share"))

    def at_place(i: Column) -> Column:
        fits = F.filter(_literal(postings), lambda t: (t["lead"] == word(i)) & F.forall(t["must"], lambda p: agrees(i, t, p)))
        return F.transform(fits, lambda t: share(i, t))

    df = df.withColumn("found_", F.filter(F.flatten(F.transform("places_", at_place)), lambda f: f["share"] >= LEAST_SHARE))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    df = df.withColumns(
        {
            "n_words": F.size("words_").cast("long"),
            "n_base": F.size(every).cast("long"),
            "first_word": F.array_min(every).cast("long"),
            "last_word": F.array_max(every).cast("long"),
            "base_labels": joined(own),
            "labels": joined(F.concat(own, F.transform("found_", lambda f: f["label"]))),
            "score": F.coalesce(F.array_max(F.transform("found_", lambda f: f["share"])), F.lit(0.0)),
        }
    )
    return box.restored(df)


def _all(conditions: list[Column]) -> Column:
    whole = conditions[0]
    for c in conditions[1:]:
        whole = whole & c
    return whole
