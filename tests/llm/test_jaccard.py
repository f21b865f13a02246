import random

from stayline.llm import jaccard
from stayline.llm.jaccard import components, jaccard_components, jaccard_links, keep_smallest


def brute(rows, words, percent):
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    label = list(range(len(rows)))
    owners = {}
    for i, s in enumerate(sets):
        for x in s:
            owners.setdefault(x, []).append(i)
    pairs = {(a, b) for own in owners.values() for j, b in enumerate(own) for a in own[:j]}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            label[top(a)] = top(b)
    least = {}
    for i, (identity, _) in enumerate(rows):
        if identity is not None:
            least[top(i)] = min(identity, least.get(top(i), identity))
    return sorted(
        ((r[0], len(s), r[0] if not s else least.get(top(i))) for i, (r, s) in enumerate(zip(rows, sets))), key=str
    )


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def family(r, base, copies, most):
    for _ in range(copies):
        own = list(base)
        for _ in range(r.randrange(0, most + 1)):
            own[r.randrange(len(own))] = f"x{r.randrange(10**6)}"
        yield " ".join(own)


def corpus(seed):
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for n in (3, 4, 5, 9, 20, 60, 150, 400):
        for _ in range(3):
            base = [f"w{r.randrange(4000)}" for _ in range(n)]
            texts += family(r, base, 12, max(1, n // 40))
    texts += [" ".join([f"w{r.randrange(4000)}" for _ in range(30)] + passage) for _ in range(60)]
    texts += [texts[5]] * 10 + ["Upper " + texts[9].upper(), "", "one", "one two", "ONE  two"]
    r.shuffle(texts)
    return list(enumerate(texts, 100))


def test_against_brute_force(make):
    for seed, words, percent in ((1, 4, 85), (2, 5, 80)):
        rows = corpus(seed)
        assert found(jaccard_components(make(rows), words, percent)) == brute(rows, words, percent)


def test_regions_cut_into_blocks(make, monkeypatch):
    import stayline.llm.jaccard as module

    monkeypatch.setattr(module, "REGION", 4000)
    r = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = list(family(r, base, 220, 9))
    rows = list(enumerate(texts, 1))
    assert found(jaccard_components(make(rows))) == brute(rows, 4, 85)


def test_voronoi_cells_lose_no_link():
    import numpy as np

    from stayline.llm.jaccard import _Region

    r = np.random.default_rng(4)
    sets = []
    for _ in range(25):
        base = r.choice(10**6, 200, replace=False)
        for _ in range(12):
            own = base.copy()
            own[r.choice(200, int(r.integers(0, 40)), replace=False)] = r.choice(10**6, 1)[0] + np.arange(1)
            sets.append(np.unique(own).astype(np.uint64))
    region = _Region(sets, np.arange(len(sets)), 85)
    region.join(np.arange(len(sets)))
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    for a in range(len(sets)):
        for b in range(a):
            assert (label[a] == label[b]) == (region.label[a] == region.label[b])


def test_edges(make):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "a b c d e f"),
            (4, "a b c d e f"), (4, "z " * 30000), (5, "z " * 29000), (6, "A B C D E F"), (None, "q r s t u"), (7, "nbsp x y z w")]
    assert found(jaccard_components(make(rows))) == brute(rows, 4, 85)
    assert jaccard_components(make([])).count() == 0


def test_keep_smallest(make):
    rows = corpus(3)
    want = {i for i, n, c in brute(rows, 5, 80) if n == 0 or i == c}
    df = make(rows)
    kept = keep_smallest(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    odd = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (None, "z y x w v"), (None, "z y x w v"), (2, ""), (2, "")]
    assert sorted(((r[0], r[1]) for r in keep_smallest(make(odd)).select("doc_id", "text").collect()), key=str) == sorted(
        [(1, "a b c d e f"), (None, "z y x w v"), (2, ""), (2, "")], key=str
    )


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 95), (7, 7)] + [(200, x) for x in range(300, 400)]
    got = {r["v"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 90, 90: 90, 95: 90, 200: 200, **{x: 200 for x in range(300, 400)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def all_links(rows, words, percent):
    """Links between distinct sets as (smallest identities, common, united), and every row's number of links."""
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append(frozenset(b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    least = {}
    for (identity, _), s in zip(rows, sets):
        least[s] = min(identity, least.get(s, identity))
    kinds, near, links = [s for s in least if s], {s: [s] for s in least}, []
    for j, a in enumerate(kinds):
        for b in kinds[:j]:
            common = len(a & b)
            if common and 100 * common >= percent * len(a | b):
                links.append((*sorted((least[a], least[b])), common, len(a | b)))
                near[a].append(b)
                near[b].append(a)
    rows_of = {s: sets.count(s) for s in least}
    return sorted(links), sorted((i, sum(rows_of[x] for x in near[s]) - 1 if s else 0) for (i, _), s in zip(rows, sets))


def test_every_link_once(make, monkeypatch):
    import stayline.llm.jaccard as module

    r = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    large = list(enumerate(family(r, base, 200, 9), 1))
    twice = [*corpus(4), *[(i, f"{t}") for i, t in corpus(4)[:20]], (900, "one two"), (900, "one two")]
    for rows, words, percent, region in ((twice, 4, 85, None), (corpus(5), 5, 80, 3000), (large, 4, 85, None), (large, 4, 85, 4000)):
        if region:
            monkeypatch.setattr(module, "REGION", region)
        links, counts = all_links(rows, words, percent)
        got = [(*sorted((x["class_a"], x["class_b"])), x["common"], x["united"]) for x in jaccard_links(make(rows), words, percent).collect()]
        assert sorted(got) == links and len(links) > 100
        assert sorted((x["doc_id"], x["n_links"]) for x in jaccard_components(make(rows), words, percent).collect()) == counts
        monkeypatch.undo()
    assert jaccard_links(make([])).count() == 0


def test_repeated_rows_do_not_multiply(spark, make, monkeypatch):
    """A row that stands K times has one set and one distance, not K and K squared."""
    kept = {}
    whole = jaccard.save

    def keep(df, label):
        kept[label] = whole(df, label)
        return kept[label]

    monkeypatch.setattr(jaccard, "save", keep)
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(1, a)] * 40 + [(2, a + " end")] * 40
    monkeypatch.setattr(jaccard, "drop_path", lambda spark, path: None)
    found = jaccard_components(make(rows), words=4, percent=85).collect()
    assert {(r["doc_id"], r["component_id"], r["n_links"]) for r in found} == {(1, 1, 79), (2, 1, 79)} and len(found) == 80
    assert kept["jaccard-sets"][0].count() == 2 and kept["jaccard-distances"][0].count() == 1


def test_what_is_shuffled(spark, make, monkeypatch):
    """Signatures that nobody shares are shuffled once, and texts once for the sets and once for the result."""
    plans, whole, threshold = {}, jaccard.save, "spark.sql.autoBroadcastJoinThreshold"
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def keep(df, label):
        plans[label] = plan(df)
        return whole(df, label)

    monkeypatch.setattr(jaccard, "save", keep)
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        plans["kept"] = plan(keep_smallest(make(corpus(6)[:80]), 5, 80))
    finally:
        spark.conf.set(threshold, before)
    assert "Generate" not in plans["jaccard-regions"] and "MapInArrow" in plans["jaccard-regions"]
    for label in ("jaccard-sets", "kept"):
        assert "Exchange" not in plans[label][: plans[label].index("SortMergeJoin")], label


def test_no_spare_signatures_and_no_lost_partner():
    import numpy as np

    r = np.random.default_rng(7)
    parts, least, sets = jaccard.Parts(80), 0, 0
    for n in [40, 100, 300, 300, 300, 1000, 1000, 1000]:
        shingles = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        own, signs = parts.klass(len(shingles)), parts.signatures(shingles)
        # Few sets have so many empty parts that they need a second seed.
        least, sets = least + (len(signs) == sum(parts.parts(k)[0] + 1 for k in (own, own - 1))), sets + 1
        for cut in range(n // 5 + 1):
            partner = np.union1d(shingles[cut:], r.integers(0, 1 << 63, int(r.integers(0, n // 5))).astype(np.uint64))
            common = len(np.intersect1d(shingles, partner))
            if 0 < cut and 100 * common >= 80 * (len(shingles) + len(partner) - common):
                assert len(np.intersect1d(signs, parts.signatures(partner)))
    assert least >= sets - 2


def test_small_filters_lose_no_link(make, monkeypatch):
    monkeypatch.setattr(jaccard, "LARGEST_FILTER", 64)
    rows = corpus(7)
    assert found(jaccard_components(make(rows), 4, 85)) == brute(rows, 4, 85)
