import random
import re

import numpy as np

from stayline.llm.mixing import fit_lengths, mix_sources, source_targets


def test_targets():
    assert source_targets([("a", 10), ("b", 10), (None, 10)], [1, 2, 3], 3) == {"a": 5.0, "b": 10.0, None: 15.0}
    found = source_targets([("a", 100), ("b", 100), ("c", 1)], [1, 2, 3], 3)
    assert found["c"] == 3.0 and abs(found["a"] - 66) < 1e-9 and abs(found["b"] - 132) < 1e-9
    assert source_targets([], [1], 3) == {}


def nearest(lengths, counts, target, most):
    """Distance of the sum nearest to the target, over all sums."""
    sums = {0}
    for length, n in zip(lengths, counts):
        sums = {s + k * int(length) for s in sums for k in range(most * int(n) + 1)}
    return min(abs(s - target) for s in sums)


def test_fit_matches_exhaustive_search():
    r = random.Random(3)
    for trial in range(300):
        most = r.choice([1, 2, 3])
        scale = r.choice([1, 1, 7, 1000])
        lengths = np.array(sorted(r.sample(range(0, 30), r.randrange(1, 5)))) * scale + r.choice([0, 0, 1]) * (scale > 1)
        counts = np.array([r.randrange(1, 4) for _ in lengths])
        target = r.random() * most * int((lengths * counts).sum())
        take = fit_lengths(lengths, counts, target, most)
        assert (take >= 0).all() and (take <= most * counts).all()
        assert abs(int((take * lengths).sum()) - target) <= nearest(lengths, counts, target, most) + 1e-6, (lengths, counts, target)


def test_fit_long_documents():
    """Sums beyond 65,536 words, and one document that rules its source."""
    cases = [
        ([1000, 10], [1, 2], 900, 3),
        ([70_000, 80_000, 90_000], [1, 1, 1], 160_000, 1),
        ([82_543, 96_911, 101_222, 132_864, 195_875], [1] * 5, 498_963, 1),
        ([82_543, 96_911, 101_222, 132_864, 195_875], [1] * 5, 1_111_111, 3),
        ([123_457, 654_321], [2, 1], 1_500_000.5, 3),
    ]
    for lengths, counts, target, most in cases:
        lengths, counts = np.array(lengths), np.array(counts)
        take = fit_lengths(lengths, counts, target, most)
        assert (take <= most * counts).all()
        assert abs(int((take * lengths).sum()) - target) <= nearest(lengths, counts, target, most) + 1e-6
    take = fit_lengths(np.array([10, 1000]), np.array([2, 1]), 900, 3)
    assert int((take * [10, 1000]).sum()) == 1000


def test_fit_large_budget():
    lengths, counts = np.arange(1, 20001), np.full(20000, 7)
    target = int((lengths * counts).sum() * 0.4321)
    take = fit_lengths(lengths, counts, target)
    assert int((take * lengths).sum()) == target and (take <= counts).all()


def test_fit_does_not_switch_by_size():
    """Sums that can be met are met, however long the documents; one length off the others' divisor."""
    r = np.random.default_rng(14)
    lengths = np.sort(r.choice(np.arange(1_000_000, 20_000_000), 14, replace=False))
    counts = np.ones(14, dtype=int)
    target = int((r.integers(0, 2, 14) * lengths).sum())
    take = fit_lengths(lengths, counts, target, 1)
    assert int((take * lengths).sum()) == target and (take >= 0).all() and (take <= 1).all()
    lengths = np.sort(np.append(np.arange(1, 301) * 7, 1002))
    counts = np.where(lengths == 1002, 1, 5)
    target = int(0.37 * (lengths * counts).sum()) // 7 * 7 + 6
    take = fit_lengths(lengths, counts, target)
    assert abs(int((take * lengths).sum()) - target) == 1 and (take >= 0).all() and (take <= 3 * counts).all()


def test_mix(make):
    r = random.Random(5)
    rows = [(i, " ".join(["w"] * r.randrange(1, 80)), "en", r.choice(["s1", "s2", "s2", "s3", None])) for i in range(900)]
    rows += [(5000 + i, "same length text", "en", "hot") for i in range(3000)] + [(9000, None, "en", "s1"), (9001, "", "en", "s1")]
    first = {(x["doc_id"], x["taken"]) for x in mix_sources(make(rows)).collect()}
    found = mix_sources(make(rows)).collect()
    assert {(x["doc_id"], x["taken"]) for x in found} == first and len(found) == len(rows)
    targets, taken = {}, {}
    for x in found:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", x["text"] or ""))
        assert x["size"] == words and x["taken"] == words * x["repeats"] <= 3 * words
        targets[x["source"]] = x["target"]
        taken[x["source"]] = taken.get(x["source"], 0) + x["taken"]
    assert all(abs(taken[s] - targets[s]) <= 3 for s in targets)
    assert abs(sum(targets.values()) - sum(x["size"] for x in found)) < 1e-6


def test_edges(make):
    assert mix_sources(make([])).count() == 0
    found = mix_sources(make([(None, None, None, None), (1, "", "en", "s"), (1, "", "en", "s")])).collect()
    assert [x["taken"] for x in found] == [0, 0, 0]
    same = mix_sources(make([(1, "a b c", "en", "s")] * 50 + [(2, "d " * 100000, "en", "t")])).collect()
    assert sum(x["taken"] for x in same if x["source"] == "s") > 0
