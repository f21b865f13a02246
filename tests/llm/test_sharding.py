import random
import zlib

import pytest

from stayline.llm.sharding import shard_documents


def best_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        used, held = 1, 0
        for s in sizes:
            if held + s > middle:
                used, held = used + 1, 0
            held += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def check(rows, found, shards):
    import hashlib

    assert len(found) == len(rows)
    by_text, by_shard = {}, {}
    for r in found:
        body = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 8, zlib.crc32(body), "bytes", None)
        by_text.setdefault(body, set()).add(r["shard"])
        by_shard.setdefault(r["shard"], []).append(r)
    assert all(len(s) == 1 for s in by_text.values())
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    groups = {}
    for r in found:
        body = (r["text"] or "").encode()
        groups[body] = groups.get(body, 0) + r["size"]
    ordered = [groups[b] for b in sorted(groups, key=lambda b: hashlib.sha256(b).hexdigest())]
    assert max(sum(r["size"] for r in own) for own in by_shard.values()) == best_capacity(ordered, shards)


@pytest.mark.parametrize("shards", [1, 4, 24])
def test_capacity_is_the_smallest(make, shards):
    r = random.Random(shards)
    rows = [(i, "x" * r.randrange(400) + str(r.randrange(300))) for i in range(700)]
    check(rows, shard_documents(make(rows), shards).collect(), shards)


def test_hot_group_takes_one_shard(make):
    rows = [(i, "copy " * 50) for i in range(300)] + [(1000 + i, f"text {i} " * (i % 30)) for i in range(600)]
    found = shard_documents(make(rows), 24).collect()
    check(rows, found, 24)
    sizes = {}
    for r in found:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    rest = sorted(sizes.values())[:-1]
    assert len(sizes) == 24 and max(rest) < 1.5 * min(rest)


def test_edges(make):
    assert shard_documents(make([]), 24).count() == 0
    rows = [(None, None), (None, ""), (1, "a"), (1, "a"), (2, "é" * 30000), (3, None)]
    found = shard_documents(make(rows), 3).collect()
    check(rows, found, 3)
    assert "a.b" in found[0].asDict() and "key" in found[0].asDict()
