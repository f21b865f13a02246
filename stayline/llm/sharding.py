"""Minimax contiguous partition of ordered atomic groups into shards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import Boxed, drop_path, or_empty, save

#: Hexadecimal digits of the digest that make the first index: at most 65,536 intervals.
FIRST_DIGITS = 4
#: Intervals refined in one round; each becomes 16 or 256, so a round's index stays below 300,000 rows.
REFINED = 4096
#: Rows that share one numbering bucket of a shard, about.
BUCKET_ROWS = 4096


class _Index:
    """Intervals of the ordered groups: sizes, and whether an interval still holds several groups."""

    def __init__(self, rows):
        rows = sorted(rows)
        self.prefix = [r[0] for r in rows]
        self.size = np.array([r[1] for r in rows], dtype=np.int64)
        self.coarse = np.array([r[2] for r in rows], dtype=bool)
        self.upto = np.concatenate([[0], np.cumsum(self.size)])

    def part(self, start: int, end: int) -> _Index:
        return _Index(list(zip(self.prefix, self.size, self.coarse))[start:end])

    def whole(self, start: int, capacity: int) -> int:
        """First interval after ``start`` that no longer fits, intervals being atomic."""
        return int(np.searchsorted(self.upto, self.upto[start] + capacity, side="right")) - 1

    def split(self, start: int, capacity: int) -> int:
        """As far as a shard could reach if intervals of several groups could be cut anywhere (in bytes)."""
        end = min(start + capacity, int(self.upto[-1]))
        at = min(int(np.searchsorted(self.upto, end, side="right")) - 1, len(self.size))
        if at == len(self.size) or self.upto[at] == end or self.coarse[at]:
            return end
        return max(start, int(self.upto[at]))

    def reach(self, capacity: int, shards: int, cut_inside: bool) -> list[int]:
        """Greedy check: where each shard ends at best, in bytes."""
        ends, at = [], 0
        for _ in range(shards):
            if cut_inside:
                at = self.split(at, capacity)
                ends.append(at)
            else:
                at = self.whole(at, capacity)
                ends.append(int(self.upto[at]))
        return ends

    def smallest(self, shards: int, cut_inside: bool) -> int:
        """Binary search of the smallest capacity for which the greedy check reaches the end."""
        total = int(self.upto[-1])
        low, high = -(-total // shards), total
        while low < high:
            middle = (low + high) // 2
            if self.reach(middle, shards, cut_inside)[-1] == total:
                high = middle
            else:
                low = middle + 1
        return low


def _even(index: _Index, capacity: int, shards: int) -> list[int]:
    """Cuts with no shard above ``capacity`` and each as near as can be to an equal part of the rest."""
    last = [len(index.size)]  # last[k]: the first interval from which k shards reach the end
    for _ in range(shards - 1):
        last.append(int(np.searchsorted(index.upto, index.upto[last[-1]] - capacity, side="left")))
    cuts, at = [], 0
    for left in range(shards, 1, -1):
        wanted = index.upto[at] + (index.upto[-1] - index.upto[at]) / left
        near = min(int(np.searchsorted(index.upto, wanted)), len(index.size))
        if near > at and wanted - index.upto[near - 1] <= index.upto[near] - wanted:
            near -= 1
        at = max(at, last[left - 1], min(near, index.whole(at, capacity)))
        cuts.append(at)
    return cuts


def _apart(index: _Index, shards: int) -> list[int]:
    """Cuts that give a group above the equal part a shard of its own and divide what stands beside it alike."""
    n, total = len(index.size), int(index.upto[-1])
    big = int(index.size.argmax()) if n else 0
    left, right = (index.part(0, big), index.part(big + 1, n)) if n else (index, index)
    sides = bool(len(left.size)) + bool(len(right.size))
    if not n or shards <= 1 + sides or index.size[big] * shards <= total:
        return _even(index, index.smallest(shards, False), shards)
    free, weight = shards - 1, int(left.upto[-1])
    own = round(free * weight / max(1, weight + int(right.upto[-1])))
    own = max(int(len(left.size) > 0), min(own, free - int(len(right.size) > 0)))
    before = [*_apart(left, own), big] if own else []
    after = [big + 1, *[big + 1 + c for c in _apart(right, free - own)]] if free > own else []
    return before + after


def _balanced(index: _Index, capacity: int, shards: int) -> list[int]:
    """Cuts with no shard above ``capacity``, the other shards as equal as found."""
    cuts = _apart(index, shards)
    ends = index.upto[[0, *cuts, len(index.size)]]
    return cuts if np.diff(ends).max() <= capacity else _even(index, capacity, shards)


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Capacity and cut digests for ``groups`` (``key`` hexadecimal digest, ``size``; rows of a key are one group).

    Groups are ordered by digest.  The driver only holds an index of digest intervals, at most
    65,536 plus 256 per refined interval, whatever the number of groups: taking intervals as
    atomic bounds the best capacity from above, letting them be cut anywhere bounds it from
    below.  Only intervals where a cut can fall between these bounds are read in finer
    intervals, until both bounds meet; the capacity is then exact.
    """

    def read(digits: int, within: list[str] | None):
        rows = groups
        if within is not None:
            spark = groups.sparkSession
            wanted = spark.createDataFrame([(p,) for p in within], "wanted string")
            size = len(within[0])
            rows = rows.join(wanted, F.substring("key", 1, size) == F.col("wanted"), "left_semi")
        rows = rows.groupBy(F.substring("key", 1, digits).alias("prefix")).agg(
            F.sum("size").alias("size"), (F.min("key") != F.max("key")).alias("coarse")
        )
        return [(r.prefix, r.size, r.coarse) for r in rows.toLocalIterator()]

    intervals = read(FIRST_DIGITS, None)
    if not intervals:
        return 0, []
    while True:
        index = _Index(intervals)
        total = int(index.upto[-1])
        heavy = np.flatnonzero(index.coarse & (index.size > total // (shards * 256)))
        if len(heavy):
            chosen = heavy
        else:
            high, low = index.smallest(shards, False), index.smallest(shards, True)
            if low >= high:
                break
            inside = np.zeros(len(index.size), dtype=bool)
            for first, end in zip(index.reach(low, shards, False), index.reach(high, shards, True)):
                a = max(0, int(np.searchsorted(index.upto, first, side="right")) - 1)
                inside[a : int(np.searchsorted(index.upto, end, side="left")) + 1] = True
            chosen = np.flatnonzero(inside & index.coarse)
            if not len(chosen):
                break
        chosen = chosen[np.argsort(-index.size[chosen], kind="stable")][:REFINED]
        length = min(len(index.prefix[i]) for i in chosen)
        chosen = [i for i in chosen if len(index.prefix[i]) == length]
        finer = read(length + (1 if len(chosen) > 1024 else 2), [index.prefix[i] for i in chosen])
        gone = set(chosen)
        intervals = [
            (p, int(s), bool(c))
            for i, (p, s, c) in enumerate(zip(index.prefix, index.size, index.coarse))
            if i not in gone
        ] + finer
    capacity = index.smallest(shards, False)
    cuts = _balanced(index, capacity, shards)
    return capacity, [index.prefix[c] if c < len(index.prefix) else "g" for c in cuts]


def shard_documents(docs: DataFrame, shards: int = 24, text: str = "text", identity: str = "doc_id") -> DataFrame:
    """``docs`` plus ``size text_crc32 law shard slot grown_shard``: shards of nearly equal bytes.

    Groups are the rows of equal text (null counts as the empty text: 8 bytes), ordered by digest;
    a group is never divided.  The largest shard is as small as any contiguous partition allows,
    the others are cut as near to equal parts as that capacity permits.  Slots count from 0 in
    each shard without gaps, in a fixed order.  Repeated rows and null identities get slots of
    their own, an empty table stays empty, a single huge group takes one shard of its own.
    Columns of ``docs`` with the names of the results are replaced.

    Scale: one aggregation of (digest interval, bytes) with map-side sums, a few more over the
    intervals near the cuts; then one shuffle of the numbered rows by (shard, hash bucket), so
    that no copy group and no shard lands in one task.
    """
    box = Boxed(docs, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    own, body = box.name(identity), F.encode(or_empty(F.col(box.name(text))), "UTF-8")
    rows = box.df.withColumns(
        {"digest": F.sha2(body, 256), "size": F.length(body).cast("long") + 8, "text_crc32": F.crc32(body), "law": F.lit("bytes")}
    )
    groups = rows.groupBy(F.col("digest").alias("key")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    groups, path = save(groups, "shard-groups")
    _, cuts = minimax_cuts(groups, shards)
    total = groups.agg(F.sum("n")).first()[0] or 0
    drop_path(docs.sparkSession, path)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("digest") >= cut).cast("int")
    buckets = max(1, -(-total // (shards * BUCKET_ROWS)))
    rows = rows.withColumn("shard", shard.cast("int")).withColumn(
        "cell", F.col("shard") * F.lit(buckets) + F.pmod(F.xxhash64(own, "digest"), F.lit(buckets))
    )
    counts = rows.groupBy("cell").agg(F.first("shard").alias("of"), F.count("*").alias("n"))
    run = Window.partitionBy("of").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("cell", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"))
    within = Window.partitionBy("cell").orderBy(own, "digest")
    rows = rows.withColumn("place", F.row_number().over(within) - 1).join(counts, "cell")
    rows = rows.withColumns({"slot": F.col("before") + F.col("place"), "grown_shard": F.lit(None).cast("int")})
    return box.restored(rows)
