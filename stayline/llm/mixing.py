"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import bisect
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import WORD, Boxed, save

#: Lengths that the first trial of a fit may change.
FIRST = 8
#: Rows of one length class that are ranked together, about.
BUCKET_ROWS = 1024
MOST_BUCKETS = 1 << 16


def source_targets(totals: list[tuple[str | None, int]], weights: list[float], most: float) -> dict[str | None, float]:
    """Targets that share the sum of all sizes by weight; none above ``most`` times its source's size.

    Sources stand in code point order, null last, and take the weights in turn.  What a capped
    source cannot take is shared among the others by weight until none is above its cap.
    """
    totals = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(totals)}
    size = dict(totals)
    rest, target = float(sum(size.values())), {}
    free = [s for s, _ in totals]
    while free:
        unit = rest / sum(weight[s] for s in free)
        capped = [s for s in free if unit * weight[s] > most * size[s]]
        if not capped:
            target.update({s: unit * weight[s] for s in free})
            break
        for s in capped:
            target[s] = float(most * size[s])
            rest -= target[s]
        free = [s for s in free if s not in target]
    return target


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, target: float, most: int = 3) -> np.ndarray:
    """How often to take documents of each length, repeats counted, so that no other sum of words is nearer to ``target``.

    No length is taken more than ``most`` times its count; length 0 has whole epochs only.  Every length first
    gives its share of the target, rounded down, and those that lost most by rounding give one more each while
    it fits.  Fewer and more takes then close the rest by subset sums (``_nearest``): first of the shortest lengths
    within one take, then of more lengths and wider, until a sum meets the target or all lengths are free, whose
    nearest sum counts (the smaller on ties).  Sums are counted in units of the lengths' common divisor.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    whole = int((lengths * counts).sum())
    if target <= 0 or whole == 0:
        return np.zeros(len(lengths), dtype=np.int64)
    share = min(target / whole, float(most))
    limit = counts * most
    take = np.minimum(np.floor(counts * share).astype(np.int64), limit)
    take[lengths == 0] = (counts * int(share))[lengths == 0]
    used = np.flatnonzero(lengths > 0)
    used = used[np.argsort(lengths[used], kind="stable")]
    size = lengths // int(np.gcd.reduce(lengths[used]))
    wanted = min(target, float(most * whole)) / (int(lengths[used[0]]) // int(size[used[0]]))
    rest = wanted - int((take * size).sum())
    for i in used[np.lexsort((size[used], -(counts * share - take)[used]))]:
        if take[i] < limit[i] and size[i] <= rest:
            take[i] += 1
            rest -= int(size[i])
    window, wide, hit = 1, rest < 0.5, int(np.ceil(rest - 0.5))
    while not wide:
        less, more = np.minimum(take, window)[used], np.minimum(limit - take, window)[used]
        wide = bool(((less == take[used]) & (more == (limit - take)[used])).all())
        inside = FIRST
        while True:
            last = inside >= len(used)
            # What cannot meet the target, by its sum or its common divisor, is tried only if it is the last trial.
            some = size[used[:inside]]
            able = (more[:inside] * some).sum() >= hit and hit % int(np.gcd.reduce(some)) == 0
            if able or (wide and last):
                change, met = _nearest(some, less[:inside], more[:inside], rest)
                if met or (wide and last):
                    take[used[:inside]] += change
                    return take
            if last:
                break
            inside *= 2
        window *= 4
    return take


def _nearest(size: np.ndarray, less: np.ndarray, more: np.ndarray, rest: float) -> tuple[np.ndarray, bool]:
    """Changes between ``-less`` and ``more`` takes of rising sizes, their sum nearest to ``rest``; whether none could be nearer.

    Balanced subset sums: from the present takes, one take is added while the sum is not above the goal, and one removed while
    it is, so that every sum stays within the longest size of the goal.  Any better choice of takes can be made in that
    order: if only the other kind of step is left, the sum already stands nearer than where it leads.  Steps of a
    kind go through the sizes in rising order.  For each sum ``spent`` holds the least place in the row of all removable
    takes from which the next may come; as fewer added sizes come first, a sum that is reached again counts only if it
    spends less.  Memory is in proportion to the longest size, time at most to sizes times the longest one.
    """
    goal, hit, longest = int(np.floor(rest)), int(np.ceil(rest - 0.5)), int(size[-1])
    base = max(0, longest - goal - 1)
    takes = np.flatnonzero(less)
    ends = np.cumsum(less[takes])
    starts = ends - less[takes]
    never = int(less.sum()) + 1
    spent = np.full(base + goal + longest + 1, never, dtype=np.int32 if never < 1 << 31 else np.int64)
    node = np.full(len(spent), -1, dtype=np.int64)
    spent[base], node[base] = 0, 0
    goal, hit, top = goal + base, hit + base, len(spent) - 1
    due, before, queue, waiting = np.zeros(len(spent), dtype=bool), np.empty_like(spent), [], set()
    steps, firsts, made = [], [], 1

    def reach(to, at, cost, step):
        """Writes the steps that spend less; returns where they lead to, and notes what sums above the goal spent before."""
        nonlocal made
        better = cost < spent[to]
        if not better.any():
            return to[:0]
        to, cost = to[better], cost[better]
        steps.append((node[at] if np.isscalar(at) else node[at[better]], step if np.isscalar(step) else step[better]))
        firsts.append(made)
        over = to[to > goal]
        over = over[~due[over]]
        due[over], before[over] = True, spent[over]
        for block in np.unique((top - over) // size[takes[0]]).tolist() if len(over) and len(takes) else []:
            if block not in waiting:
                waiting.add(block)
                heapq.heappush(queue, block)
        spent[to], node[to] = cost, np.arange(made, made + len(to))
        made += len(to)
        return to[to <= goal]

    def removed():
        """Sums not above the goal that removals from the noted sums reach, from the highest down.

        Sums that differ by less than the shortest size do not lead to each other, so a block of them goes together.
        """
        under = []
        while queue:
            block = heapq.heappop(queue)
            waiting.discard(block)
            high = top - block * size[takes[0]] + 1
            low = max(goal + 1, high - size[takes[0]])
            at = low + np.flatnonzero(due[low:high])
            due[at] = False
            if len(at) < len(takes):
                for sum_, a, z in zip(at.tolist(), np.searchsorted(ends, spent[at], "right"), np.searchsorted(starts, before[at])):
                    if a < z:
                        cost = np.maximum(starts[a:z], spent[sum_]) + 1
                        under.append(reach(sum_ - size[takes[a:z]], sum_, cost, -1 - takes[a:z]))
            else:
                for j, start, end in zip(takes.tolist(), starts, ends):
                    can = at[(spent[at] < end) & (before[at] > start)]
                    under.append(reach(can - size[j], can, np.maximum(spent[can], start) + 1, -1 - j))
        return np.concatenate(under) if under else np.zeros(0, dtype=np.int64)

    for i in range(len(size)):
        front = np.flatnonzero(spent[: goal + 1] < never)
        for _ in range(int(more[i])):
            under = reach(front + size[i], front, spent[front], 1 + i)
            front = np.union1d(under, removed())
            if node[hit] >= 0 or not len(front):
                break
        if node[hit] >= 0:
            break
    sums = np.flatnonzero(node >= 0)
    best = sums[np.argmin(np.abs(sums - base - rest))]
    change, at = np.zeros(len(size), dtype=np.int64), int(node[best])
    while at:
        batch = bisect.bisect_right(firsts, at) - 1
        parents, step = steps[batch]
        place = at - firsts[batch]
        step = int(step if np.isscalar(step) else step[place])
        change[abs(step) - 1] += 1 if step > 0 else -1
        at = int(parents if np.isscalar(parents) else parents[place])
    return change, bool(best == hit)


def _fit_source(most: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        takes = fit_lengths(rows["size"].to_numpy(), rows["n"].to_numpy(), float(rows["target"].iloc[0]), most)
        rows["epochs"], rows["taken_docs"] = takes // rows["n"].to_numpy(), takes % rows["n"].to_numpy()
        return rows

    return fit


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    most: int = 3,
    seed: int = 17,
    text: str = "text",
    source: str = "source",
    identity: str = "doc_id",
) -> DataFrame:
    """``docs`` plus ``size source_size target repeats taken``.

    ``size`` is the number of words (null text: 0); a document is taken ``repeats`` times, 0 to
    ``most``, ``taken`` words in all.  A source's target is fitted by length (``fit_lengths``); all documents of a
    length are taken as often as the takes go round, and the further ones are chosen by a seeded hash of
    identity and text.  A null source is a source of its own, an empty table stays empty, documents without
    words are taken in whole epochs only, equal rows count one by one.  Result columns replace equal names.

    Scale: words are counted where the text lies.  A source's histogram has at most one row per
    distinct length, so at most about the square root of twice its words; the driver sees one row
    per source.  The choice ranks documents inside hash buckets of a length class, so a length
    that a third of all rows share is spread over many tasks.
    """
    spark = docs.sparkSession
    box = Boxed(docs, "size", "source_size", "target", "repeats", "taken")
    body, name = box.name(text), box.name(source)
    sized = box.df.withColumns(
        {"size": F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("long"), "origin": F.col(name).cast("string")}
    )
    hist, _ = save(sized.groupBy("origin", "size").agg(F.count("*").alias("n")), "mix-lengths")
    totals = [(r[0], r[1]) for r in hist.groupBy("origin").agg(F.sum(F.col("size") * F.col("n"))).collect()]
    targets = source_targets(totals, list(weights), most)
    plan = spark.createDataFrame(
        [(s, int(n), float(targets[s])) for s, n in totals], "of string, source_size long, target double"
    )
    hist = hist.join(plan, F.col("origin").eqNullSafe(F.col("of"))).drop("of")
    schema = "origin string, size long, n long, source_size long, target double, epochs int, taken_docs long"
    fitted, _ = save(hist.groupBy("origin").applyInPandas(_fit_source(most), schema), "mix-plan")
    classes = fitted.select(
        F.col("origin").alias("c_origin"),
        F.col("size").alias("c_size"),
        "source_size",
        "target",
        "epochs",
        "taken_docs",
        F.least(F.ceil(F.col("n") / BUCKET_ROWS), F.lit(MOST_BUCKETS)).alias("buckets"),
    )
    same = F.col("origin").eqNullSafe(F.col("c_origin")) & (F.col("size") == F.col("c_size"))
    rows = sized.withColumn("draw", F.xxhash64(F.lit(seed), box.name(identity), body)).join(classes, same)
    rows = rows.withColumn("bucket", F.pmod("draw", "buckets")).withColumn(
        "cell", F.xxhash64("c_origin", "c_size", "bucket")
    )
    cells = rows.groupBy("cell", "c_origin", "c_size", "bucket").agg(F.count("*").alias("n"))
    run = Window.partitionBy("c_origin", "c_size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("cell").alias("of"),
        F.col("c_origin").alias("b_origin"),
        F.col("c_size").alias("b_size"),
        F.col("bucket").alias("b_bucket"),
        F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"),
    )
    within = Window.partitionBy("cell", "c_origin", "c_size", "bucket").orderBy("draw", box.name(identity))
    here = (
        (F.col("cell") == F.col("of"))
        & F.col("c_origin").eqNullSafe(F.col("b_origin"))
        & (F.col("c_size") == F.col("b_size"))
        & (F.col("bucket") == F.col("b_bucket"))
    )
    rows = rows.repartition(F.col("cell")).withColumn("place", F.row_number().over(within)).join(cells, here)
    chosen = F.col("before") + F.col("place") <= F.col("taken_docs")
    rows = rows.withColumn("repeats", (F.col("epochs") + chosen.cast("int")).cast("int"))
    return box.restored(rows.withColumn("taken", F.col("size") * F.col("repeats")))
