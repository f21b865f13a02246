"""Jaccard metric-space join: pivots, windows from the triangle inequality, regions joined exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import WORD, Boxed, Filter, WordHashes, drop_path, frugal, or_empty, save, tidy

#: Set digests that a task remembers; then it starts anew.
SEEN = 1 << 20
#: Shingles of a region that one task holds; larger regions are cut into blocks.
REGION = 2_000_000
#: Members of a region that are compared without choosing pivots among them.
LEAF = 64
#: Hash seeds tried before documents with too many empty parts meet in one bucket.
SEEDS = 32
#: Bits of a filter for each value that it lets pass, and its largest size (16 MB), beyond which it only passes more.
FILTER_BITS = 16
LARGEST_FILTER = 1 << 27

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[0]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, words: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words are one shingle, none the empty set."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    size = min(words, len(hashes))
    total = np.full(len(hashes) - size + 1, size if size < words else 0, dtype=np.uint64)
    for i in range(size):
        total = total * _ODD[4] + hashes[i : len(hashes) - size + 1 + i]
    return np.unique(_mixed(total))


class Parts:
    """Signatures that two sets share if their Jaccard similarity is at least ``percent``.

    Let x be the smaller set.  Its size class has an upper size U, and the partner stands in the
    same class or the next.  The two differ in at most K = U (100 - percent) / percent shingles.
    Shingles are dealt by hash to K + 1 + E parts, so at least E + 1 parts are equal.  The
    signature of a part is its class, number and content; empty parts have none.  A set with e <= E
    empty parts emits its first K + 1 parts with content and leaves out the last E - e; one with more
    emits all, and those under the next seed, and so on; after the last seed it emits one common
    signature.  At the first seed where either set stops, at least E + 1 - e equal parts have
    content, e being the smaller number of empty ones.  The first of these has at least E - e others
    above it, so neither set leaves it out.  So no pair is lost, whatever the data.
    """

    def __init__(self, percent: int):
        self.percent, self.upper = percent, [1]

    def klass(self, n: int) -> int:
        while self.upper[-1] < n:
            u = self.upper[-1]
            self.upper.append(max(u + 1, u * 100 // self.percent))
        return int(np.searchsorted(self.upper, n))

    def parts(self, klass: int) -> tuple[int, int, int]:
        differ = (100 - self.percent) * self.upper[klass] // self.percent
        least = self.upper[klass - 1] + 1 if klass else 1
        empty = (differ + 1) * math.exp(-least / (differ + 1))
        spare = math.ceil(empty + 3 * math.sqrt(empty)) if differ else 0
        return differ, differ + 1 + spare, spare

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        out, own = [], self.klass(len(shingles))
        for klass in (own, own - 1):
            if klass < 0:
                continue
            differ, parts, spare = self.parts(klass)
            if differ == 0:
                continue  # partners are equal sets, which are found as copies
            for seed in range(SEEDS):
                salt = _mixed(np.array([(klass << 8) + seed + 1], dtype=np.uint64))[0]
                mixed = _mixed(shingles ^ salt)
                part = ((mixed >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                order = np.argsort(part, kind="stable")
                part = part[order]
                starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                content = np.add.reduceat(mixed[order] * _ODD[1], starts)
                signs = _mixed(content + (part[starts] + salt) * _ODD[2])
                if parts - len(starts) <= spare:
                    out.append(signs[: differ + 1])
                    break
                out.append(signs)
            else:
                out.append(_mixed(np.array([klass], dtype=np.uint64) * _ODD[2]))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _described(words: int, percent: int):
    """(row, id, text key, text) to (row, id, text key, n, two halves of the set's digest, signatures)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, seen = WordHashes(), Parts(percent), set()
        for batch in batches:
            n, first, second, signs = [], [], [], []
            for text in batch.column(3).cast(pa.binary()):
                shingles = shingle_set(text.as_py(), words, known)
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                n.append(len(shingles))
                first.append(int.from_bytes(digest[:8], "little", signed=True))
                second.append(int.from_bytes(digest[8:], "little", signed=True))
                if digest in seen or not len(shingles):
                    signs.append(np.zeros(0, dtype=np.int64))
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(digest)
                signs.append(parts.signatures(shingles).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in signs])]).astype(np.int32)
            values = np.concatenate(signs) if signs else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(n, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                ["row", "id", "key", "n", "digest1", "digest2", "signs"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), words, known).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["row", "shingles"])

    return run


def _filter(hashes: DataFrame) -> Filter:
    """Lets pass every value of the one long column, and few others."""
    return Filter.of(hashes, min(LARGEST_FILTER, 1 << max(10, (hashes.count() * FILTER_BITS).bit_length())))


def _shared_signs(passing):
    """(row, signatures) to (row, signature) for those that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = batch.column(1).flatten()
            keep = passing.value.passes(signs.to_numpy().view(np.uint64))
            rows = np.repeat(batch.column(0).to_numpy(), pc.list_value_length(batch.column(1)).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(rows[keep], pa.int64()), signs.filter(pa.array(keep))], ["row", "sign"])

    return run


def _wanted_texts(passing):
    """Rows (id, key, text) whose key passes the filter; a task leaves out what repeats id and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            batch = batch.filter(pa.array(passing.value.passes(batch.column(1).to_numpy().view(np.uint64))))
            first = []
            for at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                first.append(at not in seen)
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(at)
            yield batch.filter(pa.array(first, pa.bool_()))

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def _array(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64) if value.is_valid else np.zeros(0, dtype=np.uint64)


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pivot, member, pivot's set, member's set) to (pivot, member, sizes, shingles in common)."""
    for batch in batches:
        a, b = [_array(x) for x in batch.column(2)], [_array(x) for x in batch.column(3)]
        counts = [[len(x) for x in a], [len(x) for x in b], [_common(x, y) for x, y in zip(a, b)]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in counts]],
            ["pivot", "member", "pivot_n", "member_n", "common"],
        )


class _Region:
    """Members of a region in memory: finds links between members of different classes."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, percent: int):
        self.sizes, self.percent = np.array([len(s) for s in sets], dtype=np.int64), percent
        self.label = labels.copy()
        self.links: list[tuple[int, int]] = []
        terms = np.unique(np.concatenate(sets), return_inverse=True)[1]
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.terms = terms
        order = np.argsort(terms, kind="stable")
        self.owners = owners[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(terms))])

    def common(self, one: int) -> np.ndarray:
        """Shingles that a member shares with each member."""
        terms = self.terms[self.begin[one] : self.begin[one + 1]]
        lengths = self.at[terms + 1] - self.at[terms]
        ends = np.cumsum(lengths)
        flat = np.arange(int(ends[-1])) - np.repeat(ends - lengths, lengths) + np.repeat(self.at[terms], lengths)
        return np.bincount(self.owners[flat], minlength=len(self.sizes))

    def compare(self, one: int, others: np.ndarray) -> np.ndarray:
        """Distances of ``others`` to a member; those that link join its class."""
        common = self.common(one)[others]
        union = self.sizes[one] + self.sizes[others] - common
        for i in others[100 * common >= self.percent * union]:
            if self.label[i] != self.label[one]:
                self.links.append((one, int(i)))
                self.label[self.label == self.label[i]] = self.label[one]
        return 1 - common / union

    def join(self, members: np.ndarray, depth: int = 0) -> None:
        if len(members) < 2 or len(np.unique(self.label[members])) == 1:
            return
        window = 2 * (1 - self.percent / 100) + 1e-9
        if len(members) > LEAF and depth < 6:
            pivots = members[:: max(1, len(members) // 12)][:12]
            away = np.stack([self.compare(int(p), members) for p in pivots], axis=1)
            home = away.argmin(axis=1)
            nearest = away[np.arange(len(members)), home]
            cells = [
                members[(home == j) | (away[:, j] <= nearest + window)] for j in range(len(pivots)) if (home == j).any()
            ]
            if max(map(len, cells)) <= 0.75 * len(members):
                for cell in cells:
                    self.join(cell, depth + 1)
                return
        classes, sizes = np.unique(self.label[members], return_counts=True)
        largest = classes[sizes.argmax()]
        for one in members[self.label[members] != largest]:
            self.compare(int(one), members[self.label[members] != self.label[one]])


    def neighbours(self, core: np.ndarray, members: np.ndarray, depth: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each of ``core``, once: itself, all other ``members`` that link with it, the shingles in common.

        A member's links all stand in the cell of its nearest pivot, to which the window replicates them.
        """
        if not len(core):
            return
        window = 2 * (1 - self.percent / 100) + 1e-9
        if len(members) > LEAF and depth < 6:
            pivots = members[:: max(1, len(members) // 12)][:12]
            common = np.stack([self.common(int(p))[members] for p in pivots], axis=1)
            away = 1 - common / (self.sizes[pivots][None, :] + self.sizes[members][:, None] - common)
            home = away.argmin(axis=1)
            near = away <= away[np.arange(len(members)), home][:, None] + window
            if near.sum(axis=0).max() <= 0.75 * len(members):
                own = np.isin(members, core)
                for j in range(len(pivots)):
                    yield from self.neighbours(members[own & (home == j)], members[near[:, j]], depth + 1)
                return
        for one in core.tolist():
            common = self.common(one)[members]
            hit = (100 * common >= self.percent * (self.sizes[one] + self.sizes[members] - common)) & (members != one)
            yield one, members[hit], common[hit]


def _whole_cell(rows: list[tuple], percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (pivot, low, high, member, unit, homes, copies, set) of a cell: per member its links that belong to the cell.

    A link of two units belongs to the cell of just these.  A link of documents that meet in several regions
    belongs to the one of smallest pivot; if one of them is the other's pivot, it is not sought here.
    Yields (member, linked members, shingles in common, united, copies of the linked).
    """
    rows = list({r[3]: r for r in rows}.values())
    pivot, low, high = rows[0][:3]
    ids, unit, copies = (np.array([r[i] for r in rows], dtype=np.int64) for i in (3, 4, 6))
    place = {r[3]: i for i, r in enumerate(rows)}
    at_home: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        for h in r[5]:
            if h < pivot or h in place:
                at_home.setdefault(h, []).append(i)
    region, everyone = _Region([r[7] for r in rows], np.arange(len(rows)), percent), np.arange(len(rows))
    for one, linked, common in region.neighbours(everyone, everyone):
        elsewhere = np.zeros(len(rows), dtype=bool)
        elsewhere[at_home.get(rows[one][3], [])] = True
        for h in rows[one][5]:
            if h < pivot:
                elsewhere[at_home[h]] = True
            if h in place:
                elsewhere[place[h]] = True
        if low != high:
            elsewhere |= unit == unit[one]
        here = ~elsewhere[linked]
        linked, common = linked[here], common[here]
        if len(linked):
            yield rows[one][3], ids[linked], common, region.sizes[one] + region.sizes[linked] - common, copies[linked]


def _whole_cells(percent: int, pairs: bool):
    """Rows of a cell stand together: to links (a, b, common, united) with a < b, or to (member, number of linked rows)."""

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if pairs:
            for one, linked, common, united, _ in _whole_cell(rows, percent):
                up = linked > one
                columns = [np.full(int(up.sum()), one, dtype=np.int64), linked[up], common[up], united[up]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "common", "united"])
        else:
            found = [(one, int(copies.sum())) for one, *_, copies in _whole_cell(rows, percent)]
            columns = [[x[i] for x in found] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["v", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            plain = zip(*[c.to_pylist() for c in batch.columns[:7]])
            for row, shingles in zip(plain, batch.column(7)):
                if held and held[0][:3] != row[:3]:
                    yield from out(held)
                    held = []
                held.append((*row, _array(shingles).copy()))
        if held:
            yield from out(held)

    return run


def _cells(percent: int):
    """Rows of a cell stand together: (cell, member, label, unit, set) to links (a, b) between labels."""

    def solve(rows: list[tuple]) -> list[tuple[int, int]]:
        labels = np.array([r[1] for r in rows], dtype=np.int64)
        region = _Region([r[2] for r in rows], labels, percent)
        region.join(np.arange(len(rows)))
        return [(int(labels[a]), int(labels[b])) for a, b in region.links]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            links = solve(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"]
            )

        held, cell = [], None
        for batch in batches:
            for key, member, label, shingles in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
            ):
                if key != cell and held:
                    yield out(held)
                    held = []
                cell = key
                held.append((member, label, _array(shingles).copy()))
        if held:
            yield out(held)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for the ends of ``edges`` (a, b): the smallest vertex of its component.

    Every round takes the smallest label among the neighbours and then that label's own label;
    all rounds are joins and map-side minima over written tables.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both, edge_path = save(both, "edges")
    labels, path = save(both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("v").alias("next"), F.col("label").alias("far"))
        step = step.join(jump, "next").select("v", F.col("label").alias("old"), F.least("next", "far").alias("label"))
        step, new = save(step, "labels")
        changed = step.where("old <> label").limit(1).count()
        drop_path(spark, path)
        labels, path = step.select("v", "label"), new
        if not changed:
            drop_path(spark, edge_path)
            return labels


def _units(left: DataFrame, percent: int) -> DataFrame:
    """Members (with ``distance`` and ``blocks``) once per cell, that is per ``other`` unit which theirs may link with."""
    width = 1 - percent / 100 + 1e-9
    left = left.withColumns(
        {
            "band": F.when(F.col("blocks") > 1, F.floor(F.col("distance") / width)).otherwise(0).cast("int"),
            "block": F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"),
        }
    )
    # A cell holds two units (band, block) whose bands are equal or neighbours; bands further apart can't link.
    unit = F.col("band") * F.col("blocks") + F.col("block")
    around = F.flatten(
        F.transform(
            F.sequence(F.greatest(F.col("band") - 1, F.lit(0)), F.col("band") + 1),
            lambda g: F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: g * F.col("blocks") + k),
        )
    )
    around = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(around)
    return left.withColumn("unit", unit).withColumn("other", F.explode(around))


def _whole_links(star: DataFrame, sets: DataFrame, copies: DataFrame, percent: int, pairs: bool) -> tuple[DataFrame, str]:
    """Every link between vertices, exactly once: (a, b, common, united), or summed to (v, links) in rows linked with.

    ``copies`` has the rows of each vertex (v, copies).  A region is left out only if all pairs of its
    members meet in one region of smaller pivot, or if it has a single member, whose link to the pivot is known.
    """
    united = F.col("pivot_n") + F.col("member_n") - F.col("common")
    direct = star.where(100 * F.col("common") >= percent * united)
    homes = star.groupBy("member").agg(F.sort_array(F.collect_list("pivot")).alias("homes")).withColumn("first", F.col("homes")[0])
    left = star.select("pivot", "member", "member_n", (1 - F.col("common") / united).alias("distance")).join(homes, "member")
    regions = left.groupBy("pivot").agg(
        F.count("*").alias("members"), F.min("first").alias("low"), F.max("first").alias("high"), F.sum("member_n").alias("weight")
    )
    regions = regions.where((F.col("members") > 1) & ~((F.col("low") == F.col("high")) & (F.col("low") < F.col("pivot"))))
    regions = regions.select(F.col("pivot").alias("of"), F.ceil(F.col("weight") / REGION).cast("int").alias("blocks"))
    # A table of their own, so that the join can divide the members of a large region.
    regions, regions_path = save(regions, "jaccard-crowded")
    left = _units(left.join(regions, F.col("pivot") == F.col("of")), percent)
    left = left.join(copies.withColumnRenamed("v", "member"), "member").join(sets.withColumnRenamed("row", "member"), "member")
    cells = left.select(
        "pivot", F.least("unit", "other").alias("low"), F.greatest("unit", "other").alias("high"), "member", "unit", "homes", "copies", "shingles"
    )
    cells = cells.repartition("pivot", "low", "high").sortWithinPartitions("pivot", "low", "high")
    if pairs:
        direct = direct.select(F.col("pivot").alias("a"), F.col("member").alias("b"), "common", united.alias("united"))
        near = cells.mapInArrow(frugal(_whole_cells(percent, True)), "a long, b long, common long, united long")
        found = save(direct.union(near), "jaccard-all-links")
        drop_path(star.sparkSession, regions_path)
        return found
    direct = direct.select("pivot", "member")
    ends = direct.select(F.col("pivot").alias("at"), F.col("member").alias("v")).union(direct.select("member", "pivot"))
    ends = ends.join(copies, "v").select(F.col("at").alias("v"), F.col("copies").alias("links"))
    near = cells.mapInArrow(frugal(_whole_cells(percent, False)), "v long, links long")
    found = save(ends.union(near).groupBy("v").agg(F.sum("links").alias("links")), "jaccard-link-counts")
    drop_path(star.sparkSession, regions_path)
    return found


def _linked(docs: DataFrame, words: int, percent: int, want: str = "components") -> DataFrame:
    """(id, text) to (id, key, n, least_id, least_key): the smallest row reachable by links, null ids last.

    ``want``: "components" compares only what can still join two classes; "counts" compares all and adds
    ``n_links``, the other rows that a row links with; "links" gives the links between distinct sets instead.
    """
    with tidy(docs.sparkSession):
        return _joined(docs, words, percent, want)


def _joined(docs: DataFrame, words: int, percent: int, want: str) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select("id", or_empty(F.col("text")).alias("text")).withColumn("key", F.xxhash64("text"))
    kind = docs.schema["id"].dataType
    long = lambda name: T.StructField(name, T.LongType())
    described = T.StructType(
        [long("row"), T.StructField("id", kind), long("key"), long("n"), long("digest1"), long("digest2"),
         T.StructField("signs", T.ArrayType(T.LongType()))]
    )
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "id", "key", "text")
    rows, rows_path = save(rows.mapInArrow(frugal(_described(words, percent)), described), "jaccard-rows")

    # Copies: rows of one set are one vertex, the smallest row.  The groups are a table of their own, so that the join
    # back can divide the rows of a large one.
    plain = rows.drop("signs")
    same = F.struct(F.col("id").isNull().alias("missing"), "id", "key")
    groups = plain.groupBy("digest1", "digest2", "n").agg(F.min("row").alias("vertex"), F.min(same).alias("least"), F.count("*").alias("rows"))
    groups, groups_path = save(groups.where("rows > 1").drop("rows"), "jaccard-copies")
    plain = plain.join(groups, ["digest1", "digest2", "n"], "left").select(
        "row", "id", "key", "n", F.coalesce("vertex", "row").alias("vertex"), F.coalesce("least", same).alias("least")
    )
    plain, plain_path = save(plain, "jaccard-vertices")
    drop_path(spark, groups_path)

    # Regions: the smallest vertex that shares a signature with a vertex is its pivot.
    # Copies have their vertex's signatures, so a smallest row is a vertex in any case; copies among the members go
    # when few rows are left.  Only signatures that pass a filter of the shared ones are shuffled a second time.
    signs = rows.select("row", F.explode("signs").alias("sign"))
    pivots = signs.groupBy("sign").agg(F.min("row").alias("pivot"), F.count("*").alias("rows")).where("rows > 1")
    pivots, pivots_path = save(pivots.select("sign", "pivot"), "jaccard-pivots")
    passing = spark.sparkContext.broadcast(_filter(pivots.select("sign")))
    signs = rows.select("row", "signs").mapInArrow(frugal(_shared_signs(passing)), "row long, sign long")
    met = signs.join(pivots, "sign").where("row <> pivot").select("pivot", F.col("row").alias("member")).distinct()
    met = met.join(plain.where("row = vertex").select(F.col("row").alias("member")), "member").select("pivot", "member")
    met, met_path = save(met, "jaccard-regions")
    passing.destroy()
    drop_path(spark, rows_path)
    drop_path(spark, pivots_path)

    # Shingle sets of the documents that stand in some region, from their texts.
    wanted = met.select(F.col("member").alias("row")).union(met.select("pivot")).distinct()
    wanted, wanted_path = save(wanted.join(plain.select("row", "id", "key"), "row"), "jaccard-wanted")
    passing = spark.sparkContext.broadcast(_filter(wanted.select("key")))
    texts = docs.select("id", "key", "text")
    texts = texts.mapInArrow(frugal(_wanted_texts(passing)), T.StructType([T.StructField("id", kind), long("key"), T.StructField("text", T.StringType())]))
    # Nulls are equal inside a struct.  Two structs of one type make one key, so that what follows the join needs no
    # shuffle of its own.
    texts = texts.select(F.struct("id", "key").alias("at"), "text").join(wanted.select("row", F.struct("id", "key").alias("at")), "at")
    # A row that stands several times is met once for each task that holds it.
    texts = texts.dropDuplicates(["at"]).select("row", "text")
    sets = texts.mapInArrow(frugal(_sets(words)), "row long, shingles binary")
    sets, sets_path = save(sets, "jaccard-sets")
    passing.destroy()
    drop_path(spark, wanted_path)

    # Distances to the pivots; a member within the threshold is linked to its pivot.
    pairs = met.join(sets.select(F.col("row").alias("member"), F.col("shingles").alias("member_set")), "member")
    pairs = pairs.join(sets.select(F.col("row").alias("pivot"), F.col("shingles").alias("pivot_set")), "pivot")
    star = pairs.select("pivot", "member", "pivot_set", "member_set").mapInArrow(
        frugal(_distances), "pivot long, member long, pivot_n long, member_n long, common long"
    )
    star, star_path = save(star, "jaccard-distances")
    union = F.col("pivot_n") + F.col("member_n") - F.col("common")
    if want != "components":
        copies = plain.groupBy(F.col("vertex").alias("v")).agg(F.count("*").alias("copies"))
        every, every_path = _whole_links(star, sets, copies, percent, want == "links")
    if want == "links":
        for end in ("a", "b"):
            own = plain.where("row = vertex").select(
                F.col("vertex").alias(end), F.col("least.id").alias(f"class_{end}"), F.col("least.key").alias(f"key_{end}")
            )
            every = every.join(own, end)
        result, _ = save(every.select("class_a", "key_a", "class_b", "key_b", "common", "united"), "jaccard-result")
        for path in (plain_path, met_path, sets_path, star_path, every_path):
            drop_path(spark, path)
        return result
    links = star.where(100 * F.col("common") >= percent * union).select(
        F.col("pivot").alias("a"), F.col("member").alias("b")
    )
    labels = components(links)

    # What is left: members of a region that are in different components and inside each other's window.
    left = star.select("pivot", "member", "member_n", (1 - F.col("common") / union).alias("distance"))
    left = left.join(labels.withColumnRenamed("v", "member"), "member", "left")
    left = left.withColumn("label", F.coalesce("label", "member"))
    split = left.groupBy("pivot").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.sum("member_n").alias("weight")
    )
    split = split.where("low <> high").select(
        F.col("pivot").alias("of"), F.ceil(F.col("weight") / REGION).cast("int").alias("blocks")
    )
    split, split_path = save(split, "jaccard-split")
    left = left.join(split, F.col("pivot") == F.col("of"))
    left = _units(left, percent)
    left = left.select(
        F.xxhash64("pivot", F.least("unit", "other"), F.greatest("unit", "other")).alias("cell"), "member", "label"
    )
    cells = left.join(sets.withColumnRenamed("row", "member"), "member").select("cell", "member", "label", "shingles")
    cells = cells.repartition(F.col("cell")).sortWithinPartitions("cell")
    more, more_path = save(cells.mapInArrow(frugal(_cells(percent)), "a long, b long"), "jaccard-links")
    joined = components(more).select(F.col("v").alias("label"), F.col("label").alias("final"))
    labels = labels.join(joined, "label", "left").select("v", F.coalesce("final", "label").alias("label"))
    alone = joined.select(F.col("label").alias("v"), F.col("final").alias("label")).join(labels.select("v"), "v", "left_anti")
    labels = labels.union(alone)

    # The smallest identity of each component; documents without a link keep that of their copies.
    least = plain.where("row = vertex").select(F.col("vertex").alias("v"), "least").join(labels, "v")
    by_label = least.groupBy("label").agg(F.min("least").alias("smallest"))
    by_vertex = least.join(by_label, "label").select(F.col("v").alias("vertex"), "smallest")
    smallest = F.coalesce("smallest", "least")
    result, made = plain.join(by_vertex, "vertex", "left"), []
    if want == "counts":
        counted = copies.join(every, "v", "left").select(
            F.col("v").alias("vertex"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("others")
        )
        result = result.join(counted, "vertex")
        made = [F.when(F.col("n") == 0, 0).otherwise(F.col("others")).cast("long").alias("n_links")]
    result = result.select("id", "key", "n", smallest["id"].alias("least_id"), smallest["key"].alias("least_key"), *made)
    result, _ = save(result, "jaccard-result")
    for path in (plain_path, met_path, sets_path, star_path, split_path, more_path, *([every_path] if made else [])):
        drop_path(spark, path)
    return result


def jaccard_components(
    docs: DataFrame, words: int = 4, percent: int = 85, text: str = "text", identity: str = "doc_id"
) -> DataFrame:
    """(identity, ``n_shingles``, ``component_id``, ``n_links``), one row per row of ``docs``.

    A document's set holds the distinct shingles of ``words`` words (A-Z lowered, divided by
    blanks); fewer words are one shingle; a null text or one without words has the empty set and
    links with nothing.  Two documents link when 100 * common >= ``percent`` * union.  The
    component is the smallest identity reachable by links.  Rows of equal text or equal identity
    are rows of their own; null identities are never the smallest, and a component without any
    other has null.  ``n_links`` is the number of other rows that link with the document, those of
    its own set included.  An empty table stays empty.

    Method.  Rows of equal sets are one vertex.  Signatures (``Parts``) that any two linking sets
    must share assign documents to the regions of pivots: a pivot is the smallest document of
    some signature.  Every member's distance to its pivot is computed; links to pivots give
    classes.  In a region only members of different classes can still need a comparison, and
    by the triangle inequality only if their distances to the pivot differ by no more than the
    threshold.  Such a region is joined in memory: pivots among its members make Voronoi cells,
    documents within twice the threshold of a border are replicated across it, and cells are
    joined in the same way.  Regions too large for a task are cut into distance bands and
    blocks; every pair of blocks in equal or neighbouring bands is a cell of its own.  For the
    numbers of links every region is joined in the same way, whatever the classes, and each link
    is counted in the one cell it belongs to (``_whole_cell``).  No pair of documents is ever
    written, except a link between two classes; ``jaccard_links`` gives all links.
    """
    found = _linked(docs.select(F.col(identity).alias("id"), F.col(text).alias("text")), words, percent, "counts")
    return found.select(
        F.col("id").alias(identity),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least_id")).alias("component_id"),
        "n_links",
    )


def jaccard_links(docs: DataFrame, words: int = 4, percent: int = 85, text: str = "text", identity: str = "doc_id") -> DataFrame:
    """(``class_a``, ``key_a``, ``class_b``, ``key_b``, ``common``, ``united``), one row per link of distinct sets.

    Each unordered pair of sets that links stands here once, in whatever order.  A class is the rows
    of one set, named by its smallest identity (null only if it has no other) and the hash of that
    row's text; ``common`` and ``united`` count shingles.  Rows and sets as in ``jaccard_components``.
    The result has as many rows as there are links, so it grows with the square of a family.
    """
    return _linked(docs.select(F.col(identity).alias("id"), F.col(text).alias("text")), words, percent, "links")


def keep_smallest(
    docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", identity: str = "doc_id"
) -> DataFrame:
    """``docs`` with one document of each component: the one of smallest identity, null identities last.

    Rows of one identity are told apart by the hash of their text; of rows that agree in both, one
    stays.  Documents of the empty set all stay.
    """
    box = Boxed(docs)
    own, body = box.name(identity), box.name(text)
    found = _linked(box.df.select(F.col(own).alias("id"), F.col(body).alias("text")), words, percent)
    kept = F.col("id").eqNullSafe(F.col("least_id")) & (F.col("key") == F.col("least_key"))
    gone = found.where((F.col("n") > 0) & ~kept)
    # Nulls are equal inside a struct.  Two structs of one type (the hash is never null) make one key of join and window,
    # for which the texts are shuffled once.
    gone = gone.select(F.struct("id", F.coalesce("key", F.lit(0)).alias("key")).alias("at")).distinct()
    rows = box.df.withColumn("at", F.struct(F.col(own).alias("id"), F.xxhash64(or_empty(F.col(body))).alias("key")))
    rows = rows.join(gone, "at", "left_anti")
    place = F.row_number().over(Window.partitionBy("at").orderBy("at"))
    rows = rows.withColumn("place", place).where((F.col("place") == 1) | ~or_empty(F.col(body)).rlike(WORD))
    return box.restored(rows)
