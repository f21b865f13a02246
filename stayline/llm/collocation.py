"""Phrases whose words attract each other: n-grams counted in HAT-tries, scored by their weakest cut."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import Filter, drop_path, frugal, or_empty, save

#: Entries of a container that bursts, and the depth of the trie above containers.
BURST = 4096
SHALLOW = 3
#: Entries of a task's trie at which whole subtrees leave as runs, until half are left; words with an id of their own.
ENTRIES = 500_000
WORDS = 400_000
#: Bytes of text that are counted at a time.
TEXT_BYTES = 1 << 22
#: Bits of a filter for each phrase that it lets pass, and its largest size (16 MB), beyond which it only passes more.
FILTER_BITS = 16
LARGEST_FILTER = 1 << 27
#: Numbers in which a task counts pairs by hash, and the segments that they leave in.
PLACES = 1 << 26
SEGMENTS = 1024
#: Parts of a language in which first ranks are found.
SALTS = 16

#: Bytes that end a piece; they become one that no UTF-8 text has.
_END = b"\xff"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + _END * 10)
UNKNOWN = "und"


class _Branch(dict):
    """Inner node: word id to the node below it."""


class HatTrie:
    """Counts windows of ``width`` word ids (0: no word): hash containers below a shallow trie.

    A container maps the ids that the path to it has not used, as big-endian bytes, to a count.  A container of
    more than ``BURST`` entries becomes a branch by its first id.
    """

    def __init__(self, width: int):
        self.width, self.root, self.size = width, Counter(), 0

    def add(self, windows: np.ndarray) -> None:
        self.root = self._add(self.root, windows, 0)

    def _add(self, node, windows: np.ndarray, depth: int):
        if not isinstance(node, _Branch):
            left = self.width - depth
            before = len(node)
            keys = np.ascontiguousarray(windows[:, depth:], dtype=">u4").view(f"V{4 * left}")
            node.update(keys.ravel().tolist())
            self.size += len(node) - before
            return self._burst(node) if len(node) > BURST and left > 1 and depth < SHALLOW else node
        windows = windows[np.argsort(windows[:, depth], kind="stable")]
        ids, starts = np.unique(windows[:, depth], return_index=True)
        for i, start, stop in zip(ids.tolist(), starts.tolist(), [*starts[1:].tolist(), len(windows)]):
            below = node.get(i)
            node[i] = self._add(Counter() if below is None else below, windows[start:stop], depth + 1)
        return node

    @staticmethod
    def _burst(container: Counter) -> _Branch:
        branch = _Branch()
        for key, n in container.items():
            i = int.from_bytes(key[:4])
            if i not in branch:
                branch[i] = Counter()
            branch[i][key[4:]] = n
        return branch

    def _items(self, node, path: bytes = b"") -> Iterator[tuple[bytes, int]]:
        if isinstance(node, _Branch):
            for i, below in node.items():
                yield from self._items(below, path + i.to_bytes(4))
        else:
            for key, n in node.items():
                yield path + key, n

    def _entries(self, node) -> int:
        return sum(map(self._entries, node.values())) if isinstance(node, _Branch) else len(node)

    def spill(self, keep: int = 0) -> Iterator[list[tuple[bytes, int]]]:
        """Takes out whole subtrees, the largest first, until at most ``keep`` entries are left."""
        if not isinstance(self.root, _Branch):
            node, self.root, self.size = self.root, Counter(), 0
            yield list(node.items())
            return
        for i in sorted(self.root, key=lambda i: -self._entries(self.root[i])):
            if self.size <= keep:
                break
            node = self.root.pop(i)
            self.size -= self._entries(node)
            yield list(self._items(node, i.to_bytes(4)))
        if not self.root:
            self.root = Counter()


def _folded(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words) of a batch's texts, ``_END`` between pieces and texts; about ``TEXT_BYTES`` at a time."""
    waiting: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}

    def words(lang: str) -> list[bytes]:
        held[lang] = 0
        return _END.join(waiting.pop(lang)).translate(_FOLD).replace(_END, b" " + _END + b" ").split()

    for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
        lang = lang.as_py()
        waiting.setdefault(lang, []).append(body := text.as_py())
        held[lang] = held.get(lang, 0) + len(body)
        if held[lang] > TEXT_BYTES:
            yield lang, words(lang)
    for lang in list(waiting):
        yield lang, words(lang)


_ROWS = "lang string, phrase string, n long"


def _batch(rows: list[tuple[str, bytes | None, int]]) -> pa.RecordBatch:
    langs, phrases, counts = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
        ["lang", "phrase", "n"],
    )


def _word_runs(rows: DataFrame) -> DataFrame:
    """(lang, word, n) and, with a null word, the number of all words: a container of whole words per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        totals: Counter = Counter()
        for batch in batches:
            for lang, words in _folded(batch):
                own = counts.setdefault(lang, Counter())
                own.update(words)
                totals[lang] += len(words) - own.pop(_END, 0)
                if sum(map(len, counts.values())) > ENTRIES:
                    for k in list(counts):
                        yield _batch([(k, w, n) for w, n in sorted(counts.pop(k).items())])
        for k, own in counts.items():
            yield _batch([(k, w, n) for w, n in sorted(own.items())])
        yield _batch([(k, None, n) for k, n in totals.items() if n])

    return rows.mapInArrow(frugal(run), _ROWS)


def _bits(n: int) -> int:
    return min(LARGEST_FILTER, 1 << max(10, (n * FILTER_BITS).bit_length()))


def _hashed(lang, word):
    return F.xxhash64(F.concat(lang, F.lit("\0"), word))


def _word_filter(words: DataFrame) -> Filter:
    return Filter.of(words.select(_hashed(F.col("lang"), F.col("phrase")).alias("h")), _bits(words.count()))


def _pair_filter(pairs: DataFrame) -> Filter:
    first, second = (_hashed(F.col("lang"), F.split_part("phrase", F.lit(" "), F.lit(k))) for k in (1, 2))
    turned = F.shiftleft(second, 21).bitwiseOR(F.shiftrightunsigned(second, 43))
    return Filter.of(pairs.select(first.bitwiseXOR(turned).alias("h")), _bits(pairs.count()))


def _turned(hashes: np.ndarray) -> np.ndarray:
    return hashes << np.uint64(21) | hashes >> np.uint64(43)


def _pair_sketch(rows: DataFrame, words: Filter, least: int, places: int) -> Filter:
    """Lets pass every pair of words that has ``least`` places, and few others: pairs are counted by hash.

    A task counts in an array of ``places`` small numbers, which leave in compressed segments; what is summed below
    ``least`` holds no frequent pair.  Segments are summed one by one, and only their bits reach the driver.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(words)
    kind, most = (np.uint8, 255) if least <= 255 else (np.uint32, (1 << 32) - 1)
    step = max(64, places // SEGMENTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = _Ids(shared.value), np.zeros(places, dtype=kind)
        for batch in batches:
            for lang, tokens in _folded(batch):
                found = ids.of(lang, tokens)
                at = np.flatnonzero((found[:-1] > 0) & (found[1:] > 0))
                hashes = np.array(ids.hashes, np.uint64)
                pairs = (hashes[found[at]] ^ _turned(hashes[found[at + 1]])) & np.uint64(places - 1)
                seen, times = np.unique(pairs, return_counts=True)
                counts[seen] = np.minimum(counts[seen].astype(np.int64) + times, most).astype(kind)
                if len(ids.words) > WORDS:
                    ids.reset()
        squeeze = zstandard.ZstdCompressor(level=1).compress
        own = [k for k in range(0, places, step) if counts[k : k + step].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k // step for k in own], pa.int64()), pa.array([squeeze(counts[k : k + step].tobytes()) for k in own], pa.binary())],
            ["segment", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, at, total = zstandard.ZstdDecompressor().decompress, None, None

        def bits() -> pa.RecordBatch:
            packed = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([packed], pa.binary())], ["segment", "bits"])

        for batch in batches:
            for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if segment != at:
                    if at is not None:
                        yield bits()
                    at, total = segment, np.zeros(step, dtype=np.int64)
                total += np.frombuffer(expand(counts.as_py()), dtype=kind)
        if at is not None:
            yield bits()

    parts = rows.mapInArrow(frugal(count), "segment long, counts binary").repartition("segment").sortWithinPartitions("segment")
    found = parts.mapInArrow(frugal(add), "segment long, bits binary").toArrow()
    whole = np.zeros(places // 8, dtype=np.uint8)
    for segment, packed in zip(found["segment"].to_pylist(), found["bits"].to_pylist()):
        whole[segment * step // 8 : (segment + 1) * step // 8] = np.frombuffer(packed, np.uint8)
    return Filter(places, whole.view(np.uint64))


class _Ids:
    """Ids (from 1) of words that pass the filter, by language; 0 for all others and ends of pieces."""

    def __init__(self, filter: Filter):
        self.filter = filter
        self.reset()

    def reset(self) -> None:
        self.by_lang: dict[str, _LangIds] = {}
        self.words, self.langs, self.hashes = [b""], [""], [0]

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        own = self.by_lang.get(lang)
        if own is None:
            own = self.by_lang[lang] = _LangIds(self, lang)
        return np.fromiter(map(own.__getitem__, words), np.int64, len(words))


class _LangIds(dict):
    def __init__(self, ids: _Ids, lang: str):
        self.ids, self.lang, self.lead = ids, lang, lang.encode() + b"\0"
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        ids, hashed = self.ids, xxhash.xxh64_intdigest(self.lead + word, 42)
        if not ids.filter.has(hashed):
            return 0
        at = self[word] = len(ids.words)
        ids.words.append(word)
        ids.langs.append(self.lang)
        ids.hashes.append(hashed)
        return at


def _windows(ids: np.ndarray, hashes: np.ndarray, pairs: Filter, shortest: int, longest: int) -> np.ndarray:
    """Windows of known words whose pairs all pass: pairs, or the longest of three or more words."""
    joined = (ids[:-1] > 0) & (ids[1:] > 0)
    at = np.flatnonzero(joined)
    passed = pairs.passes(hashes[ids[at]] ^ _turned(hashes[ids[at + 1]]))
    if shortest == 2:
        at = at[passed]
        return np.stack([ids[at], ids[at + 1]], axis=1)
    joined[at] = passed
    joined = np.append(joined, np.zeros(longest, dtype=bool))
    at = np.flatnonzero(joined[:-1] & joined[1:])
    goes, columns = joined[at] & joined[at + 1], [ids[at], ids[at + 1], ids[at + 2]]
    for k in range(3, longest):
        goes = goes & joined[at + k - 1]
        columns.append(np.where(goes, ids[np.minimum(at + k, len(ids) - 1)], 0))
    return np.stack(columns, axis=1)


def _phrase_runs(rows: DataFrame, words: Filter, pairs: Filter, shortest: int, longest: int) -> DataFrame:
    """(lang, phrase, n) as runs: whole subtrees of a task's trie, each in the order of its phrases.

    A window also counts for the shorter phrases it begins with, so subtrees are summed by prefix as they leave.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((words, pairs))
    width = 2 if shortest == 2 else longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, joined = shared.value
        ids, trie = _Ids(known), HatTrie(width)
        lengths = [4 * k for k in range(shortest + 1, width + 1)]

        def runs(keep: int) -> Iterator[pa.RecordBatch]:
            out: list[tuple[str, bytes, int]] = []
            for subtree in trie.spill(keep):
                counts: Counter = Counter()
                for key, n in subtree:
                    counts[key[: 4 * shortest]] += n
                    for k in lengths:
                        if key[k - 4 : k] == b"\0\0\0\0":
                            break
                        counts[key[:k]] += n
                made = []
                for key, n in counts.items():
                    path = [int.from_bytes(key[k : k + 4]) for k in range(0, len(key), 4)]
                    made.append((ids.langs[path[0]], b" ".join([ids.words[i] for i in path]), n))
                out += sorted(made)
                if len(out) > 50_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

        for batch in batches:
            for lang, tokens in _folded(batch):
                places = ids.of(lang, tokens)
                if len(places) > 1:
                    windows = _windows(places, np.array(ids.hashes, np.uint64), joined, shortest, longest)
                    if len(windows):
                        trie.add(windows)
                if len(ids.words) > WORDS:
                    yield from runs(0)
                    ids.reset()
                elif trie.size > ENTRIES:
                    yield from runs(ENTRIES // 2)
        yield from runs(0)

    return rows.mapInArrow(frugal(run), _ROWS)


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Runs of one prefix (the first three words at most) meet in one partition and are merged; rare phrases go."""
    prefix = F.substring_index("phrase", " ", 3)
    runs = runs.withColumn("prefix", prefix).repartition("lang", "prefix")
    return runs.groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("a")).where((F.col("a") >= least) | F.col("phrase").isNull()).drop("prefix")


def mine(
    docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, inside: int = 100, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of 2 to ``longest`` words.

    Texts lose A-Z, fall into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs.
    n counts a language's words, a phrase's frequency ``a`` counts all places in pieces; candidates have at least
    ``least``.  Cut behind word k, a candidate scores floor(1000 a n / (l r)), l and r the frequencies of both
    sides; the lowest cut counts, of equal ones the first.  A candidate goes if a longer candidate that holds
    it has at least ``inside`` percent of its frequency.  Ranks go by score, then frequency, then phrase.

    Null text: no words; null language: ``und``; very long texts are counted whole; repeated rows count as often
    as they stand; an empty table gives no rows; columns besides the two are not read, so their names do not matter.

    Scale: a phrase of ``least`` places has only words and pairs of ``least`` places, so passes count words, pairs
    of frequent words by hash, such pairs themselves, and longer windows of frequent pairs.  What may be frequent reaches
    tasks as a filter of at most ``LARGEST_FILTER`` or ``PLACES`` bits, which lets more pass where it is too small but
    loses nothing: final counts are exact.  A task's trie holds ``ENTRIES`` entries; above that whole subtrees leave.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), or_empty(F.col(text).cast("string")).alias("text"))
    words, words_at = save(_merged(_word_runs(rows), least), "words")
    totals = words.where("phrase IS NULL").select(F.col("lang").alias("lang_"), F.col("a").alias("n"))
    words = words.where("phrase IS NOT NULL")
    known = _word_filter(words)
    pairs, pairs_at = save(_merged(_phrase_runs(rows, known, _pair_sketch(rows, known, least, PLACES), 2, longest), least), "pairs")
    candidates, longer_at = pairs, None
    if longest > 2:
        longer, longer_at = save(_merged(_phrase_runs(rows, known, _pair_filter(pairs), 3, longest), least), "phrases")
        candidates = pairs.unionByName(longer)
    result, _ = save(_ranked(words, candidates, totals, top, inside), "collocations")
    for path in filter(None, (words_at, pairs_at, longer_at)):
        drop_path(spark, path)
    return result


def _ranked(words: DataFrame, candidates: DataFrame, totals: DataFrame, top: int, inside: int) -> DataFrame:
    """Scores of candidates by joins of their parts, and the first of each language."""
    side = lambda name: words.unionByName(candidates).select(
        F.col("lang").alias(f"lang_{name}"), F.col("phrase").alias(f"phrase_{name}"), F.col("a").alias(name)
    )
    parts = F.split("phrase", " ")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(parts) - 1)))
    cut = cut.withColumn("left", F.array_join(F.slice(parts, 1, F.col("k")), " "))
    cut = cut.withColumn("right", F.array_join(F.slice(parts, F.col("k") + 1, F.size(parts) - F.col("k")), " "))
    for name, column in (("l", "left"), ("r", "right")):
        cut = cut.join(side(name), (F.col("lang") == F.col(f"lang_{name}")) & (F.col(column) == F.col(f"phrase_{name}")))
    cut = cut.join(totals, F.col("lang") == F.col("lang_"))
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    cut = cut.withColumns({"over": F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n"), "under": wide("l") * wide("r")})
    cut = cut.select("lang", "phrase", "a", "n", F.struct(F.expr("over div under").alias("score"), "k", "l", "r").alias("cut"))
    scored = cut.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))

    n = F.size(parts)
    spans = F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.array_join(F.slice(parts, i, m), " ")))
    held = candidates.where(n > 2).select(F.col("lang").alias("lang_in"), "a", F.explode(F.array_distinct(F.flatten(spans))).alias("phrase_in"))
    held = held.groupBy("lang_in", "phrase_in").agg(F.max("a").alias("a_in"))
    scored = scored.join(held, (F.col("lang") == F.col("lang_in")) & (F.col("phrase") == F.col("phrase_in")), "left")
    scored = scored.where(F.col("a_in").isNull() | (100 * wide("a_in") < inside * wide("a")))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's first ones are among the first ones of its parts.
    part = Window.partitionBy("lang", "part").orderBy(*order)
    scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    scored = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    scored = scored.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)
    return scored.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
