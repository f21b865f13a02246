"""Language identification by known words, backing off to ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import Boxed, drop_path, frugal, or_empty, save

#: A word is a run of letters: of what \\w takes, without digits, the other numerals that isalpha() tells from letters,
#: and the underscore; the longest n-gram; marks for a word's ends.
LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 4
UNKNOWN = "und"
#: Entries that a task counts or remembers before it sends them on or starts anew.
HELD = 150_000
#: Weights (items times languages) of each kind that a task holds at most.
HELD_WEIGHTS = 4_000_000


def words_of(text: str) -> list[str]:
    found = LETTERS.findall(text.lower())
    if not found or "".join(found).isalpha():
        return found
    return [word for run in found for word in "".join(c if c.isalpha() else " " for c in run).split()]


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of the word between its end marks; a single character has no mark."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _sent(counts: dict[int, Counter]) -> pa.RecordBatch:
    langs = pa.array([lang for lang, own in counts.items() for _ in range(len(own))], pa.int32())
    items = pa.array([item for own in counts.values() for item in own], pa.string())
    numbers = pa.array([n for own in counts.values() for n in own.values()], pa.int64())
    counts.clear()
    return pa.RecordBatch.from_arrays([langs, items, numbers], ["lang", "item", "n"])


def _count_words(place: dict[str, int]):
    """(language, text) to (place of the language, word, count), summed within the task as far as memory is set aside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.setdefault(place[lang], Counter()).update(words_of(text.as_py()))
                if sum(map(len, counts.values())) > HELD:
                    yield _sent(counts)
        yield _sent(counts)

    return run


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, word, count) to (language, n-gram after its length, count)."""
    counts: dict[int, Counter] = {}
    for batch in batches:
        for lang, word, n in zip(*[c.to_pylist() for c in batch.columns]):
            own = counts.setdefault(lang, Counter())
            for size in range(1, LONGEST + 1):
                mark = str(size)
                for gram in grams_of(word, size):
                    own[mark + gram] += n
            if sum(map(len, counts.values())) > HELD:
                yield _sent(counts)
    yield _sent(counts)


@dataclass
class Model:
    """Log frequencies by language: of words, and of n-grams by their length.

    ``words``, ``grams`` and ``weights`` are what a task holds; ``rest`` is None if that is
    everything that was learned, else the tables of all words and all n-grams (lang, item, n).
    ``base`` has the log frequency of an item that a language lacks: of words, then by length.
    """

    langs: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[str, int]
    weights: np.ndarray
    base: np.ndarray | None = None
    rest: tuple[DataFrame, DataFrame] | None = None
    paths: tuple[str, ...] = ()


class _Rows(dict):
    """Word to its row of weights; an unseen word gets a row of its n-grams' weights."""

    def __init__(self, model: Model):
        super().__init__(model.words)
        self.grams, self.used = model.grams, len(model.weights)
        self.weights = np.concatenate([model.weights, np.zeros((1024, len(model.langs)), dtype=model.weights.dtype)])

    def __missing__(self, word: str) -> int:
        if self.used == len(self.weights):
            self.weights = np.concatenate([self.weights, np.zeros_like(self.weights)])
        row = self[word] = self.used
        self.used += 1
        known = self.grams.get
        for size in range(LONGEST, 0, -1):
            found = [i for g in grams_of(word, size) if (i := known(f"{size}{g}")) is not None]
            if found:
                np.divide(np.add.reduce(self.weights[found], axis=0), len(found), out=self.weights[row])
                break
        return row


def decided(model: Model, total: np.ndarray) -> tuple[str, float]:
    """Language and score of a text with these summed weights; evidence grows with the text, the prior does not."""
    # Rounded, so that the order in which weights were added decides nothing.
    evidence = np.round(total + model.prior, 6)
    best = int(np.argmax(evidence))
    return model.langs[best], float(1 / np.exp(evidence - evidence[best]).sum())


class Scorer:
    """Scores texts with a model.

    A known word counts with its own weights.  An unseen word counts with the mean weight of its known
    n-grams of the greatest length that has any, and with nothing if no n-gram is known.
    """

    def __init__(self, model: Model):
        self.model = model
        self.start()

    def start(self) -> None:
        """Forgets unseen words."""
        self.rows = _Rows(self.model)

    @property
    def unseen(self) -> int:
        return self.rows.used - len(self.model.weights)

    def score(self, text: str) -> tuple[str, float]:
        found = words_of(text)
        if not found or not self.model.langs:
            return UNKNOWN, 0.0
        rows = np.fromiter(map(self.rows.__getitem__, found), dtype=np.int64, count=len(found))
        return decided(self.model, self.rows.weights[rows].sum(axis=0, dtype=np.float64))


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows (language, item, count) of the most frequent items: as many whole frequency classes as make ``most`` at most."""
    totals = counts.groupBy("item").agg(F.sum("n").alias("total"))
    classes = totals.groupBy("total").agg(F.count("*").alias("items")).orderBy(F.desc("total")).limit(most).collect()
    held, least = 0, None
    for r in classes:
        if held + r["items"] > most:
            break
        held, least = held + r["items"], r["total"]
    if least is None:
        return counts.where("false")
    return counts.join(totals.where(F.col("total") >= least).select("item"), "item").select("lang", "item", "n")


def fit(labelled: DataFrame, max_words: int = 100_000, max_grams: int = 40_000) -> Model:
    """A model from all rows (``lang``, ``text``), both not null.

    Every text, language, word and n-gram of length 1 to 4 is learned.  ``max_words`` and
    ``max_grams`` only bound what a task holds in memory, the most frequent ones over all
    languages (fewer words if there are many languages); if that is not all, the others stay in
    written tables, where ``predict`` looks them up.  ``release`` deletes these.
    """
    docs = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    langs = sorted(r["lang"] for r in docs)
    if not langs:
        return Model([], np.zeros(0), {}, {}, np.zeros((0, 0)))
    number = {r["lang"]: r["n"] for r in docs}
    prior = np.log([number[x] / sum(number.values()) for x in langs])
    schema = "lang int, item string, n long"
    place = {lang: i for i, lang in enumerate(langs)}
    words, path = save(
        labelled.select("lang", "text").mapInArrow(frugal(_count_words(place)), schema).groupBy("lang", "item").agg(F.sum("n").alias("n")),
        "langid-words",
    )
    grams, gram_path = save(
        words.mapInArrow(frugal(_count_grams), schema).groupBy("lang", "item").agg(F.sum("n").alias("n")), "langid-grams"
    )
    base = np.zeros((LONGEST + 1, len(langs)))
    tables, whole = [], True
    for counts, most in ((words, max_words), (grams, max_grams)):
        kind = (F.substring("item", 1, 1) if counts is grams else F.lit("0")).cast("int")
        items = dict(counts.select("item").distinct().groupBy(kind.alias("kind")).count().collect())
        for k, n in items.items():
            base[k] = n * 0.5 + 1
        for k, lang, n in counts.groupBy(kind.alias("kind"), "lang").agg(F.sum("n")).collect():
            base[k, lang] += n
        for k in items:
            base[k] = np.log(0.5 / base[k])
        most = min(most, HELD_WEIGHTS // len(langs))
        index: dict[str, int] = {}
        found = _frequent(counts, most).toArrow()
        named = found["item"].combine_chunks().dictionary_encode()
        for item in named.dictionary.to_pylist():
            index[item] = len(index)
        whole = whole and len(index) == sum(items.values())
        kinds = np.array([int(item[0]) if counts is grams else 0 for item in index], dtype=np.int64)
        matrix = base[kinds]
        rows, columns = named.indices.to_numpy(), found["lang"].to_numpy()
        matrix[rows, columns] += np.log(2.0 * found["n"].to_numpy() + 1)
        tables.append((index, matrix))
    (word_index, word_rows), (gram_index, gram_rows) = tables
    grams_at = {g: i + len(word_index) for g, i in gram_index.items()}
    model = Model(langs, prior, word_index, grams_at, np.concatenate([word_rows, gram_rows]), base, (words, grams), (path, gram_path))
    if whole:
        release(labelled.sparkSession, model)
    return model


def release(spark: SparkSession, model: Model) -> None:
    """Deletes the model's tables."""
    for path in model.paths:
        drop_path(spark, path)
    model.rest, model.paths = None, ()


ENTRIES = "array<struct<lang:int,v:double>>"


def _begun(shared):
    """(row, h1, h2, text) to (row, h1, h2, words, summed weights of held words, the other words with their counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        get, width = model.words.get, len(model.langs)
        for batch in batches:
            numbers, sums, others, times, ends = [], [], [], [], [0]
            for text in batch.column(3):
                found = words_of(text.as_py() or "")
                rows = [get(w, -1) for w in found]
                held = np.array([r for r in rows if r >= 0], dtype=np.int64)
                rest = Counter(w for w, r in zip(found, rows) if r < 0)
                numbers.append(len(found))
                sums.append(model.weights[held].sum(axis=0) if len(held) else np.zeros(width))
                others.extend(rest)
                times.extend(rest.values())
                ends.append(len(others))
            wide = np.arange(0, width * len(sums) + 1, width, dtype=np.int32)
            flat = np.concatenate(sums) if sums else np.zeros(0)
            rest = pa.StructArray.from_arrays([pa.array(others, pa.string()), pa.array(times, pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(numbers, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(wide), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest),
                ],
                ["row", "h1", "h2", "words", "sums", "others"],
            )

    return run


def _spelled(sizes: tuple[int, ...]):
    """Words to (word, length, n-gram after its length, how often it stands in the word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (word, size, f"{size}{gram}", n)
                for word in batch.column(0).to_pylist()
                for size in sizes
                for gram, n in Counter(grams_of(word, size)).items()
            ]
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "size", "item", "n"])

    return run


def _ended(shared):
    """(h1, h2, words, summed weights, what the other words add) to (h1, h2, lang_pred, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = []
            for words, sums, more in zip(*[c.to_pylist() for c in batch.columns[2:]]):
                total = np.array(sums)
                for x in more or ():
                    if x["lang"] >= 0:
                        total[x["lang"]] += x["v"]
                    else:
                        total += x["v"] * model.base[-1 - x["lang"]]
                out.append(decided(model, total) if words else (UNKNOWN, 0.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                ["h1", "h2", "lang_pred", "score"],
            )

    return run


def _scored(texts: DataFrame, model: Model, shared) -> DataFrame:
    """(h1, h2, text) to distinct (h1, h2, lang_pred, score); words that tasks don't hold are joined to the tables.

    An entry (lang, v) adds v to a language; lang -1 - k stands for v times the base of kind k.
    """
    spark, paths = texts.sparkSession, []

    def kept(df: DataFrame, label: str) -> DataFrame:
        df, path = save(df, label)
        paths.append(path)
        return df

    words, grams = model.rest
    entry = F.struct("lang", F.log(2.0 * F.col("n") + 1).alias("v"))
    begun = texts.select(F.monotonically_increasing_id().alias("row"), "h1", "h2", "text").mapInArrow(
        frugal(_begun(shared)),
        "row long, h1 long, h2 long, words long, sums array<double>, others array<struct<word:string,n:long>>",
    )
    begun = kept(begun, "langid-begun")
    others = begun.select("row", F.inline("others"))
    wanted = others.select("word").distinct()
    one = F.array(F.struct(F.lit(-1).alias("lang"), F.lit(1.0).alias("v")))
    weights = wanted.join(words.withColumnRenamed("item", "word"), "word", "left").groupBy("word").agg(
        F.collect_list(F.when(F.col("lang").isNotNull(), entry)).alias("entries")
    )
    looked = kept(weights, "langid-known")
    found = looked.where(F.size("entries") > 0).select("word", F.concat("entries", one).cast(ENTRIES).alias("entries"))
    missing = looked.where(F.size("entries") == 0).select("word")
    # Nearly all words have a known n-gram of the greatest length; the others are looked up in one more round.
    for sizes in ((LONGEST,), tuple(range(LONGEST - 1, 0, -1))):
        spelled = missing.mapInArrow(frugal(_spelled(sizes)), "word string, size int, item string, times long")
        lists = grams.where(F.substring("item", 1, 1).cast("int").isin(*sizes)).groupBy("item").agg(F.collect_list(entry).alias("own"))
        met = spelled.join(lists, "item").select("word", "size", "times", F.inline(F.concat("own", one)))
        met = met.groupBy("word", "size", "lang").agg(F.sum(F.col("times") * F.col("v")).alias("v"))
        met = met.groupBy("word").agg(F.max("size").alias("best"), F.collect_list(F.struct("size", "lang", "v")).alias("all"))
        met = met.select("word", "best", F.filter("all", lambda x: x["size"] == F.col("best")).alias("all"))
        count = F.filter("all", lambda x: x["lang"] == -1)[0]["v"]
        shares = F.transform(
            F.col("all"),
            lambda x: F.struct(
                F.when(x["lang"] == -1, -1 - F.col("best")).otherwise(x["lang"]).alias("lang"), (x["v"] / F.col("count")).alias("v")
            ),
        )
        met = kept(met.withColumn("count", count).select("word", shares.cast(ENTRIES).alias("entries")), "langid-backed")
        found = found.unionByName(met)
        missing = missing.join(met.select("word"), "word", "left_anti")
    more = others.join(found, "word").select("row", "n", F.inline("entries"))
    more = more.groupBy("row", "lang").agg(F.sum(F.col("n") * F.col("v")).alias("v"))
    more = more.groupBy("row").agg(F.collect_list(F.struct("lang", "v")).alias("more"))
    ended = begun.join(more, "row", "left").select("h1", "h2", "words", "sums", "more")
    ended = ended.mapInArrow(frugal(_ended(shared)), "h1 long, h2 long, lang_pred string, score double")
    # Equal texts have equal results.
    ended = ended.groupBy("h1", "h2").agg(F.min("lang_pred").alias("lang_pred"), F.min("score").alias("score"))
    result, _ = save(ended, "langid-result")
    for path in paths:
        drop_path(spark, path)
    return result


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (0 to 1).

    A text without letters, or null, is ``und`` with score 0; so is every text if nothing was
    learned.  Equal totals go to the first language in code point order.  The score is the
    posterior probability of the predicted language, with the evidence of all words, so a long
    clear text scores high however rare its language is.  Result columns replace equal names.

    Scale: if tasks hold the whole model, one pass without a shuffle.  Otherwise that pass sums
    what it can; the distinct words that it can't weigh meet the table of all words, those
    missing there meet the table of all n-grams, and the sums per text come back by its hash.
    """
    box = Boxed(docs, "lang_pred", "score")
    body = box.name(text)
    held = Model(model.langs, model.prior, model.words, model.grams, model.weights, model.base)
    shared = docs.sparkSession.sparkContext.broadcast(held)
    rows = box.df.withColumn(body, F.col(body).cast("string"))
    if model.rest:
        whole = or_empty(F.col(body))
        rows = rows.withColumns({"h1": F.xxhash64(whole), "h2": F.xxhash64(F.lit(1), whole)})
        found = _scored(rows.select("h1", "h2", F.col(body).alias("text")), model, shared)
        return box.restored(rows.join(found, ["h1", "h2"]))
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            if scorer.unseen > HELD:
                scorer.start()
            found = [scorer.score(t.as_py() or "") for t in batch.column(batch.schema.get_field_index(body))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names,
            )

    return box.restored(rows.mapInArrow(frugal(run), schema))


def held_out(identity: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of the identity as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(identity).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", identity: str = "doc_id") -> DataFrame:
    """``predict`` with a model fitted on the labelled rows of ``docs`` that are not held out; adds ``held_out``.

    Rows with a null identity are neither held out nor learned from.
    """
    train = docs.where(F.col(identity).isNotNull() & ~held_out(identity) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    model = fit(train.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")))
    found = predict(docs, model, text).withColumn("held_out", held_out(identity))
    release(docs.sparkSession, model)
    return found
