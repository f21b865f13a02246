"""Quality by line labelling: a linear-chain conditional random field marks content and boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import Boxed, WordHashes, frugal, or_empty

#: The symbols that are counted, and the blanks that divide words.
SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
FEATURES = 14
#: Lines of one training sequence; longer documents of the sample are several sequences.
SEQUENCE = 128

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def repeated_words(words: list[bytes], known: WordHashes) -> int:
    """Words that stand in some window of three words found twice or more, the first one included."""
    n = len(words)
    if n < 4:
        return 0
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=n)
    windows = (h[:-2] * _A + h[1:-1]) * _B + h[2:] * _C
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] >= 2
    covered = np.zeros(n, dtype=bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def line_features(line: bytes, words: list[bytes], again: bool) -> list[float]:
    """Features of one line with at least one word, each from 0 to 1."""
    n, size = len(words), len(line)
    text = line.decode("utf-8", "replace")
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    digits = sum(map(str.isdigit, text))
    marks = sum(line.count(bytes([s])) for s in SYMBOLS)
    other = len(text) - letters - digits - sum(map(text.count, BLANKS))
    distinct = len(set(words))
    mean = size / n
    return [
        1.0,
        min(1.0, marks / n),
        upper / letters if letters else 0.0,
        min(1.0, digits / len(text)),
        min(1.0, other / n),
        float(n < 5),
        float(n < 15),
        min(1.0, mean / 20),
        float(mean < 3),
        float(again),
        1 - distinct / n,
        float(b"|" in line),
        float(line.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"')),
        float(letters < 0.6 * (letters + digits + other)),
    ]


def document(text: bytes, known: WordHashes) -> tuple[int, int, int, int, int, np.ndarray, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; of the lines with a word: features, bytes in words."""
    words = text.split()
    chars = len(text) - sum(map(text.count, (b.encode() for b in BLANKS)))
    if not text.isascii():
        chars -= int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) == 0x80))
    symbols = sum(text.count(bytes([s])) for s in SYMBOLS)
    seen: set[bytes] = set()
    again, features, weights = 0, [], []
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        twice = line in seen
        seen.add(line)
        again += twice
        features.append(line_features(line, own, twice))
        weights.append(sum(map(len, own)))
    shape = np.array(features, dtype=np.float64).reshape(-1, FEATURES)
    return len(words), chars, symbols, again, repeated_words(words, known), shape, np.array(weights, dtype=np.float64)


@dataclass
class LineModel:
    """Weights of a two-state chain: state 0 is boilerplate, 1 is content."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def best(self, features: np.ndarray) -> np.ndarray:
        """Viterbi: the most likely states of a document's lines."""
        scores = features @ self.emit
        n = len(scores)
        if not n:
            return np.zeros(0, dtype=np.int64)
        (a, b), (m00, m01), (m10, m11) = (scores[0] + self.start).tolist(), *self.move.tolist()
        back = []
        for s0, s1 in scores[1:].tolist():
            from0, from1 = a + m00 >= b + m10, a + m01 > b + m11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = (a + m00 if from0 else b + m10) + s0, (a + m01 if from1 else b + m11) + s1
        states = [int(b >= a)]
        for pair in reversed(back):
            states.append(pair[states[-1]])
        return np.array(states[::-1], dtype=np.int64)


def train(sequences: list[np.ndarray], labels: list[int], rounds: int = 150, rate: float = 0.3, decay: float = 1e-3) -> LineModel:
    """Maximum likelihood by gradient ascent (Adam); every line of a document bears the document's label.

    Classes weigh the same, whatever their number of documents.
    """
    emit, move, start = np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)
    parts = [(s[i : i + SEQUENCE], y) for s, y in zip(sequences, labels) for i in range(0, len(s), SEQUENCE)]
    parts.sort(key=lambda p: -len(p[0]))
    if not parts or len({y for _, y in parts}) < 2:
        start[1] = 1.0
        return LineModel(emit, move, start)
    longest, count = len(parts[0][0]), len(parts)
    x = np.zeros((longest, count, FEATURES))
    for j, (s, _) in enumerate(parts):
        x[: len(s), j] = s
    y = np.array([y for _, y in parts])
    lengths = np.array([len(s) for s, _ in parts])
    live = [int((lengths > t).sum()) for t in range(longest)]
    weight = np.where(y == 1, 0.5 / max(1, lengths[y == 1].sum()), 0.5 / max(1, lengths[y == 0].sum()))
    want = np.eye(2)[y]
    state = [np.zeros_like(p) for p in (emit, move, start, emit, move, start)]
    for step in range(1, rounds + 1):
        score = x @ emit
        forward = [score[0] + start]
        for t in range(1, longest):
            k = live[t]
            forward.append(np.logaddexp.reduce(forward[-1][:k, :, None] + move[None], axis=1) + score[t, :k])
        backward: list[np.ndarray] = [np.zeros((live[t], 2)) for t in range(longest)]
        for t in range(longest - 2, -1, -1):
            k = live[t + 1]
            backward[t][:k] = np.logaddexp.reduce(move[None] + (score[t + 1, :k] + backward[t + 1])[:, None, :], axis=2)
        norm = np.logaddexp.reduce(forward[0] + backward[0], axis=1)
        d_emit, d_move, d_start = np.zeros_like(emit), np.zeros_like(move), np.zeros_like(start)
        for t in range(longest):
            k = live[t]
            share = np.exp(forward[t] + backward[t] - norm[:k, None])
            gap = (want[:k] - share) * weight[:k, None]
            d_emit += x[t, :k].T @ gap
            if t == 0:
                d_start += gap.sum(axis=0)
            else:
                pair = np.exp(
                    forward[t - 1][:k, :, None] + move[None] + (score[t, :k] + backward[t])[:, None, :] - norm[:k, None, None]
                )
                d_move -= (pair * weight[:k, None, None]).sum(axis=0)
                for label in (0, 1):
                    d_move[label, label] += weight[:k][y[:k] == label].sum()
        for i, (p, g) in enumerate(((emit, d_emit), (move, d_move), (start, d_start))):
            g = g - decay * p
            state[i] = 0.9 * state[i] + 0.1 * g
            state[i + 3] = 0.99 * state[i + 3] + 0.01 * g * g
            p += rate * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 3] / (1 - 0.99**step)) + 1e-8)
    return LineModel(emit, move, start)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1500, text: str = "text", identity: str = "doc_id") -> LineModel:
    """A model from at most ``sample`` labelled documents of each quality, those of smallest text hash.

    ``labels`` has the identity and ``quality`` (0 or 1).  Only line features come to the driver.
    """
    labelled = labels.where(F.col("quality").isin(0, 1) & F.col(identity).isNotNull())
    labelled = labelled.groupBy(F.col(identity).alias("of")).agg(F.max("quality").cast("int").alias("quality"))
    rows = docs.select(F.col(identity).alias("id"), or_empty(F.col(text).cast("string")).alias("text"))
    rows = rows.withColumn("draw", F.xxhash64("text"))
    # The draw is decided without the texts; at most ``sample`` rows a class come out of each limit.
    keys = rows.select("id", "draw").join(labelled, F.col("id") == F.col("of")).select("id", "draw", "quality")
    chosen = None
    for quality in (0, 1):
        own = keys.where(F.col("quality") == quality).orderBy("draw", "id").limit(sample)
        chosen = own if chosen is None else chosen.union(own)
    chosen = chosen.collect()
    if not chosen:
        return train([], [])
    picks = docs.sparkSession.createDataFrame(chosen, keys.schema).toDF("p_id", "p_draw", "quality")
    picked = rows.join(F.broadcast(picks), (F.col("id") == F.col("p_id")) & (F.col("draw") == F.col("p_draw")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document(t.as_py(), WordHashes())[5].ravel().tolist() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))], ["id", "quality", "features"]
            )

    found = picked.select("id", "text", "quality").mapInArrow(run, "id long, quality int, features array<double>").toPandas()
    found = found.sort_values(["quality", "id"]).drop_duplicates("id")
    shapes = [np.array(list(f), dtype=np.float64).reshape(-1, FEATURES) for f in found["features"]]
    return train(shapes, found["quality"].tolist())


def rate_documents(
    docs: DataFrame, model: LineModel, text: str = "text", least_words: int = 50, most_repeated: int = 50, least_content: float = 0.5
) -> DataFrame:
    """``docs`` plus ``n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed content_share kept``.

    Words are divided by blanks; a null text has none.  ``base_failed``: fewer than ``least_words``
    words, or more than ``most_repeated`` percent of them in three-word windows found twice.  The
    model labels the lines that have a word; ``content_share`` is the part of the bytes of their
    words in lines marked as content (0 without words), and a document is kept if its base rules
    hold and this part is at least ``least_content``.  Result columns replace equal names.

    Scale: one pass over whole texts without a shuffle; the model is a few dozen numbers.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept")
    box = Boxed(docs, *made)
    body = box.name(text)
    rows = box.df.withColumn(body, or_empty(F.col(body).cast("string")))
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, k) for n, k in zip(made, kinds)]])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            out: list[list] = [[] for _ in made]
            for value in batch.column(batch.schema.get_field_index(body)).cast(pa.binary()):
                *counts, features, weights = document(value.as_py(), known)
                states = model.best(features)
                share = float((weights * states).sum() / weights.sum()) if len(weights) else 0.0
                failed = counts[0] < least_words or 100 * counts[4] > most_repeated * counts[0]
                for column, x in zip(out, [*counts, failed, share, not failed and share >= least_content]):
                    column.append(x)
            arrow = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, k) for c, k in zip(out, arrow)]], names)

    return box.restored(rows.mapInArrow(frugal(run), schema))
