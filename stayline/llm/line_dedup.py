"""Line dedup: drop lines that many documents share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import Boxed, frugal, or_empty

#: What is stripped from both ends of a line.
STRIPPED = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit digest of the normalised line (stripped, A-Z lowered); None below ``min_chars`` code points."""
    key = line.strip(STRIPPED)
    if len(key) < min_chars:
        return None
    if not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, keys = batch.column(1).cast(pa.binary()), [], []
            for i, text in enumerate(texts):
                found = {k for line in text.as_py().split(b"\n") if (k := line_key(line, min_chars))}
                rows.extend([i] * len(found))
                keys.extend(found)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary())], ["id", "key"])

    return run


def _rebuild(text: str, drops: str, min_chars: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, gone = batch.schema.get_field_index(text), batch.schema.get_field_index(drops)
            kept, lines_of, dropped_of = [], [], []
            for body, drop in zip(batch.column(at).cast(pa.binary()), batch.column(gone)):
                lines = body.as_py().split(b"\n")
                drop = set(drop.as_py() or ())
                left = [x for x in lines if line_key(x, min_chars) not in drop] if drop else lines
                kept.append(b"\n".join(left))
                lines_of.append(len(lines))
                dropped_of.append(len(lines) - len(left))
            columns = [c for i, c in enumerate(batch.columns) if i != gone]
            columns[at if at < gone else at - 1] = pa.array(kept, pa.binary()).cast(pa.string())
            columns += [pa.array(lines_of, pa.int64()), pa.array(dropped_of, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: str = "text", identity: str = "doc_id"
) -> DataFrame:
    """``docs`` with shared lines taken out of the text, plus ``n_lines n_dropped``.

    Lines are cut at ``\\n``; a null text is the empty text, which is one empty line.  A line's key
    is the line stripped of blanks, A-Z lowered.  Keys of at least ``min_chars`` code points found
    in at least ``min_docs`` documents lose all their lines, except in the largest identity that
    holds them.  The other lines stay as they are, in their order.  Rows of one identity (null
    counts as one, below all others) are one document.  Result columns replace equal names.

    Scale: a task explodes its documents into (identity, 128-bit key); the distinct pairs are
    counted per key with map-side sums, so a line that every document has is not gathered
    anywhere.  Only the pairs of shared keys return to the documents, at most one per distinct
    line of a document, and each document is put together again in place.
    """
    box = Boxed(docs, "n_lines", "n_dropped")
    own, body = box.name(identity), box.name(text)
    docs = box.df.withColumn(body, or_empty(F.col(body).cast("string")))
    kind = docs.schema[own].dataType
    pairs = (
        docs.select(own, body)
        .mapInArrow(frugal(_keys(min_chars)), T.StructType([T.StructField("id", kind), T.StructField("key", T.BinaryType())]))
        .distinct()
    )
    shared = (
        pairs.groupBy("key")
        .agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select(F.col("key").alias("shared_key"), "keeper")
    )
    gone = (
        pairs.join(shared, F.col("key") == F.col("shared_key"))
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id")
        .agg(F.collect_list("key").alias("keys"))
    )
    joined = docs.join(gone, F.col(own).eqNullSafe(F.col("id")), "left").drop("id")
    schema = T.StructType(
        [f for f in joined.schema.fields if f.name != "keys"]
        + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    return box.restored(joined.mapInArrow(frugal(_rebuild(body, "keys", min_chars, schema.fieldNames())), schema))
