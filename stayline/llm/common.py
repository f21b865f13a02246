"""What several operators of this subpackage share: names, the shared folder, files in it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The code points that separate words, as a class for Java and Python patterns.
BLANK = "\\x20\\x09-\\x0D"
WORD = f"[^{BLANK}]+"


#: Words whose hash a task remembers; then it starts anew.
KNOWN_WORDS = 1 << 17


def frugal(run):
    """The same function over batches; when a task ends, its memory goes back to the system.

    Python workers outlive their tasks; without this, what the largest task of every stage so far has
    touched would stay with them.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow

            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered within a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Filter:
    """Bits by hash: what was put in always passes, little else does."""

    def __init__(self, bits: int, words: np.ndarray):
        self.mask, self.words = bits - 1, words

    @classmethod
    def of(cls, hashes: DataFrame, bits: int) -> Filter:
        """``hashes`` has one long column; bits that are equal meet before anything reaches the driver."""
        name = hashes.columns[0]
        at = F.shiftright(F.col(name).bitwiseAND(bits - 1), 6).alias("at")
        found = hashes.select(at, F.expr(f"shiftleft(1L, cast({name} & 63 as int))").alias("bit"))
        found = found.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
        words = np.zeros(bits >> 6, dtype=np.uint64)
        words[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return cls(bits, words)

    def has(self, hashed: int) -> bool:
        at = hashed & self.mask
        return bool(int(self.words[at >> 6]) >> (at & 63) & 1)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.mask)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Boxed:
    """A table under positional column names, so that an operator's own columns can't clash with it.

    ``df`` has the columns ``u0_, u1_, ...``; ``name(x)`` tells which one the column ``x`` is.
    ``restored`` gives the old names back, leaves out those that the results in ``made`` replace
    (whatever their case) and appends the results.
    """

    def __init__(self, df: DataFrame, *made: str):
        self.columns, self.made = df.columns, made
        self.df = df.toDF(*[f"u{i}_" for i in range(len(df.columns))])

    def name(self, column: str) -> str:
        return f"u{self.columns.index(column)}_"

    def restored(self, df: DataFrame) -> DataFrame:
        gone = {m.lower() for m in self.made}
        old = [F.col(f"u{i}_").alias(c) for i, c in enumerate(self.columns) if c.lower() not in gone]
        return df.select(*old, *self.made)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the warehouse's."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def new_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what stands there is deleted when the session ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a table or folder that ``new_path`` has named."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def save(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The same rows from a table written in the shared folder, and its path.

    Lineage ends there: a lost executor costs a read, not the work before it.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their query ends, not when the driver happens to collect its garbage.

    For steps that run once and end in ``save``: a query run a second time would have to make them anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def store(path: str):
    """A file system of pyarrow and the path in it, for files that tasks write or read themselves."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))
