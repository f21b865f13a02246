"""Word frequencies of the text columns of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.tokens import column
from stayline.functions.words import words_of


def text_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """String columns except keys, times and declared exclusions.

    String columns that hold only numbers need no check: without digits and symbols nothing of
    them is left to count.
    """
    return [name for name, kind in df.dtypes if kind == "string" and name not in exclude]


def word_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows (table, column, word, cnt): one pass over all columns, counted before the shuffle."""
    if not columns:
        raise ValueError(f"{table} has no text column")
    listed = F.array(
        *[F.struct(F.lit(c).alias("column"), words_of(column(c)).alias("words")) for c in columns]
    )
    return (
        df.select(F.explode(listed).alias("_c"))
        .select("_c.column", F.explode("_c.words").alias("word"))
        .groupBy("column", "word")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.lit(table).alias("table"), "column", "word", "cnt")
    )


def union_counts(counts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, counts)
