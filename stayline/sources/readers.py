"""Table scans.  CSV columns stay text unless a schema is given; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    columns: list[str] | None = None,
    schema: T.StructType | str | None = None,
    encoding: str | None = None,
    row_limit: int | None = None,
    sample: float | None = None,
    sample_key: str | None = None,
) -> DataFrame:
    """A file or a directory of files (.csv, .csv.gz or Parquet) as a DataFrame.

    ``columns`` are pruned in the scan.  ``row_limit`` takes any n rows.  ``sample`` takes a
    share of rows, by hash of ``sample_key`` where given, so that it is the same on every run.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"')
        if encoding:
            reader = reader.option("encoding", encoding)
        df = reader.csv(path)
    elif format == "parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"unknown format {format!r}")
    if columns:
        df = df.select(*columns)
    if sample is not None:
        df = sampled(df, sample, sample_key)
    return df.limit(row_limit) if row_limit is not None else df


def sampled(df: DataFrame, share: float, key: str | None = None, seed: int = 42) -> DataFrame:
    """A share of rows; by hash of a key the choice does not depend on partitioning."""
    if key is None:
        return df.sample(share, seed=seed)
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed).cast("string"), F.col(key).cast("string"))), 1, 8), 16, 10)
    return df.where(F.pmod(draw.cast("bigint"), F.lit(10_000)) < round(share * 10_000))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """The table, or an empty one of the given schema where the source does not ship it."""
    if path_exists(spark, path):
        return read_raw(spark, path, **options)
    return spark.createDataFrame([], schema)


def pick_column(df: DataFrame, candidates: list[str]) -> Column | None:
    """The first of several possible columns that the table has."""
    found = next((c for c in candidates if c in df.columns), None)
    return F.col(found) if found else None


def read_dirty_csv(spark: SparkSession, path: str, columns: list[str], seen: Observation | None = None) -> DataFrame:
    """Comma-split lines without quoting rules; double quotes at the ends of fields removed.

    Lines with too many fields are skipped, short lines are padded with null.  The header line
    of every file is recognised by its column names.  ``_line`` rises in file order.  After an action
    that reads all lines, ``seen`` has their number, and how many were skipped and padded.
    """
    fields = F.transform(F.split("value", ","), lambda f: F.btrim(f, F.lit('"')))
    lines = spark.read.text(path).select(
        fields.alias("_f"), F.monotonically_increasing_id().alias("_line")
    )
    header = F.array(*[F.lit(c) for c in columns])
    if seen is not None:
        wide, short = F.size("_f") > len(columns), F.size("_f") < len(columns)
        lines = lines.observe(
            seen, F.count_if(F.col("_f") != header).alias("lines"), F.count_if(wide).alias("skipped"), F.count_if(short).alias("padded")
        )
    kept = lines.where((F.size("_f") <= len(columns)) & (F.col("_f") != header))
    return kept.select(
        *[
            F.when(F.get("_f", F.lit(i)) != "", F.get("_f", F.lit(i))).alias(c)
            for i, c in enumerate(columns)
        ],
        "_line",
    )


def unquote(c: Column) -> Column:
    """Content of a value wrapped in single quotes, without outer blanks."""
    return F.trim(F.substring(c, F.lit(2), F.greatest(F.lit(0), F.length(c) - 2)))


# Columns of the class table, quotes included.
CLASS_CODE, CLASS_LEVEL1 = "'ICD-9-CM CODE'", "'CCS LVL 1'"


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """Diagnosis class table: (code, category), the category counted from 0."""
    raw = read_raw(spark, path)
    return classes_of(raw, CLASS_CODE, CLASS_LEVEL1)


def classes_of(raw: DataFrame, code: str, level: str) -> DataFrame:
    return raw.select(
        unquote(F.col(f"`{code}`")).alias("code"),
        (unquote(F.col(f"`{level}`")).try_cast("int") - 1).alias("category"),
    )
