import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The folder that a cluster would name; set only where it is unset."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang, source]) tuples, with extra columns whose names clash with results."""

    def build(rows, extra=True):
        full = [(r[0], r[1], *(r[2:] if len(r) == 4 else ("en", "s")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("size", "key", "Row", "id", "n", "target", "score", "a.b", "`"):
                df = df.withColumn(name.replace("`", "tick"), df["doc_id"].cast("string"))
        return df

    return build


def words(seed, n, vocabulary=5000):
    import random

    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]
