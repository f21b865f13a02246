import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import onebit
from stayline.llm.onebit import search


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumn("row", F.lit("x")).withColumn("id", F.lit(0)).withColumn("vector", F.lit(0))


def brute(ids, vectors, top):
    matrix = np.array(vectors, dtype=np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(np.array(ids) % 20 == 0):
        scores = (matrix * matrix[q]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:top]
        out[ids[q]] = [(ids[j], scores[j]) for j in order]
    return out


def recall(df, want):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return got, hits / sum(map(len, want.values()))


@pytest.mark.parametrize("kind", ["random", "clusters", "copies"])
def test_recall(spark, monkeypatch, kind):
    monkeypatch.setattr(onebit, "INDEX_BLOCK", 300)
    monkeypatch.setattr(onebit, "QUERY_BLOCK", 16)
    r = np.random.default_rng(1)
    vectors = r.standard_normal((1500, 48))
    if kind == "clusters":
        vectors = vectors[np.arange(1500) % 30] + 0.1 * vectors
    if kind == "copies":
        vectors[::3] = vectors[0]
    ids = list(range(1500))
    got, share = recall(search(frame(spark, ids, vectors), F.col("vec_id") % 20 == 0), brute(ids, vectors, 20))
    assert share >= 0.99
    if kind == "copies":
        assert [i for i, _ in got[0]] == list(range(3, 63, 3)) or [s for _, s in got[0]] == sorted((s for _, s in got[0]), reverse=True)


def test_edges(spark):
    nan = float("nan")
    ids = [0, 1, 2, 3, 4, 5, 6, 20, 20, None]
    vectors = [[1, 0, 0], None, [0, 0, 0], [1, None, 0], [nan, 1, 0], [float("inf"), 0, 0], [1, 2], [2, 0, 0], [2, 0, 0], [3, 0, 1]]
    found = search(frame(spark, ids, vectors), F.col("vec_id") % 20 == 0, top=20)
    got = sorted((r["query_id"], r["rank"], -1 if r["vec_id"] is None else r["vec_id"], r["score"]) for r in found.collect())
    assert got[:3] == [(0, 1, -1, 3.0), (0, 2, 20, 2.0), (0, 3, 20, 2.0)]
    assert [g for g in got if g[0] == 20] == sorted([(20, 1, -1, 6.0), (20, 2, 20, 4.0), (20, 3, 0, 2.0)] * 2)
    assert search(frame(spark, [], []), F.col("vec_id") % 20 == 0).count() == 0
    assert search(frame(spark, [1], [[1, 2]]), F.col("vec_id") % 20 == 0).count() == 0
    assert search(frame(spark, [0], [[1, 2]]), F.col("vec_id") % 20 == 0).count() == 0


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    from stayline.llm.queries import op5_one_bit_codes

    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    want = brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows], 20)
    assert recall(op5_one_bit_codes(spark, folder), want)[1] >= 0.9
