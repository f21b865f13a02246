"""Approximate nearest neighbours by randomly rotated one-bit codes, reranked inside error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import drop_path, save

#: Vectors of an index block and queries of a query block; both bound what one task holds.
INDEX_BLOCK = 8192
QUERY_BLOCK = 512


def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """A random map of ``dim`` to ``bits`` dimensions that keeps inner products."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:, :dim]


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated vectors, their norms, and the cosine between each and its code."""
    norms = np.linalg.norm(vectors, axis=1)
    turned = (vectors / norms[:, None]) @ turn.T
    return np.packbits(turned > 0, axis=1), norms, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])


def search_block(
    queries: np.ndarray, own: np.ndarray, codes: np.ndarray, norms: np.ndarray, cosines: np.ndarray,
    vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, turn: np.ndarray, top: int, width: float,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the places of its ``top`` best vectors in the block, and their exact inner products.

    The estimate of an inner product is that of the code with the rotated query over ``cosines``, and its
    error is at most ``width`` standard deviations.  The exact products of the best lower bounds
    give a threshold; every vector whose upper bound reaches it is ranked by its exact product.
    """
    bits = turn.shape[0]
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    turned = (queries @ turn.T).astype(np.float32)
    scale = (norms / (np.sqrt(bits) * cosines)).astype(np.float32)
    spread = width * norms * np.sqrt(np.maximum(0, 1 - cosines**2)) / (cosines * np.sqrt(bits - 1))
    estimates = (turned @ signs.T) * scale
    lengths = np.linalg.norm(queries, axis=1)
    for i, query in enumerate(queries):
        error = spread * lengths[i]
        low = estimates[i] - error
        low[rows == own[i]] = -np.inf
        usable = len(low) - int((rows == own[i]).sum())
        count = min(top, usable)
        if not count:
            yield np.zeros(0, dtype=np.int64), np.zeros(0)
            continue
        first = np.argpartition(-low, count - 1)[:count]
        least = (vectors[first].astype(np.float64) * query).sum(axis=1).min()
        picked = np.flatnonzero((estimates[i] + error >= least - 1e-6 * abs(least)) & (rows != own[i]))
        picked = np.union1d(picked, first[rows[first] != own[i]])
        exact = (vectors[picked].astype(np.float64) * query).sum(axis=1)
        order = np.lexsort((rows[picked], ids[picked], -exact))[:top]
        yield picked[order], exact[order]


def _dimension(vectors: DataFrame) -> int:
    """The most frequent length, the smaller of equals; 0 without vectors."""
    found = vectors.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    first = found.orderBy(F.desc("n"), "dim").first()
    return first["dim"] if first else 0


def _blocks(size: int, parts_of: int, turn: np.ndarray | None):
    """(row, id, vector) to numbered blocks of up to ``size``; with a rotation also codes and scalars.

    Block ``k`` of partition ``p`` has the number ``p + k * parts_of``.
    """

    def pack(number: int, rows: list[np.ndarray], ids: list[np.ndarray], vectors: list[np.ndarray]) -> pa.RecordBatch:
        row, own, matrix = np.concatenate(rows), np.concatenate(ids), np.concatenate(vectors)
        parts = [row.tobytes(), own.tobytes(), matrix.tobytes()]
        if turn is not None:
            codes, norms, cosines = encode(matrix.astype(np.float64), turn)
            parts += [codes.tobytes(), norms.tobytes(), cosines.tobytes()]
        names = ["block", "n", "rows", "ids", "vectors", "codes", "norms", "cosines"][: 2 + len(parts)]
        columns = [pa.array([number], pa.int64()), pa.array([len(row)], pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array([p], pa.binary()) for p in parts]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, count = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            vectors = batch.column(2)
            matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            row, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = 0
            while at < len(batch):
                take = min(size - count, len(batch) - at)
                held.append((row[at : at + take], own[at : at + take], matrix[at : at + take]))
                count, at = count + take, at + take
                if count == size:
                    yield pack(number, *map(list, zip(*held)))
                    number, held, count = number + parts_of, [], 0
        if count:
            yield pack(number, *map(list, zip(*held)))

    return run


def search(
    embeddings: DataFrame, query: Column, top: int = 20, bits: int = 256, width: float = 4.0, seed: int = 7,
    identity: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest rows by inner product for each row where ``query`` holds.

    Every row but the query's own is a candidate, also one of the same identity.  Scores are inner
    products of the original vectors in double precision; ties go to the smaller identity, null
    identities last.  Vectors that are null, zero, hold null or non-finite components, or have
    another length than most vectors (the smaller of equally frequent lengths) take no part.
    ``bits`` (at least the dimension) is the length of the codes, ``width`` the error bound in
    standard deviations; a neighbour is missed only if its estimate is off by more.

    Scale: the index holds every vector, in blocks packed where the vectors lie.  Each query block
    meets each index block once (a stated query set against all rows, in blocks); only the query
    blocks are repeated, and a pair of blocks gives at most ``top`` rows per query.
    """
    spark = embeddings.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    vector = F.col(embedding).cast("array<double>")
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col(identity).cast("long").alias("id"), vector.alias("vector"), query.alias("asks"))
    rows = rows.where(sound & F.exists("vector", lambda x: x != 0)).withColumn("row", F.monotonically_increasing_id())
    rows, rows_path = save(rows, "onebit-vectors")
    dim = _dimension(rows)
    rows = rows.where(F.size("vector") == dim)
    count, asked = rows.agg(F.count("*"), F.count_if(F.coalesce("asks", F.lit(False)))).first()
    if not dim or not asked:
        return spark.createDataFrame([], schema)
    bits = -(-max(bits, dim) // 8) * 8
    turn = rotation(dim, bits, seed)
    last = (1 << 63) - 1
    plain = rows.select("row", F.coalesce("id", F.lit(last)).alias("id"), "vector")
    binary = "block long, n long, rows binary, ids binary, vectors binary"
    blocks, query_blocks = -(-count // INDEX_BLOCK), -(-asked // QUERY_BLOCK)
    index = plain.repartition(blocks).mapInArrow(
        _blocks(INDEX_BLOCK, blocks, turn), binary + ", codes binary, norms binary, cosines binary"
    )
    index, index_path = save(index, "onebit-index")
    asking = rows.where("asks").select("row", F.coalesce("id", F.lit(last)).alias("id"), "vector")
    asking = asking.repartition(query_blocks).mapInArrow(_blocks(QUERY_BLOCK, query_blocks, None), binary)
    asking = asking.select(F.col("n").alias("q_n"), F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    last_block = index.agg(F.max("block")).first()[0]
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last_block))))
    pairs = index.join(asking, "block").select(
        "n", "rows", "ids", "vectors", "codes", "norms", "cosines", "q_n", "q_rows", "q_ids", "q_vectors"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                value = [c[i] for c in batch.columns]
                n, asks = value[0].as_py(), value[7].as_py()
                array = lambda k, kind: np.frombuffer(value[k].as_buffer(), kind)
                vectors, own_rows, ids = array(3, np.float64).reshape(n, dim), array(1, np.int64), array(2, np.int64)
                mine, mine_ids = array(8, np.int64), array(9, np.int64)
                found = search_block(
                    array(10, np.float64).reshape(asks, dim), mine, array(4, np.uint8).reshape(n, -1),
                    array(5, np.float64), array(6, np.float64), vectors, own_rows, ids, turn, top, width,
                )
                out = [(np.full(len(p), mine[j]), np.full(len(p), mine_ids[j]), own_rows[p], ids[p], s) for j, (p, s) in enumerate(found)]
                columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["q_row", "q_id", "row", "id", "score"])

    near = pairs.mapInArrow(run, "q_row long, q_id long, row long, id long, score double")
    place = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), "id", "row"))
    near = near.withColumn("rank", place).where(F.col("rank") <= top)
    result, _ = save(
        near.select(
            F.nullif("q_id", F.lit(last)).alias("query_id"), "rank", F.nullif("id", F.lit(last)).alias("vec_id"), "score"
        ),
        "onebit-result",
    )
    for path in (rows_path, index_path):
        drop_path(spark, path)
    return result
