"""Approximate nearest neighbours with randomly rotated one-bit codes.

Index: every vector goes to its nearest centroid (list). Its residual is normalised, rotated by
a fixed random orthogonal matrix and kept as one sign bit per dimension, with two correction
scalars: the residual's length and the inner product of the rotated residual with its code.
Search: for a query, the inner product with a residual is estimated from the bits and the
scalar, with an error bound that shrinks with the dimension. The best estimates are measured
exactly; that gives a distance no farther neighbour can beat, and every other vector whose lower
bound lies below it is measured too. So only a vector outside its bound can be missed.

Centroids come from k-means on a bounded sample (``sample`` rows, least hash of the id); all
rows are indexed. A query probes its nearest lists; how many is measured on the sample, so that
they hold ``recall`` of the true neighbours there (or set by ``probes``). A query goes on to the
next nearest lists until these hold 4k rows of other ids, so it gets k rows unless the table has
fewer. Lists are cut into
chunks of ``chunk_rows`` vectors and queries into blocks of ``block_rows``; a chunk meets each
block that probes its list, so a hot list is spread over many tasks and each task is bounded.

Defined results: rows with a null id, a null vector, a zero vector, a null or non-finite
component, or another dimension than most rows take no part. A repeated row is a candidate of
its own, but a row with the query's id never is; a repeated query is asked once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.session import materialise


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vec as doubles) of the rows that take part."""
    vec = F.col("vec")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"),
                          F.col(embedding).cast("array<double>").alias("vec"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & vec.isNotNull()
        & F.forall(vec, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists(vec, lambda x: x != 0.0))
    size = rows.groupBy(F.size("vec").alias("d")).count() \
        .orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("vec") == (size[0]["d"] if size else -1))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def rotation(d: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def centroids(x: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """k-means on the sample; an empty cluster keeps its place."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds if k > 1 else 1):
        near = nearest(x, c, 1)[:, 0]
        for j in range(k):
            if (near == j).any():
                c[j] = x[near == j].mean(0)
    return c


def nearest(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest rows of ``c``, nearest first."""
    far = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def probes_for(x: np.ndarray, c: np.ndarray, k: int, recall: float, queries: int = 300) -> int:
    """Lists to probe so that the share ``recall`` of exact neighbours in the sample is in them.

    The sample is thinner than the table, so its neighbours are farther away and the number is
    rather too large.
    """
    if len(c) == 1 or len(x) < 2:
        return 1
    q = x[:queries]
    far = (q * q).sum(1)[:, None] - 2 * q @ x.T + (x * x).sum(1)
    far[np.arange(len(q)), np.arange(len(q))] = np.inf
    k = min(k, len(x) - 1)
    best = np.argpartition(far, k - 1, axis=1)[:, :k]
    place = np.argsort(nearest(q, c, len(c)), axis=1)  # rank of every list for each query
    ranks = np.take_along_axis(place, nearest(x, c, 1)[:, 0][best], axis=1)
    return int(np.sort(ranks, axis=None)[int(np.ceil(recall * ranks.size)) - 1]) + 1


def encode(x: np.ndarray, c: np.ndarray, rotate: np.ndarray):
    """Packed sign bits of the rotated unit residuals, their lengths and code products."""
    r = x - c
    length = np.sqrt((r * r).sum(1))
    y = (r / np.where(length > 0, length, 1.0)[:, None]) @ rotate.T
    product = np.abs(y).sum(1) / np.sqrt(x.shape[1])
    return np.packbits(y > 0, axis=1), length, product


def bounds(bits: np.ndarray, length: np.ndarray, product: np.ndarray, query: np.ndarray,
           c: np.ndarray, rotate: np.ndarray, epsilon: float):
    """Estimated squared distances of one block of queries (rows) and their lower bounds."""
    d = query.shape[1]
    r = query - c
    far = np.sqrt((r * r).sum(1))
    v = (r / np.where(far > 0, far, 1.0)[:, None]) @ rotate.T
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32)
    # <code, v> = (2 * sum of v where the bit is set - sum of v) / sqrt(d)
    inner = (2 * (v.astype(np.float32) @ signs.T) - v.sum(1)[:, None]) / np.sqrt(d)
    safe = np.where(product > 0, product, 1.0)
    estimate = inner / safe
    slack = epsilon * np.sqrt(np.maximum(1 - safe ** 2, 0)) / safe / np.sqrt(max(d - 1, 1)) + 1e-5
    base = length ** 2 + far[:, None] ** 2
    scale = 2 * length * far[:, None]
    return base - scale * estimate, base - scale * (estimate + slack)


def best_of(ids: np.ndarray, x: np.ndarray, estimate: np.ndarray, lower: np.ndarray,
            query_id: int, query: np.ndarray, k: int):
    """The k nearest of one chunk for one query: ids and exact distances."""
    def exact(rows):
        diff = x[rows] - query
        return np.sqrt((diff * diff).sum(1))

    other = np.flatnonzero(ids != query_id)
    if len(other) <= 4 * k:
        picked = other
        distance = exact(picked)
    else:
        first = other[np.argpartition(estimate[other], 4 * k)[:4 * k]]
        distance = exact(first)
        limit = np.partition(distance, k - 1)[k - 1]
        more = other[lower[other] <= limit * limit * (1 + 1e-9)]
        more = np.setdiff1d(more, first, assume_unique=True)
        picked = np.concatenate([first, more])
        distance = np.concatenate([distance, exact(more)])
    order = np.lexsort((ids[picked], distance))[:k]
    return ids[picked][order], distance[order]


def search(vectors: DataFrame, is_query, k: int = 10, list_rows: int = 16_384,
           probes: int | None = None, recall: float = 0.98, sample: int = 20_000,
           chunk_rows: int = 8_192, block_rows: int = 2_048, epsilon: float = 3.0,
           seed: int = 11, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows by Euclidean distance.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = materialise(usable(vectors, vec_id, embedding), "ann-vectors")
    n = rows.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if n == 0:
        return spark.createDataFrame([], schema)
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    x = np.stack(taken["vec"].to_numpy())
    lists = max(1, min(-(-n // list_rows), len(x) // 40))
    # bounded by the sample: at most sample / 40 centroids and one rotation
    center, rotate = centroids(x, lists, seed), rotation(x.shape[1], seed)
    probes = probes or probes_for(x, center, k, recall)

    def index(batches):
        for batch in batches:
            x = matrix(batch.column("vec"))
            if not len(x):
                continue
            near = nearest(x, center, 1)[:, 0]
            bits, length, product = encode(x, center[near], rotate)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(near.astype(np.int32)), batch.column("vec"),
                 pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length),
                 pa.array(product)],
                names=["vec_id", "list", "vec", "bits", "length", "product"])

    def probe(batches):
        for batch in batches:
            x = matrix(batch.column("vec"))
            if not len(x):
                continue
            near = nearest(x, center, lists)
            few = np.cumsum(sizes[near], axis=1) - batch.column("own").to_numpy()[:, None] < 4 * k
            wide = np.maximum(few.sum(1) + 1, probes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vec"),
                 pa.array([r[:w].tolist() for r, w in zip(near.astype(np.int32), wide)],
                          pa.list_(pa.int32()))],
                names=["query_id", "vec", "lists"])

    indexed = materialise(rows.mapInArrow(
        index, "vec_id bigint, list int, vec array<double>, bits binary, length double, "
               "product double"), "ann-index")
    sizes = np.zeros(lists, np.int64)  # as many numbers as centroids
    for r in indexed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    asked = rows.where(is_query).groupBy("vec_id").agg(
        F.first("vec").alias("vec"), F.count("*").alias("own")).mapInArrow(
        probe, "query_id bigint, vec array<double>, lists array<int>")
    asked = materialise(asked.select("query_id", "vec", F.explode("lists").alias("list")),
                        "ann-probes")
    # one row per list: how many chunks it has and how many blocks of queries ask it
    shape = indexed.groupBy("list").agg(
        F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks")).join(
        asked.groupBy("list").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")),
        "list")
    shape = materialise(shape, "ann-lists")
    left = indexed.join(shape, "list").withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = asked.join(shape, "list").withColumn(
        "block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    def meet(have: pa.Table, want: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(have) and len(want):
            have, want = have.combine_chunks(), want.combine_chunks()
            c = center[have.column("list")[0].as_py()]
            ids = have.column("vec_id").to_numpy()
            x = matrix(have.column("vec").chunk(0))
            bits = np.frombuffer(b"".join(have.column("bits").to_pylist()), np.uint8) \
                .reshape(len(ids), -1)
            length, product = (have.column(m).to_numpy() for m in ("length", "product"))
            names = want.column("query_id").to_numpy()
            query = matrix(want.column("vec").chunk(0))
            for at in range(0, len(names), 64):  # bounds of 64 queries at once
                part = slice(at, at + 64)
                estimate, lower = bounds(bits, length, product, query[part], c, rotate, epsilon)
                for i, name in enumerate(names[part]):
                    v, s = best_of(ids, x, estimate[i], lower[i], name, query[at + i], k)
                    out_q.append(np.full(len(v), name))
                    out_v.append(v)
                    out_s.append(s)
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v),
                         "score": np.concatenate(out_s)})

    task = ["list", "chunk", "block"]
    found = left.select(*task, "vec_id", "vec", "bits", "length", "product").groupBy(*task) \
        .cogroup(right.select(*task, "query_id", "vec").groupBy(*task)) \
        .applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
