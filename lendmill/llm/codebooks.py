"""Vector code compression: product codebooks by member-resident Lloyd rounds.

Vectors become integers, floor(scale * x), and are cut into equal consecutive parts. The parts are
dealt once to owners by (position, entry, salt) and written there; the salt spreads an entry that
holds very many parts over several owners. In a round the owners sum their resident members (the
update), the entries move, and every owner assigns its members again where they lie. Only the
parts that change their entry are shuffled, to their new owners: the next residents are those
that stayed, read from where they lie, and the arrivals. Coordinates are summed as integers, so
the result does not depend on tasks or retries. The codebook (positions x entries x width numbers) is all
that reaches the driver.

The codes of the vectors are the nearest entries of the final codebook, one projection over them.

Defined results: a vector that is null or holds a null or non-finite component is dropped;
repeated rows are members of their own, also in the first entries (vec_id ascending, nulls last,
then the vector); ties go to the lower entry; an unused entry stays; with fewer vectors than
entries there are fewer entries; an empty table gives an empty table. The width is that of the
first vector; vectors of another width take no part. It must be a multiple of the positions,
and components must stay below 2**27 in size when scaled (ValueError, or a failing task).
Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.session import materialise

LIMIT = 1 << 27   # components beyond it could not be summed exactly
BLOCK = 4_096     # vectors that one step measures against a codebook


@dataclass
class Codebooks:
    """``entries``: positions x entries x width integers."""

    entries: np.ndarray
    scale: float

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has components, all of them finite."""
    finite = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(F.col(vector).isNotNull() & finite)


def integers(batch: pa.RecordBatch, name: str, width: int, scale: float) -> np.ndarray:
    """Rows x width integers floor(scale * x)."""
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    found = np.floor(flat * scale)
    if len(found) and np.abs(found).max() >= LIMIT:
        raise ValueError("a component is too large for exact sums")
    return found.astype(np.int64).reshape(-1, width)


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (rows x entries), exact: as doubles while all terms stay below 2**53."""
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if parts.shape[1] * (2 * most) ** 2 < 1 << 52:
        x, e = parts.astype(np.float64), entries.astype(np.float64)
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ e.T) + (e * e).sum(axis=1)
    return ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every row (ties: the lower one) and its squared distance."""
    at, error = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, len(parts), BLOCK):
        d = distances(parts[start:start + BLOCK], entries)
        best = d.argmin(axis=1)
        at.append(best)
        error.append(d[np.arange(len(d)), best].astype(np.int64))
    return np.concatenate(at), np.concatenate(error)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


PART = T.StructType([
    T.StructField("position", T.IntegerType(), False), T.StructField("entry", T.IntegerType(), False),
    T.StructField("salt", T.IntegerType(), False),
    T.StructField("part", T.ArrayType(T.IntegerType(), False), False)])


def _part_rows(position, entry, salt, parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x).astype(np.int32)) for x in (position, entry, salt)]
        + [_lists(parts.astype(np.int32))], names=PART.names)


def _owners(parts: DataFrame, name: str, tasks: int) -> DataFrame:
    """Deal parts to their owners and write them there."""
    return materialise(parts.repartition(tasks, "position", "entry", "salt"), name)


def _totals(members: DataFrame, width: int) -> DataFrame:
    """(position, entry, n, sums) of resident members; summed in the owners' tasks first."""
    sums = F.array(*[F.sum(F.col("part")[i].cast("bigint")) for i in range(width)])
    return members.groupBy("position", "entry").agg(F.count("*").alias("n"), sums.alias("sums"))


def _update(entries: np.ndarray, totals: DataFrame) -> np.ndarray:
    """New entries: floor(sum / count) by component; an entry without members stays."""
    out = entries.copy()
    for r in totals.collect():  # positions x entries rows at most
        out[r.position, r.entry] = np.array([s // r.n for s in r.sums], np.int64)
    return out


def fit(vectors: DataFrame, vector: str = "embedding", order: str = "vec_id", positions: int = 16,
        size: int = 64, rounds: int = 2, scale: float = 256.0) -> Codebooks:
    """Codebooks after ``rounds`` of assignment and update."""
    spark = vectors.sparkSession
    # a hot entry is spread over as many owners as there are tasks, by the row's own id
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism)
    salt = F.pmod(F.xxhash64(order), F.lit(min(tasks, 1 << 12))).cast("int")
    rows = usable(vectors, vector).select(F.col(order).alias("at"), F.col(vector).alias("x"),
                                          salt.alias("salt"))
    first = rows.orderBy(F.col("at").asc_nulls_last(), "x").limit(1).collect()
    if not first:
        return Codebooks(np.zeros((positions, 0, 0), np.int64), scale)
    width = len(first[0].x)
    if width % positions or not width:
        raise ValueError(f"vectors of width {width} cannot be cut into {positions} equal parts")
    part = width // positions
    rows = rows.where(F.size("x") == width)
    start = rows.orderBy(F.col("at").asc_nulls_last(), "x").limit(size).collect()
    begin = np.floor(np.array([r.x for r in start], np.float64) * scale)
    if np.abs(begin).max() >= LIMIT:
        raise ValueError("a component is too large for exact sums")
    entries = begin.astype(np.int64).reshape(-1, positions, part).transpose(1, 0, 2).copy()

    def deal(book: np.ndarray):
        """The parts of every vector with their nearest entries."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = integers(batch, "x", width, scale).reshape(-1, positions, part)
                salt = batch.column("salt").to_numpy()
                for p in range(positions):
                    at, _ = nearest(x[:, p], book[p])
                    yield _part_rows(np.full(len(x), p), at, salt, x[:, p])
        return run

    def again(book: np.ndarray, stays: bool):
        """Members under a new codebook: those that stay, or those that leave with their entry."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                position, entry, salt = (batch.column(n).to_numpy() for n in PART.names[:3])
                parts = batch.column("part").flatten().to_numpy().reshape(-1, part)
                new = np.empty(len(parts), np.int64)
                for p in np.unique(position):
                    mine = position == p
                    new[mine], _ = nearest(parts[mine].astype(np.int64), book[p])
                kept = (new == entry) if stays else (new != entry)
                yield _part_rows(position[kept], new[kept], salt[kept], parts[kept])
        return run

    residents = None
    for k in range(rounds):
        if residents is None:
            residents = _owners(rows.select("x", "salt").mapInArrow(deal(entries), PART),
                                "residents", tasks)
        else:
            movers = residents.mapInArrow(again(entries, False), PART)
            arrivals = _owners(movers, "arrivals", tasks)
            stayed = residents.mapInArrow(again(entries, True), PART)
            residents = stayed.unionByName(arrivals)
        entries = _update(entries, _totals(residents, part))
    return Codebooks(entries, scale)


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding",
           keep=("vec_id", "label")) -> DataFrame:
    """(kept columns, code as array of entry numbers, error): one projection over the vectors."""
    entries, scale = books.entries, books.scale
    positions, _, part = entries.shape
    width = positions * part
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch, "_x", width, scale).reshape(-1, positions, part)
            code = np.empty((len(x), positions), np.int32)
            error = np.zeros(len(x), np.int64)
            for p in range(positions):
                code[:, p], d = nearest(x[:, p], entries[p])
                error += d
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], _lists(code), pa.array(error)],
                names=[*keep, "code", "error"])

    source = usable(vectors, vector).where(F.size(vector) == (width or -1))
    fields = [vectors.schema[k] for k in keep]
    return source.select(*keep, F.col(vector).alias("_x")).mapInArrow(run, T.StructType([
        *fields, T.StructField("code", T.ArrayType(T.IntegerType(), False)),
        T.StructField("error", T.LongType())]))


def with_group_total(df: DataFrame, group: str, value: str, name: str, hot: int = 64) -> DataFrame:
    """Append the sum of ``value`` over equal ``group`` (nulls together).

    Groups with more than 1/``hot`` of all rows, fewer than ``hot``, are looked up by broadcast;
    the others are too small to make a task of a shuffled join large.
    """
    totals = materialise(df.groupBy(F.col(group).alias("_g")).agg(
        F.sum(value).alias(name), F.count("*").alias("_n")), "totals")
    rows = totals.agg(F.sum("_n").alias("n")).first().n or 0
    large = [r["_g"] for r in totals.where(F.col("_n") * hot > rows).select("_g").collect()]
    named = [g for g in large if g is not None]
    is_large = F.col(group).isin(named) if named else F.lit(False)
    is_large = F.when(F.col(group).isNull(), F.lit(None in large)).otherwise(is_large)
    of_large = F.broadcast(totals.where(F.col("_n") * hot > rows).drop("_n"))
    of_small = totals.where(F.col("_n") * hot <= rows).drop("_n")
    columns = [*df.columns, name]
    same = F.col(group).eqNullSafe(F.col("_g"))
    return df.where(is_large).join(of_large, same).select(*columns).unionByName(
        df.where(~is_large).join(of_small, same).select(*columns))


def hex_code(code: str = "code"):
    """Two hex digits per entry number, in part order."""
    return F.lower(F.array_join(F.transform(code, lambda x: F.lpad(F.hex(x), 2, "0")), ""))


def oracle(positions: int = 16, size: int = 64, rounds: int = 2) -> str:
    """The codes of ``embeddings`` in SQL."""
    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT x.r, x.p, c.e, list_sum(list_transform(list_zip(x.v, c.v),
             lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d,
           row_number() OVER (PARTITION BY x.r, x.p ORDER BY d, c.e) AS place
    FROM parts x JOIN c{k} c USING (p)) WHERE place = 1)"""

    def updated(k: int) -> str:
        return f"""t{k} AS (
  SELECT p, e, i, sum(x.v[i])::BIGINT AS s, count(*) AS n
  FROM a{k} JOIN parts x USING (r, p), range(1, len(x.v) + 1) AS g(i) GROUP BY ALL),
u{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
         FROM t{k} GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(u.v, c.v) AS v
         FROM c{k} c LEFT JOIN u{k} u USING (p, e))"""

    steps = ",\n".join(f"{assigned(k)},\n{updated(k)}" for k in range(rounds))
    return f"""
WITH good AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding,
         lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {positions}) + 1:(p + 1) * (len(v) // {positions})] AS v
  FROM good, range({positions}) AS g(p)),
c0 AS (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {size}),
{steps},
{assigned(rounds)},
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
                 sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM c{rounds})
         AS codebooks_sha256
FROM codes JOIN good USING (r)"""
