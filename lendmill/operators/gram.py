"""Correlations of wide tables by tiles, so that no task and not the driver holds columns squared.

Rows pass through the tasks in chunks of a fixed number of bytes. Each chunk is multiplied with
its transpose one pair of column blocks at a time; the products (tiles) of a pair are added in
rounds of at most FAN tiles a group, and the finished tile is turned into correlations where it
lies. Only one number a column leaves the tasks: its largest absolute correlation with a column
before it. Values are shifted by the means of some rows first, which guards the sums against
cancellation and changes no result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.session import materialise

BLOCK = 512            # columns of a block: a tile holds 2 MB
CHUNK_BYTES = 1 << 27  # values of a chunk of rows
BATCH_BYTES = 1 << 25  # values of an Arrow batch
FAN = 64               # tiles added in one group
SHIFT_ROWS = 100
TILE = "i int, j int, part long, n long, sums binary, tile binary"


def _centre(rows: DataFrame, width: int) -> np.ndarray:
    seen = np.array([r[0] for r in rows.limit(SHIFT_ROWS).collect()], float).reshape(-1, width)
    known = np.isfinite(seen)
    return np.where(known, seen, 0).sum(0) / np.maximum(known.sum(0), 1)


def _tiles(rows: DataFrame, width: int, centre: np.ndarray, block: int) -> DataFrame:
    """Per chunk of rows and pair of column blocks i <= j: sums of block j and the product."""
    most = max(1, CHUNK_BYTES // (8 * width))

    def products(x: np.ndarray, part: int):
        for j in range(0, width, block):
            right = x[:, j:j + block]
            for i in range(0, j + 1, block):
                yield (i // block, j // block, part, len(x), right.sum(0).tobytes(),
                       (x[:, i:i + block].T @ right).tobytes())

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        held, rows_held, part = [], 0, 0
        schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("part", pa.int64()),
                            ("n", pa.int64()), ("sums", pa.binary()), ("tile", pa.binary())])

        def emit():
            # invalid numbers give invalid correlations, without a warning for each
            with np.errstate(invalid="ignore", over="ignore"):
                for row in products(np.concatenate(held), (part << 32) + task):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            x = values.astype(float).reshape(-1, width) - centre
            for a in range(0, len(x), most):
                held.append(x[a:a + most])
                rows_held += len(held[-1])
                if rows_held >= most:
                    yield from emit()
                    held, rows_held, part = [], 0, part + 1
        if held:
            yield from emit()

    return rows.mapInArrow(run, TILE)


def _added(group: pd.DataFrame) -> pd.DataFrame:
    first = group.iloc[0]
    out = [np.sum([np.frombuffer(v) for v in group[c]], axis=0).tobytes()
           for c in ("sums", "tile")]
    return pd.DataFrame([[first["i"], first["j"], first["part"] // FAN, group["n"].sum(), *out]],
                        columns=["i", "j", "part", "n", "sums", "tile"])


def _numbered(tiles: DataFrame) -> tuple[DataFrame, int]:
    """Chunks numbered from 0: there is one per CHUNK_BYTES of the table."""
    names = sorted(r[0] for r in tiles.where("i = 0 AND j = 0").select("part").collect())
    spark = tiles.sparkSession
    if not names:
        return tiles, 0
    order = spark.createDataFrame(list(zip(names, range(len(names)))), "part long, _at long")
    return tiles.join(order, "part").select("i", "j", F.col("_at").alias("part"), "n", "sums",
                                            "tile"), len(names)


def highest_earlier(df: DataFrame, columns: list[str], block: int = BLOCK) -> dict[str, float]:
    """For each column, its largest absolute Pearson correlation with any column before it.

    A column with a missing or infinite value, or without spread, correlates with none.
    """
    spark, width = df.sparkSession, len(columns)
    rows = df.select(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))
                               for c in columns]).alias("x"))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(max(1, BATCH_BYTES // (8 * width))))
    try:
        tiles = materialise(_tiles(rows, width, _centre(rows, width), block), "gram-tiles")
    finally:
        spark.conf.set(setting, before)
    tiles, parts = _numbered(tiles)
    while parts > 1:
        tiles = materialise(
            tiles.groupBy("i", "j", F.expr(f"part div {FAN}").alias("_group"))
            .applyInPandas(_added, TILE), "gram-sums")
        parts = -(-parts // FAN)

    # n, sum and sum of squares of each column: the diagonals
    n, sums, squares = 0, np.zeros(width), np.zeros(width)

    def diagonal(batches):
        for part in batches:
            side = [len(v) // 8 for v in part["sums"]]
            yield pd.DataFrame({
                "j": part["j"], "n": part["n"], "sums": part["sums"],
                "squares": [np.frombuffer(t).reshape(s, s).diagonal().tobytes()
                            for t, s in zip(part["tile"], side)]})

    for r in tiles.where("i = j").select("j", "n", "sums", "tile").mapInPandas(
            diagonal, "j int, n long, sums binary, squares binary").collect():
        at = slice(r.j * block, r.j * block + block)
        n, sums[at], squares[at] = r.n, np.frombuffer(r.sums), np.frombuffer(r.squares)
    if n == 0:
        return dict.fromkeys(columns, 0.0)
    mean = sums / n
    with np.errstate(invalid="ignore", over="ignore"):
        scale = np.sqrt(np.maximum(squares - n * mean * mean, 0))

    def best(batches):
        for part in batches:
            for i, j, tile in zip(part["i"], part["j"], part["tile"]):
                left, right = (slice(b * block, min(width, (b + 1) * block)) for b in (i, j))
                with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                    r = np.frombuffer(tile).reshape(left.stop - left.start, -1)
                    r = np.abs((r - n * np.outer(mean[left], mean[right]))
                               / np.outer(scale[left], scale[right]))
                r = np.where(np.isfinite(r), np.minimum(r, 1.0), 0.0)
                if i == j:
                    r = np.triu(r, 1)
                yield pd.DataFrame({"col": np.arange(right.start, right.stop), "r": r.max(0)})

    found = tiles.select("i", "j", "tile").mapInPandas(best, "col int, r double") \
        .groupBy("col").agg(F.max("r").alias("r")).collect()
    top = {r.col: r.r for r in found}
    return {c: float(top.get(k, 0.0)) for k, c in enumerate(columns)}
