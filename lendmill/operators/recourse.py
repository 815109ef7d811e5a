"""Suggestions that the model has scored: the smallest single move that reaches the target.

Per feature the candidates are the quantiles of a population. All candidates of a block of rows
are scored at once inside the task (a tree only turns where it splits the moved feature), and per
feature the one nearest in rank that reaches the target
probability is suggested, with the probability it leads to. The narrow input is spread once;
the quantile grid (features x steps numbers) and the model travel with the function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendmill.operators.quantiles import exact_quantiles
from lendmill.operators.scorer import moved_by, scorer_of
from lendmill.operators.shap import feature_array
from lendmill.operators.train import Fitted

SCORED_ROWS = 512
MOVE = [("feature", pa.string()), ("current_value", pa.float64()),
        ("suggested_value", pa.float64()), ("steps", pa.int32()), ("probability", pa.float64()),
        ("reaches", pa.bool_())]
MOVES = T.ArrayType(T.StructType([
    T.StructField("feature", T.StringType()), T.StructField("current_value", T.DoubleType()),
    T.StructField("suggested_value", T.DoubleType()), T.StructField("steps", T.IntegerType()),
    T.StructField("probability", T.DoubleType()), T.StructField("reaches", T.BooleanType())]))


def moves_of(x: np.ndarray, grid: np.ndarray, movable: np.ndarray, score, change: float,
             most: int, names: list[str]) -> pa.RecordBatch:
    """(probability, target, suggestions) of rows x features ``x``; ``grid``: features x steps,
    ascending. A feature that is not movable only "moves" to its own value.

    Above one half the target lies ``change`` lower, otherwise higher. Moves that reach it come
    first, by steps in rank, then by feature order; if none does, the one that comes closest.
    """
    (rows, width), steps = x.shape, grid.shape[1]
    columns = np.ascontiguousarray(x.T)
    p = score(columns)
    down = p > 0.5
    target = np.where(down, p - change, p + change)
    found = moved_by(score, columns, grid, movable)       # features x steps x rows
    reaches = np.where(down, found <= target, found >= target)
    away = np.empty(found.shape, np.int32)
    step = np.arange(steps, dtype=np.int32)[:, None]
    for j in range(width):
        values = grid[j][:, None] if movable[j] else np.broadcast_to(columns[j], (steps, rows))
        place = (values < columns[j]).sum(axis=0, dtype=np.int32)
        away[j] = np.where(values >= columns[j], step - place + (values != columns[j]),
                           place - step)
    cost = np.where(reaches, away, steps + 2)
    best = cost.argmin(axis=1)                            # features x rows
    least = np.take_along_axis(cost, best[:, None], axis=1)[:, 0]
    ok = np.take_along_axis(reaches, best[:, None], axis=1)[:, 0]
    order = np.argsort(np.where(ok, least, np.iinfo(np.int32).max), axis=0, kind="stable")[:most]
    taken = np.minimum(ok.sum(axis=0), most)
    none = np.flatnonzero(taken == 0)
    if len(none):
        gain = np.where(down[none], -found[:, :, none], found[:, :, none])
        j, b = np.unravel_index(gain.reshape(-1, len(none)).argmax(axis=0), (width, steps))
        order[0, none], best[j, none], taken[none] = j, b, 1
    # the suggestions of all rows one after another
    row = np.repeat(np.arange(rows), taken)
    starts = np.concatenate([[0], np.cumsum(taken)])
    j = order[np.arange(len(row)) - starts[row], row]
    b = best[j, row]
    own = columns[j, row]
    parts = [pa.array(np.array(names, object)[j], pa.string()), pa.array(own),
             pa.array(np.where(movable[j], grid[j, b], own)), pa.array(away[j, b, row]),
             pa.array(found[j, b, row]), pa.array(reaches[j, b, row])]
    moves = pa.StructArray.from_arrays(parts, fields=[pa.field(n, t) for n, t in MOVE])
    return pa.RecordBatch.from_arrays(
        [pa.array(p), pa.array(target), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), moves)],
        names=["probability", "target", "suggestions"])


def scored_moves(df: DataFrame, fitted: Fitted, population: DataFrame, change: float = 0.1,
                 most: int = 3, steps: int = 21, id_col: str = "app_id",
                 movable: list[str] | None = None) -> DataFrame:
    """(id, probability, target, suggestions) for every row of a feature table; ``movable``
    limits the features that suggestions may change."""
    names = fitted.features
    ranks = [k / (steps - 1) for k in range(steps)]
    cuts = exact_quantiles(population, names, ranks)
    free = [n for n in (movable or names) if cuts[n][0] is not None]
    grid = np.array([cuts[n] if n in free else [np.nan] * steps for n in names], np.float64)
    make = scorer_of(fitted, df.sparkSession)
    movable_at = np.array([n in free for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names))
            # as many rows at once as keep their candidates' scores in the processor's cache
            for a in range(0, len(x), SCORED_ROWS):
                made = moves_of(x[a:a + SCORED_ROWS], grid, movable_at, score, change, most, names)
                ids = batch.column(id_col).slice(a, SCORED_ROWS)
                yield pa.RecordBatch.from_arrays([ids, *made.columns],
                                                 names=[id_col, *made.schema.names])

    # every row costs features x steps model calls: spread the narrow input evenly first
    spark = df.sparkSession
    tasks = 4 * max(spark.sparkContext.defaultParallelism,
                    int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(id_col, feature_array(names).alias("x")).repartition(tasks, id_col)
    return rows.mapInArrow(run, T.StructType([
        T.StructField(id_col, df.schema[id_col].dataType), T.StructField("probability", T.DoubleType()),
        T.StructField("target", T.DoubleType()), T.StructField("suggestions", MOVES)]))
