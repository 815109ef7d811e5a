"""Exact quantiles of many columns without sorting, shuffling or collecting the rows.

Each pass counts values into equal-width bins of the interval that still holds a wanted rank
and keeps the bin containing it. A pass counts whole columns as arrays in the tasks, which hand on
at most (columns x ranks x bins) rows each, whatever the table size; an interval ends when it holds
a single distinct value. A thousandfold larger table costs about one more pass. Infinite values
are counted apart and take the lowest and highest ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096
COUNTS = 1 << 20    # bins of all intervals of a pass, so that wide tables stay small in a task
INFINITY = float("inf")


def _number(c: str):
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _interpolate(values: dict[int, float], n: int, p: float) -> float:
    position = (n - 1) * p
    low, high = math.floor(position), math.ceil(position)
    if values[low] == values[high] or position == low:
        return values[low]
    return values[low] + (values[high] - values[low]) * (position - low)


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                    bins: int = BINS) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; nulls and NaN are ignored."""
    data = df.select(*[_number(c).alias(c) for c in columns])
    facts = _facts(data, len(columns))
    counts = [f["n"] for f in facts]

    # (column index, rank) -> (low, high, number of values below low)
    open_ranks: dict[tuple[int, int], tuple[float, float, int]] = {}
    found: dict[int, dict[int, float]] = {i: {} for i in range(len(columns))}
    for i, n in enumerate(counts):
        if n:
            for p in probabilities:
                for rank in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
                    if rank < facts[i]["below"]:
                        found[i][rank] = -INFINITY
                    elif rank >= n - facts[i]["above"]:
                        found[i][rank] = INFINITY
                    else:
                        open_ranks[(i, rank)] = (facts[i]["lo"], facts[i]["hi"],
                                                 facts[i]["below"])

    _settle(data, columns, open_ranks, found, bins)
    return {c: [_interpolate(found[i], counts[i], p) if counts[i] else None
                for p in probabilities] for i, c in enumerate(columns)}


def _facts(data: DataFrame, width: int) -> list[dict]:
    """Per column: known values, those of either infinity, least and largest finite value."""
    names = ["i", "n", "below", "above", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, below, above = (np.zeros(width, np.int64) for _ in range(3))
        lo, hi = np.full(width, np.inf), np.full(width, -np.inf)
        for batch in batches:
            for i in range(width):
                x = batch.column(i).to_numpy(zero_copy_only=False)
                x = x[~np.isnan(x)]
                n[i] += len(x)
                below[i] += np.count_nonzero(x == -np.inf)
                above[i] += np.count_nonzero(x == np.inf)
                x = x[np.isfinite(x)]
                lo[i], hi[i] = x.min(initial=lo[i]), x.max(initial=hi[i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (np.arange(width), n, below, above, lo, hi)], names=names)

    parts = data.mapInArrow(run, "i long, n long, below long, above long, lo double, hi double")
    merged = parts.groupBy("i").agg(
        *[F.sum(c).alias(c) for c in names[1:4]], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    found = {r.i: r.asDict() for r in merged.collect()}  # a row per column
    none = {"n": 0, "below": 0, "above": 0, "lo": None, "hi": None}
    return [found.get(i, none) for i in range(width)]


def _settle(data: DataFrame, columns, open_ranks, found, bins) -> None:
    """Narrow all open intervals until each holds one distinct value."""
    while True:
        for (i, rank), (low, high, _) in list(open_ranks.items()):
            if low == high:
                found[i][rank] = low
                del open_ranks[(i, rank)]
        if not open_ranks:
            return
        open_ranks = _narrow(data, columns, open_ranks, bins)


def value_at(df: DataFrame, column: str, rank: int, bins: int = BINS):
    """The value with ``rank`` smaller or equal values before it, of a column of finite numbers."""
    data = df.select(F.col(column).cast("double").alias(column)).where(F.col(column).isNotNull())
    low, high = data.agg(F.min(column), F.max(column)).first()
    found: dict[int, dict[int, float]] = {0: {}}
    _settle(data, [column], {(0, rank): (low, high, 0)}, found, bins)
    return found[0][rank]


def _narrow(data: DataFrame, columns, open_ranks, bins):
    """One pass: replace each open interval by the bin that contains its rank."""
    intervals = sorted({(i, low, high, below) for (i, _), (low, high, below) in open_ranks.items()})
    number = {interval: k for k, interval in enumerate(intervals)}
    bins = min(bins, max(16, COUNTS // len(intervals)))
    used = sorted({i for i, _, _, _ in intervals})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(intervals), bins), np.int64)
        lo, hi = np.full(n.shape, np.inf), np.full(n.shape, -np.inf)
        for batch in batches:
            for k, (i, low, high, _) in enumerate(intervals):
                x = batch.column(used.index(i)).to_numpy(zero_copy_only=False)
                x = x[(x >= low) & (x <= high)]
                share = (x / 2 - low / 2) / (high / 2 - low / 2)  # no overflow
                slot = np.minimum(bins - 1, (share * bins).astype(np.intp))
                n[k] += np.bincount(slot, minlength=bins)
                np.minimum.at(lo[k], slot, x)
                np.maximum.at(hi[k], slot, x)
        k, slot = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(n[k, slot]),
             pa.array(lo[k, slot]), pa.array(hi[k, slot])], names=["k", "slot", "n", "low", "high"])

    counted = (data.select(*[columns[i] for i in used])
               .mapInArrow(run, "k int, slot int, n long, low double, high double")
               .groupBy("k", "slot")
               .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")))
    before = Window.partitionBy("k").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))

    asked = {(number[(i, low, high, below)], rank - below): (i, rank, below)
             for (i, rank), (low, high, below) in open_ranks.items()}
    offsets = data.sparkSession.createDataFrame(list(asked), "k int, offset long")
    kept = (counted.join(F.broadcast(offsets), "k")  # one row per open rank
            .where("below <= offset AND offset < below + n").collect())
    narrowed = {}
    for row in kept:
        i, rank, below = asked[(row.k, row.offset)]
        narrowed[(i, rank)] = (row.low, row.high, below + row.below)
    return narrowed
