"""Running totals over a global order without a single-partition window.

Rows collapse to one per distinct value, which is stored once, so whatever computes the input
runs once; a value that holds a third of the input is one row by then. These rows are cut into
value ranges, as many as their number asks for. Totals per range give each range its starting
value, and an ordinary window does the rest inside a range. Cut points only affect balance, never
results.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendmill.session import materialise

RANGE_ROWS = 100_000


def range_count(rows: int) -> int:
    """Ranges of about RANGE_ROWS rows; a few at least, so that small inputs use some cores."""
    return max(8, -(-rows // RANGE_ROWS))


def cut_points(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Splits into slices of about equal row counts: one narrow pass that merges sketches."""
    ranges = ranges or range_count(df.count())
    wanted = [k / ranges for k in range(1, ranges)]
    values = df.select(F.col(column).cast("double").alias("v"))
    inner = values.approxQuantile("v", wanted, 1 / (2 * ranges))
    return _splits(inner)


def even_cuts(low: float, high: float, ranges: int) -> list[float]:
    """Equal-width splits, for orders that are known to be spread evenly (such as ranks)."""
    step = (high - low) / ranges
    return _splits(low + step * k for k in range(1, ranges))


def _splits(inner) -> list[float]:
    finite = sorted(v for v in set(inner) if abs(v) != float("inf"))
    return [float("-inf"), *(finite or [0.0]), float("inf")]


def add_range(df: DataFrame, column: str, out: str, splits: list[float]) -> DataFrame:
    """Range number of a value; values that fit no range (null) get -1."""
    return (Bucketizer(splits=splits, inputCol=column, outputCol=out, handleInvalid="keep")
            .transform(df).withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(-1))))


def _running(rows: DataFrame, order: str, columns: list[str], groups: list[str], fold,
             inclusive: bool, suffix: str, splits: list[float] | None) -> DataFrame:
    """Combine ``fold`` (sum or max) over earlier ranges with a window inside each range."""
    rows = materialise(rows.groupBy(*groups, order).agg(*[fold(c).alias(c) for c in columns]),
                       "running")
    splits = cut_points(rows, order) if splits is None else splits
    sliced = add_range(rows, order, "_range", splits)

    earlier = (Window.partitionBy(*groups).orderBy("_range")
               .rowsBetween(Window.unboundedPreceding, -1))
    keys = [*groups, "_range"]
    starts = (sliced.groupBy(*keys).agg(*[fold(c).alias(f"_part_{c}") for c in columns])
              .select(*[F.col(k).alias(f"_key_{k}") for k in keys],
                      *[fold(f"_part_{c}").over(earlier).alias(f"_start_{c}") for c in columns]))
    inside = (Window.partitionBy(*keys).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    within = sliced.withColumns({f"_in_{c}": fold(c).over(inside) for c in columns})

    def joined(c: str):
        start, here = F.col(f"_start_{c}"), F.col(f"_in_{c}")
        if fold is F.max:
            return F.greatest(start, here)
        return F.coalesce(start, F.lit(0)) + F.coalesce(here, F.lit(0))

    # null-safe, so that a group named null keeps its rows
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return within.join(starts, same).select(
        *groups, order, *columns, *[joined(c).alias(f"{c}{suffix}") for c in columns])


def running_totals(rows: DataFrame, order: str, totals: list[str], groups: list[str] = (),
                   splits: list[float] | None = None) -> DataFrame:
    """One row per (groups, order) with its totals and ``<total>_before``: the sums over all
    rows that sort strictly before it. The order column is numeric; ``rows`` may repeat values."""
    return _running(rows, order, totals, list(groups), F.sum, False, "_before", splits)


def running_max(rows: DataFrame, order: str, column: str, groups: list[str] = (),
                splits: list[float] | None = None) -> DataFrame:
    """One row per (groups, order) with ``<column>_so_far``: the largest value up to it."""
    return _running(rows, order, [column], list(groups), F.max, True, "_so_far", splits)
