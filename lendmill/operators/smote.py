"""SMOTE oversampling (Chawla et al., arXiv:1106.1813) with neighbours from random hyperplanes.

The minority class is cut into buckets by the side of the median each row lies on, for a few
random projections; their number grows with the logarithm of the class, so a bucket holds about
``block_rows`` rows. Neighbours are exact inside a bucket, and several independent tables of
buckets make up for borders. Work is (rows x block_rows x tables); a bucket crowded by equal
rows is dealt out, so no task holds more than about two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.operators.evaluate import class_counts
from lendmill.operators.shap import feature_array
from lendmill.operators.split import seeded_sample
from lendmill.session import materialise

BLOCK_ROWS = 4096  # rows of a bucket, not a limit on the class
TABLES = 4


def _unit(*parts) -> Column:
    """Deterministic number in [0, 1) from a row's keys."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40)


def _codes(points: DataFrame, bits: int, tables: int, seed: int) -> Column:
    """Per table the side of the median of each of ``bits`` random projections, as a number."""
    if not bits:
        return F.array(*[F.lit(0).cast("long")] * tables)
    width = points.select(F.size("x").alias("w")).first()["w"]
    planes = np.random.default_rng(seed).standard_normal((tables * bits, width))

    sides = _projected(planes, F.col("x"))
    names = [f"p{i}" for i in range(len(planes))]
    values = points.select(sides.alias("v")).select(
        *[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    medians = [m[0] for m in values.approxQuantile(names, [0.5], 0.01)]
    return _projected(planes, F.col("x"), medians, bits)


def _projected(planes: np.ndarray, x: Column, medians: list[float] | None = None,
               bits: int = 0) -> Column:
    """Values of a row on every plane (``array<double>``) or, given their medians, per table of
    ``bits`` planes the sides as a number (``array<long>``)."""

    def values(rows: pa.Array) -> np.ndarray:
        flat = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, planes.shape[1])
        out = np.zeros((len(rows), len(planes)))
        # one component after the other: the sums do not depend on the rows beside a row
        for j in range(planes.shape[1]):
            out += flat[:, j, None] * planes[:, j]
        return out

    def sides(rows: pa.Array) -> np.ndarray:
        found = (values(rows) > np.array(medians)).reshape(len(rows), -1, bits)
        return (found.astype(np.int64) << np.arange(bits)).sum(axis=2)

    @F.arrow_udf("array<double>" if medians is None else "array<bigint>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            found = values(rows) if medians is None else sides(rows)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1]
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    return compute(x)


def smallest(d: np.ndarray, k: int, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the ``k`` smallest numbers of every row. The k-th smallest of the least
    numbers of groups of columns bounds them, and few others lie under it."""
    n, most = d.shape[1], min(k, d.shape[1])
    groups = n // width
    if groups >= most:
        least = d[:, :groups * width].reshape(len(d), groups, width).min(axis=2)
        bound = np.partition(least, most - 1, axis=1)[:, most - 1]
        rows, cols = np.nonzero(d <= bound[:, None])
        if len(rows) <= 8 * most * len(d):
            order = np.lexsort((cols, d[rows, cols], rows))
            rows, cols = rows[order], cols[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, np.arange(len(d)))[rows]
            return rows[place < most], cols[place < most]
    # small tables, and rows with many equal distances
    cols = np.argpartition(d, most - 1, axis=1)[:, :most]
    return np.repeat(np.arange(len(d)), most), cols.ravel()


def nearest(points: DataFrame, k: int, block_rows: int = BLOCK_ROWS, tables: int = TABLES,
            seed: int = 42, id_col: str = "app_id") -> DataFrame:
    """(id, other, distance, rank 0..k-1): near points of every row with ``ask``, without itself.

    ``points`` carry the id, ``x array<double>`` and the flag ``ask``. Exact while all points fit
    one block.
    """
    id_type = points.schema[id_col].dataType.simpleString()
    bits = max(0, math.ceil(math.log2(max(1, points.count()) / block_rows)))
    codes = _codes(points, bits, tables if bits else 1, seed)
    placed = points.withColumn("_codes", codes).select(
        F.col(id_col).alias("point"), "x", "ask", F.posexplode("_codes").alias("table", "bucket"))
    deals = placed.groupBy("table", "bucket").agg(
        F.ceil(F.count("*") / (2 * block_rows)).alias("deals"))
    placed = placed.join(deals, ["table", "bucket"]).withColumn(
        "deal", F.pmod(F.xxhash64("point"), "deals")).drop("deals")

    def within(block: pd.DataFrame) -> pd.DataFrame:
        x, names = np.stack(block["x"].to_numpy()), block["point"].to_numpy()
        asks = np.flatnonzero(block["ask"].to_numpy())
        length = (x ** 2).sum(1)
        single = len(np.unique(names)) == len(names)
        out = []
        # a few rows at a time: their distances stay in the processor's cache
        for part in np.array_split(asks, max(1, -(-len(asks) // 64))):
            d = length[part, None] + length
            product = x[part] @ x.T
            product *= 2
            d -= product
            np.maximum(d, 0, out=d)
            if single:
                d[np.arange(len(part)), part] = np.inf
            else:
                d[names[part][:, None] == names] = np.inf
            rows, cols = smallest(d, k)
            far = d[rows, cols]
            kept = np.isfinite(far)
            out.append(pd.DataFrame({"base": names[part[rows[kept]]], "other": names[cols[kept]],
                                     "distance": np.sqrt(far[kept])}))
        return pd.concat(out)

    found = placed.groupBy("table", "bucket", "deal").applyInPandas(
        within, f"base {id_type}, other {id_type}, distance double")
    found = found.groupBy("base", "other").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("base").orderBy("distance", "other")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("base").alias(id_col), "other", "distance",
                    (F.col("rank") - 1).alias("rank")))


def smote(df: DataFrame, features: list[str], label: str = "default", id_col: str = "app_id",
          ratio: float = 0.5, k: int = 5, seed: int = 42, categorical: list[str] = (),
          block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, dict]:
    """Append synthetic minority rows until minority = ratio x majority.

    Returns (table, info). A synthetic row lies between a minority row and one of its k nearest
    neighbours; codes of ``categorical`` features are taken from the nearer parent. When the
    ratio is already met the table comes back unchanged with ``info["applied"] = False``.
    """
    counts = class_counts(df, label).first()
    minority, small, large = ((1, counts.n1, counts.n0) if counts.n1 <= counts.n0
                              else (0, counts.n0, counts.n1))
    missing = int(ratio * large) - small
    info = {"minority": minority, "before": small, "majority": large,
            "added": max(0, missing), "applied": missing > 0}
    tagged = df.withColumn("synthetic", F.lit(False))
    if missing <= 0:
        return tagged, info
    if small <= k:
        raise ValueError(f"{small} minority rows are too few for {k} neighbours")

    points = (df.where(F.col(label) == minority)
              .select(id_col, feature_array(features).alias("x")))
    missing_values = points.where(F.exists("x", lambda v: v.isNull() | F.isnan(v))).count()
    if missing_values:
        raise ValueError(f"{missing_values} minority rows have a feature without a value")
    # every minority row is a base floor(missing/small) times; the rest goes to hash winners
    rounds, extra = divmod(missing, small)
    if rounds:
        bases = points.withColumn("copies", F.lit(rounds))
        if extra:
            chosen = seeded_sample(points, extra, id_col, seed).select(
                id_col, F.lit(1).alias("_more"))
            bases = (bases.join(chosen, id_col, "left")
                     .withColumn("copies", F.col("copies") + F.coalesce("_more", F.lit(0)))
                     .drop("_more"))
    else:
        bases = seeded_sample(points, extra, id_col, seed).withColumn("copies", F.lit(1))

    asks = points.join(bases.select(id_col, F.lit(True).alias("_ask")), id_col, "left") \
        .select(id_col, "x", F.coalesce("_ask", F.lit(False)).alias("ask"))
    near = nearest(materialise(asks, "smote-points"), k, block_rows, seed=seed, id_col=id_col)
    near = near.groupBy(id_col).agg(F.transform(F.sort_array(F.collect_list(  # k entries at most
        F.struct("rank", "other"))), lambda e: e["other"]).alias("near"))
    draws = (bases.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
             .withColumn("u", _unit(F.col(id_col), "copy", F.lit(seed + 1))))
    place = F.floor(_unit(F.col(id_col), "copy", F.lit(seed)) * F.size("near")).cast("int")
    draws = draws.join(near, id_col, "left").withColumn("other", F.get("near", place)).drop("near")
    partners = points.select(F.col(id_col).alias("other"), F.col("x").alias("vector"))
    # left joins: a row without a neighbour in its buckets repeats itself, so none is lost
    mixed = draws.join(partners, "other", "left").withColumn(
        "vector", F.coalesce("vector", "x"))

    new = {}
    for i, c in enumerate(features):
        a, b, u = F.col("x")[i], F.col("vector")[i], F.col("u")
        value = F.when(u < 0.5, a).otherwise(b) if c in categorical else a + u * (b - a)
        new[c] = value.cast(df.schema[c].dataType)
    made = mixed.select(
        F.lit(None).cast(df.schema[id_col].dataType).alias(id_col),
        *[v.alias(c) for c, v in new.items()],
        F.lit(minority).cast(df.schema[label].dataType).alias(label),
        F.lit(True).alias("synthetic"))
    return append_synthetic(tagged.select(id_col, *features, label, "synthetic"), made), info


def append_synthetic(rows: DataFrame, made: DataFrame) -> DataFrame:
    return rows.unionByName(made)
