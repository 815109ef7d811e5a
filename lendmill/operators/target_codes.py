"""Ordered target statistics of category columns.

Rows stand in a seeded hash order of their ids. A row's code for a category is the smoothed mean
label of the rows before it in that category, so it never depends on the row's own label; rows
that are scored later get the mean over all training rows. The running totals go range by range
(``ordering``), so a category that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators.ordering import even_cuts, range_count, running_totals
from lendmill.session import materialise

PLACES = 1 << 52


def ordered_codes(df: DataFrame, features: list[str], coded: list[str], label: str, id_col: str,
                  folds: int = 0, seed: int = 42) -> tuple[DataFrame, dict, dict]:
    """``df`` with code columns; the feature columns to use per left-out fold (-1: none); and
    {position among the features: (sorted values, codes, code of an unseen value)}.

    The codes for fold k come from the rows outside it: running means for those rows, whole means
    for the rows of the fold itself. ``df`` has the column ``fold`` if ``folds`` is not 0.
    """
    if not coded:
        return df, {k: features for k in range(-1, folds)}, {}
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(PLACES)).cast("double")
    rows = materialise(df.withColumn("_place", place), "ordered-rows")
    outside = {k: (F.col("fold") != k) if k >= 0 else F.lit(True) for k in range(-1, folds)}
    name = {k: f"k{k + 1}" for k in outside}
    y = F.col(label).cast("double")
    sums = [e for k, out in outside.items() for e in (
        F.when(out, y).otherwise(0.0).alias(f"s_{name[k]}"),
        F.when(out, 1.0).otherwise(0.0).alias(f"n_{name[k]}"))]
    totals = [f"{t}_{name[k]}" for k in outside for t in "sn"]
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("feature"),
                                        F.col(c).cast("double").alias("value"))
                               for i, c in enumerate(coded)]))
    long = rows.select("_place", *sums, cells)
    splits = even_cuts(0.0, float(PLACES), range_count(rows.count() * len(coded)))
    before = materialise(running_totals(long, "_place", totals, ["feature", "value"], splits),
                         "ordered-totals")
    whole = materialise(before.groupBy("feature", "value").agg(
        *[F.sum(t).alias(f"all_{t}") for t in totals]), "category-totals")
    overall = rows.select(*sums).agg(*[F.sum(t).alias(t) for t in totals]).first()
    prior = {k: overall[f"s_{name[k]}"] / overall[f"n_{name[k]}"]
             if overall[f"n_{name[k]}"] else 0.5 for k in outside}
    versions = {k: [f"_code_{c}_{name[k]}" if c in coded else c for c in features]
                for k in outside}
    for i, c in enumerate(coded):
        mine = before.where(F.col("feature") == i).join(
            whole.where(F.col("feature") == i).drop("feature"), "value")
        found = []
        for k in outside:
            def mean(s, n, p=prior[k]):
                return (F.col(s) + F.lit(p)) / (F.col(n) + 1)
            running = mean(f"s_{name[k]}_before", f"n_{name[k]}_before")
            all_ = mean(f"all_s_{name[k]}", f"all_n_{name[k]}")
            found += [running.alias(f"_run_{k + 1}"), all_.alias(f"_all_{k + 1}")]
        mine = mine.select(F.col("value").alias("_value"), F.col("_place").alias("_at"), *found)
        joined = rows.join(mine, (F.col(c).cast("double") == F.col("_value"))
                           & (F.col("_place") == F.col("_at")), "left")
        for k, out in outside.items():
            joined = joined.withColumn(f"_code_{c}_{name[k]}", F.coalesce(
                F.when(out, F.col(f"_run_{k + 1}")).otherwise(F.col(f"_all_{k + 1}")),
                F.lit(prior[k])))
        rows = joined.drop("_value", "_at", *[f"_{t}_{k + 1}" for k in outside
                                              for t in ("run", "all")])
    codes = {}
    at = name[-1]
    for i, c in enumerate(coded):  # one row per class of a category column: part of the model
        table = sorted((r.value, (r[f"all_s_{at}"] + prior[-1]) / (r[f"all_n_{at}"] + 1))
                       for r in whole.where((F.col("feature") == i)
                                            & F.col("value").isNotNull()).collect())
        if table:
            codes[features.index(c)] = (np.array([v for v, _ in table]),
                                        np.array([m for _, m in table]), prior[-1])
    return materialise(rows.drop("_place"), "ordered-codes"), versions, codes
