"""SHAP values of tree ensembles and linear models, as columns of the scored table.

Trees: a leaf contributes its value to a coalition game in which every feature on its path is
either "satisfied by the row" (1) or "averaged over the training cover" (the cover share z).
For such a product game the Shapley value of feature j is

    value * (o_j - z_j) * integral over t in 0..1 of  prod_{k != j} (t * o_k + (1 - t) * z_k)

(the multilinear extension of a game, Owen 1972), a polynomial that Gauss-Legendre nodes
integrate exactly. Summed over leaves this equals path-dependent TreeSHAP (arXiv:1802.03888).
The same game with other shares gives the interventional values: against one background row the
share of a feature is 1 or 0, as the row meets the leaf's conditions or not, and the mean over a
background only needs the distinct patterns of its rows at each leaf, with counts. The second
derivative of the extension gives the interaction of two features.

Scoring is one narrow Arrow stage: rows never shuffle, and what travels to the tasks is the
model's own node table, which MLlib has already shipped once to predict.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.operators.quantiles import exact_quantiles
from lendmill.session import scratch

if TYPE_CHECKING:
    from lendmill.operators.train import Fitted

TABLE_CELLS = 4_000_000


@dataclass
class Leaf:
    value: float
    features: list[int]
    shares: np.ndarray          # product of cover shares per feature
    steps: list[list[tuple[int, bool]]]  # per feature: (split number, goes left)


@dataclass
class Tree:
    split_feature: np.ndarray
    split_threshold: np.ndarray
    leaves: list[Leaf]


def node_table(fitted: Fitted, spark) -> DataFrame:
    """Nodes of a saved ensemble, as MLlib stores them."""
    path = scratch(spark, "trees")
    fitted.model.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


def read_trees(fitted: Fitted, spark) -> list[Tree]:
    """Trees as leaf paths; leaf values are in log-odds (boosted) or probability (forest)."""
    if hasattr(fitted.model, "paths"):
        return fitted.model.paths()
    nodes = node_table(fitted, spark)
    weights = fitted.model.treeWeights
    by_tree: dict[int, dict[int, object]] = {}
    for r in nodes.collect():  # at most trees x 2^(depth+1) rows, no table data
        by_tree.setdefault(r.treeID, {})[r.id] = r
    trees = []
    for t in sorted(by_tree):
        if fitted.kind == "boosted":
            factor = 2.0 * weights[t]
            cover = lambda n: n.impurityStats[0]
            value = lambda n: n.prediction * factor
        else:
            factor = 1.0 / len(by_tree)
            cover = lambda n: sum(n.impurityStats)
            value = lambda n: n.impurityStats[1] / sum(n.impurityStats) * factor
        trees.append(_tree(by_tree[t], cover, value))
    return trees


def _tree(nodes: dict, cover, value) -> Tree:
    splits: list[tuple[int, float]] = []
    leaves: list[Leaf] = []
    todo = [(0, [])]
    while todo:
        number, path = todo.pop()
        node = nodes[number]
        if node.leftChild < 0:
            leaves.append(_leaf(value(node), path))
            continue
        if node.split.numCategories != -1:
            raise ValueError("only numeric splits are supported")
        k = len(splits)
        splits.append((node.split.featureIndex, node.split.leftCategoriesOrThreshold[0]))
        for child, left in ((node.leftChild, True), (node.rightChild, False)):
            share = cover(nodes[child]) / cover(node)
            todo.append((child, [*path, (node.split.featureIndex, share, k, left)]))
    return Tree(np.array([f for f, _ in splits], dtype=np.int64),
                np.array([x for _, x in splits], dtype=np.float64), leaves)


def _leaf(value: float, path: list) -> Leaf:
    features: list[int] = []
    shares: list[float] = []
    steps: list[list[tuple[int, bool]]] = []
    for f, share, k, left in path:
        if f not in features:
            features.append(f)
            shares.append(1.0)
            steps.append([])
        at = features.index(f)
        shares[at] *= share
        steps[at].append((k, left))
    return Leaf(value, features, np.array(shares), steps)


def leaf_table(value: float, shares: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Contribution of each path feature (columns) for each satisfied-pattern (rows)."""
    m = len(shares)
    nodes, weights = np.polynomial.legendre.leggauss(max(1, (m + 1) // 2))
    t, w = (nodes + 1) / 2, weights / 2
    held = ((patterns[:, None] >> np.arange(m)) & 1).astype(np.float64)
    factor = held[:, :, None] * t + shares[None, :, None] * (1 - t)
    whole = factor.prod(axis=1, keepdims=True)
    return value * (held - shares) * ((whole / factor) * w).sum(axis=2)


def _turns(tree: Tree, columns: np.ndarray) -> np.ndarray:
    """(2, splits, rows): whether a row goes right, left."""
    left = columns[tree.split_feature] <= tree.split_threshold[:, None]
    return np.stack([~left, left]).view(np.uint8)


def _patterns(leaf: Leaf, turns: np.ndarray, rows: int) -> np.ndarray:
    """Per row, one bit per path feature: does the row meet the leaf's conditions on it?"""
    m = len(leaf.features)
    # narrow integers: the loop is bound by memory traffic
    kind = np.uint8 if m <= 8 else np.uint16 if m <= 16 else np.int64
    pattern = np.zeros(rows, dtype=kind)
    for bit, steps in enumerate(leaf.steps):
        met = np.bitwise_and.reduce([turns[int(goes_left), k] for k, goes_left in steps])
        pattern |= met.astype(kind) << kind(bit)
    return pattern


def shap_matrix(trees: list[Tree], x: np.ndarray, tables: dict | None = None,
                background: "Background | None" = None) -> np.ndarray:
    """SHAP values of the rows of ``x`` (rows x features); ``tables`` caches leaf tables."""
    tables = {} if tables is None else tables
    cells = sum(v.size for v in tables.values())
    by_feature = np.zeros((x.shape[1], x.shape[0]))
    columns = np.ascontiguousarray(x.T)

    def game(i: int, j: int, leaf: Leaf, patterns: np.ndarray) -> np.ndarray:
        if background is None:
            return leaf_table(leaf.value, leaf.shares, patterns)
        return background.table(i, j, leaf, patterns)

    for i, tree in enumerate(trees):
        turns = _turns(tree, columns)
        for j, leaf in enumerate(tree.leaves):
            m = len(leaf.features)
            if m == 0:
                continue
            pattern = _patterns(leaf, turns, x.shape[0])
            table = tables.get((i, j))
            if table is None:
                if m <= 12:
                    table = game(i, j, leaf, np.arange(1 << m)).T.copy()
                    if cells + table.size <= TABLE_CELLS:
                        tables[(i, j)] = table
                        cells += table.size
                else:  # long paths: only the patterns that occur
                    seen, pattern = np.unique(pattern, return_inverse=True)
                    table = game(i, j, leaf, seen.astype(np.int64)).T
            place = pattern.astype(np.intp)
            for bit, f in enumerate(leaf.features):
                by_feature[f] += table[bit].take(place)
    return by_feature.T


class Background:
    """Background rows as the distinct patterns they form at every leaf, with their shares."""

    def __init__(self, trees: list[Tree], x: np.ndarray):
        columns = np.ascontiguousarray(x.T)
        self.seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.base = 0.0
        for i, tree in enumerate(trees):
            turns = _turns(tree, columns)
            for j, leaf in enumerate(tree.leaves):
                m = len(leaf.features)
                if m == 0:
                    self.base += leaf.value
                    continue
                values, counts = np.unique(_patterns(leaf, turns, len(x)), return_counts=True)
                self.seen[i, j] = values.astype(np.int64), counts / len(x)
                self.base += leaf.value * float(counts[values == (1 << m) - 1].sum()) / len(x)

    def table(self, i: int, j: int, leaf: Leaf, patterns: np.ndarray) -> np.ndarray:
        """Mean contribution over the background of each path feature, for each pattern.

        A feature that neither row meets makes the game zero; of those that only the explained
        row meets (a of them) and only the background row meets (b), each one adds
        (a - 1)! b! / (a + b)! or takes a! (b - 1)! / (a + b)! of the leaf's value.
        """
        values, shares = self.seen[i, j]
        m = len(leaf.features)
        out = np.zeros((len(patterns), m))
        bits = np.arange(m)
        for value, share in zip(values, shares):
            only_row = patterns & ~value
            only_other = value & ~patterns
            alive = (patterns | value) == (1 << m) - 1
            gains = ((only_row[:, None] >> bits) & 1).astype(bool)
            losses = ((only_other[:, None] >> bits) & 1).astype(bool)
            a, b = gains.sum(axis=1), losses.sum(axis=1)
            for k in np.flatnonzero(alive & (a + b > 0)):
                scale = leaf.value * share / comb(int(a[k] + b[k]), int(a[k]))
                if a[k]:
                    out[k, gains[k]] += scale / a[k]
                if b[k]:
                    out[k, losses[k]] -= scale / b[k]
        return out


def pair_table(value: float, shares: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """(patterns, features, features): half the interaction of each pair of path features."""
    m = len(shares)
    nodes, weights = np.polynomial.legendre.leggauss(max(1, m // 2))
    t, w = (nodes + 1) / 2, weights / 2
    held = ((patterns[:, None] >> np.arange(m)) & 1).astype(np.float64)
    factor = held[:, :, None] * t + shares[None, :, None] * (1 - t)
    out = np.zeros((len(patterns), m, m))
    for a in range(m):
        for b in range(a + 1, m):
            rest = np.delete(factor, [a, b], axis=1).prod(axis=1)
            both = value * (held[:, a] - shares[a]) * (held[:, b] - shares[b])
            out[:, a, b] = out[:, b, a] = both * (rest * w).sum(axis=1) / 2
    return out


def interaction_matrix(trees: list[Tree], x: np.ndarray, tables: dict | None = None) -> np.ndarray:
    """(rows, features, features) interaction values. Off the diagonal: half the interaction of
    two features; on it: what is left of the feature's SHAP value, so that rows add up to it."""
    tables = {} if tables is None else tables
    width = x.shape[1]
    out = np.zeros((width, width, x.shape[0]))
    columns = np.ascontiguousarray(x.T)
    for i, tree in enumerate(trees):
        turns = _turns(tree, columns)
        for j, leaf in enumerate(tree.leaves):
            m = len(leaf.features)
            if m < 2:
                continue
            pairs = list(itertools.combinations(range(m), 2))
            pattern = _patterns(leaf, turns, x.shape[0])
            if m <= 8:
                table = tables.get((i, j))
                if table is None:   # a row of all patterns per pair
                    table = tables[i, j] = pair_table(
                        leaf.value, leaf.shares, np.arange(1 << m))[:, *zip(*pairs)].T.copy()
            else:  # long paths: only the patterns that occur
                seen, pattern = np.unique(pattern, return_inverse=True)
                table = pair_table(leaf.value, leaf.shares, seen.astype(np.int64))[:, *zip(*pairs)].T
            place = pattern.astype(np.intp)
            for (a, b), values in zip(pairs, table):
                out[leaf.features[a], leaf.features[b]] += values.take(place)
    for a, b in itertools.combinations(range(width), 2):
        out[a, b] += out[b, a]
        out[b, a] = out[a, b]
    own = shap_matrix(trees, x).T
    at = np.arange(width)
    out[at, at] = own - out.sum(axis=1)
    return out.transpose(2, 0, 1)


def base_value(trees: list[Tree]) -> float:
    """Expected output: leaf values weighted by their share of the training cover."""
    return float(sum(leaf.value * leaf.shares.prod() for tree in trees for leaf in tree.leaves))


def tree_shap(trees: list[Tree], width: int, features: Column,
              background: Background | None = None) -> Column:
    """``array<double>`` of SHAP values for an ``array<double>`` feature column."""

    @F.arrow_udf("array<double>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables: dict = {}
        for rows in batches:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            values = shap_matrix(trees, x, tables, background)
            offsets = np.arange(0, (len(x) + 1) * width, width, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    return compute(features)


def tree_interactions(trees: list[Tree], width: int, features: Column, step: int = 5_000) -> Column:
    """``array<double>`` of interaction values (features x features, row by row)."""

    @F.arrow_udf("array<double>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables: dict = {}
        for rows in batches:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            parts = [interaction_matrix(trees, x[a:a + step], tables).reshape(-1, width * width)
                     for a in range(0, len(x), step)]
            values = np.concatenate(parts) if parts else np.zeros((0, width * width))
            offsets = np.arange(0, len(x) + 1, dtype=np.int32) * (width * width)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    return compute(features)


def background_of(rows: DataFrame, trees: list[Tree], features: list[str]) -> Background:
    """A saved background sample (``save_background``: its size is that function's argument, so
    it is small) in the form that ``add_tree_shap`` takes."""
    found = rows.select(feature_array(features).alias("x")).collect()
    if not found:
        raise ValueError("the background has no rows")
    return Background(trees, np.array([r.x for r in found]))


def feature_array(features: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def add_tree_shap(df: DataFrame, fitted: Fitted, trees: list[Tree] | None = None,
                  background: Background | None = None) -> DataFrame:
    """Append ``shap`` (in feature order) and ``base_value`` to a table with the feature columns.

    Without a background the training cover stands for absent features; with one, its rows do,
    and the base value is their mean output.
    """
    trees = read_trees(fitted, df.sparkSession) if trees is None else trees
    values = tree_shap(trees, len(fitted.features), feature_array(fitted.features), background)
    base = base_value(trees) if background is None else background.base
    return df.withColumns({"shap": values, "base_value": F.lit(base)})


def add_interactions(df: DataFrame, fitted: Fitted, trees: list[Tree] | None = None) -> DataFrame:
    """Append ``interactions``: features x features values of every row, row by row."""
    trees = read_trees(fitted, df.sparkSession) if trees is None else trees
    return df.withColumn("interactions", tree_interactions(
        trees, len(fitted.features), feature_array(fitted.features)))


def strongest_partners(df: DataFrame, features: list[str]) -> DataFrame:
    """Per feature, the other feature with the largest mean absolute interaction."""
    n = len(features)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    places = np.array([i * n + j for i, j in pairs], np.intp)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(pairs)), 0
        for batch in batches:
            x = batch.column(0).drop_null().flatten().to_numpy(zero_copy_only=False)
            x = x.reshape(-1, n * n)
            total += np.abs(x[:, places]).sum(axis=0)
            rows += len(x)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(pairs))), pa.array(total), pa.array(np.full(len(pairs), rows))],
                names=["pair", "total", "rows"])

    # a row per task and pair: so many aggregates of one row each would not be compiled
    sums = (df.select("interactions").mapInArrow(partial, "pair long, total double, rows long")
            .groupBy("pair").agg((F.sum("total") / F.sum("rows")).alias("mean")))
    wide = sums.agg(F.map_from_entries(F.collect_list(F.struct("pair", "mean"))).alias("m")) \
        .select(*[F.col("m")[F.lit(k).cast("long")].alias(f"p{k}") for k in range(len(pairs))])
    cells = [F.struct(F.lit(features[a]).alias("feature"), F.lit(features[b]).alias("partner"),
                      F.col(f"p{k}").alias("mean_abs_interaction"))
             for k, (i, j) in enumerate(pairs) for a, b in ((i, j), (j, i))]
    best = F.max_by(F.struct("partner", "mean_abs_interaction"),
                    F.struct("mean_abs_interaction", "partner")).alias("b")
    return wide.select(F.inline(F.array(*cells))).groupBy("feature").agg(best).select("feature", "b.*")


def interaction_dependence(df: DataFrame, features: list[str], feature: str,
                           partner: str | None = None, keep: list[str] = ("app_id",)) -> DataFrame:
    """(feature value, partner's value, interaction value) for every row; the partner is the one
    that interacts most, unless it is named."""
    if partner is None:
        partner = strongest_partners(df, features).where(F.col("feature") == feature).first().partner
    i, j = features.index(feature), features.index(partner)
    return df.select(*keep, F.col(feature).cast("double").alias("value"),
                     F.lit(partner).alias("partner"),
                     F.col(partner).cast("double").alias("partner_value"),
                     (2 * F.col("interactions")[i * len(features) + j]).alias("interaction_value"))


def background_means(df: DataFrame, features: list[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(features)}


def add_linear_shap(df: DataFrame, weights: dict[str, float], means: dict[str, float],
                    intercept: float = 0.0) -> DataFrame:
    """w_j * (x_j - mean_j): exact for a linear score with independent features."""
    terms = [F.lit(w) * (F.col(c) - F.lit(means[c])) for c, w in weights.items()]
    base = intercept + sum(w * means[c] for c, w in weights.items())
    return df.withColumns({"shap": F.array(*terms), "base_value": F.lit(base)})


def shap_long(df: DataFrame, features: list[str], keep: list[str] = ("app_id",)) -> DataFrame:
    """One row per (row, feature): value, shap and the direction label. Also the force-plot table."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                               F.col("shap")[i].alias("shap_value"))
                      for i, c in enumerate(features)])
    return (df.select(*keep, "base_value", F.explode(cells).alias("c"))
            .select(*keep, "base_value", "c.*")
            .withColumn("abs_shap", F.abs("shap_value")))


def dependence(df: DataFrame, features: list[str], feature: str, interaction: str | None = None,
               keep: list[str] = ("app_id",)) -> DataFrame:
    """(feature value, shap value[, interaction value]) for every row."""
    i = features.index(feature)
    extra = [F.col(interaction).cast("double").alias("interaction_value")] if interaction else []
    return df.select(*keep, F.col(feature).cast("double").alias("value"),
                     F.col("shap")[i].alias("shap_value"), *extra)


def _per_feature(features: list[str], fields) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), *fields(i))
                              for i, c in enumerate(features)]))


def global_importance(df: DataFrame, features: list[str], top: int = 20) -> DataFrame:
    """Mean absolute SHAP per feature: one wide aggregate, no row is exploded."""
    wide = df.agg(*[F.avg(F.abs(F.col("shap")[i])).alias(f"a{i}") for i in range(len(features))])
    table = wide.select(_per_feature(features, lambda i: [F.col(f"a{i}").alias("mean_abs_shap")]))
    return table.orderBy(F.desc("mean_abs_shap"), "feature").limit(top)


def shap_summary(df: DataFrame, features: list[str], top: int = 20) -> DataFrame:
    """Distribution of SHAP per feature: mean, mean absolute value, extremes and quartiles."""
    split = df.select(*[F.col("shap")[i].alias(f"s{i}") for i in range(len(features))])
    names = split.columns
    q = exact_quantiles(split, names, [0.25, 0.5, 0.75])
    wide = split.agg(*[e for i, s in enumerate(names) for e in (
        F.avg(F.abs(s)).alias(f"a{i}"), F.avg(s).alias(f"m{i}"),
        F.min(s).alias(f"lo{i}"), F.max(s).alias(f"hi{i}"))])
    table = wide.select(_per_feature(features, lambda i: [
        F.col(f"a{i}").alias("mean_abs_shap"), F.col(f"m{i}").alias("mean_shap"),
        F.col(f"lo{i}").alias("min_shap"),
        *[F.lit(q[f"s{i}"][k]).cast("double").alias(n)
          for k, n in enumerate(("q25_shap", "q50_shap", "q75_shap"))],
        F.col(f"hi{i}").alias("max_shap")]))
    return table.orderBy(F.desc("mean_abs_shap"), "feature").limit(top)
