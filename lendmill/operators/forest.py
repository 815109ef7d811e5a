"""Scores of the smaller forests that a fitted forest holds.

A node's split does not depend on what grows below it or on other trees, so the first trees of a
forest, cut off at a depth, are a forest of that size and depth. A grid over sizes and depths thus
needs one fit a fold: the largest. As in a direct fit, two leaves of one parent that predict the
same class are one leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Shape = tuple[int, int]   # trees, depth


class Cut:
    """A tree that gives every row its share of class 1 at several depths."""

    def __init__(self, nodes: dict, depths: list[int]):
        n = max(nodes) + 1
        self.feature, self.threshold = np.zeros(n, np.intp), np.full(n, np.inf)
        self.left, self.right = np.arange(n), np.arange(n)   # a leaf is its own child
        for i, r in nodes.items():
            if r.leftChild >= 0:
                if r.split.numCategories != -1:
                    raise ValueError("only numeric splits are supported")
                self.feature[i] = r.split.featureIndex
                self.threshold[i] = r.split.leftCategoriesOrThreshold[0]
                self.left[i], self.right[i] = r.leftChild, r.rightChild
        self.share = {d: self._shares(nodes, d) for d in depths}

    @staticmethod
    def _shares(nodes: dict, depth: int) -> np.ndarray:
        out = np.zeros(max(nodes) + 1)

        def below(i: int, level: int) -> tuple[bool, list[int]]:
            """Whether the node is one leaf, and the leaves it ends in."""
            r = nodes[i]
            if level < depth and r.leftChild >= 0:
                (a, some), (b, others) = below(r.leftChild, level + 1), below(r.rightChild, level + 1)
                if not (a and b and nodes[r.leftChild].prediction == nodes[r.rightChild].prediction):
                    return False, some + others
                ends = some + others
            else:
                ends = [i]
            out[ends] = r.impurityStats[1] / sum(r.impurityStats)
            return True, ends

        below(0, 0)
        return out


def cut_trees(rows: list, depths: list[int]) -> list[Cut]:
    """Trees of a forest's node table, in their order."""
    by_tree: dict[int, dict[int, object]] = {}
    for r in rows:
        by_tree.setdefault(r.treeID, {})[r.id] = r
    return [Cut(by_tree[t], depths) for t in sorted(by_tree)]


def shares(trees: list[Cut], shapes: list[Shape], x: np.ndarray) -> np.ndarray:
    """(rows, shapes) mean shares of class 1 of the forests of those shapes."""
    rows = np.arange(len(x))
    flat, first = np.ascontiguousarray(x.T).reshape(-1), len(x)
    out = np.zeros((len(shapes), len(x)))
    total = {d: np.zeros(len(x)) for d in {d for _, d in shapes}}
    for t, tree in enumerate(trees, 1):
        at = np.zeros(len(x), np.intp)
        for level in range(max(total) + 1):
            if level:
                low = flat.take(tree.feature.take(at) * first + rows) <= tree.threshold.take(at)
                at = np.where(low, tree.left.take(at), tree.right.take(at))
            if level in total:
                total[level] += tree.share[level].take(at)
        for k, (size, depth) in enumerate(shapes):
            if size == t:
                out[k] = total[depth] / size
    return out.T


def share_column(trees: list[Cut], shapes: list[Shape], width: int, features: Column) -> Column:
    """``array<double>``: the share of class 1 by each shape, for an ``array<double>`` of features."""

    @F.arrow_udf("array<double>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(shapes)
            yield pa.ListArray.from_arrays(pa.array(offsets),
                                           pa.array(shares(trees, shapes, x).ravel()))

    return compute(features)
