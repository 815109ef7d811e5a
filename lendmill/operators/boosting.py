"""Second-order histogram boosting of many models at once.

A run is one boosted model: a grid point's settings and the fold it leaves out. Features are cut
into at most 256 ranges once, one byte a cell, and stored in blocks of rows with the margins of
all runs. A round of growing asks for the gradient and hessian sums of every (run, node, feature,
range) that is still open, finds the best splits where the sums are, and hands only the chosen
splits to the driver. Gradients are rounded to 2**-20 before they are summed, so the sums, and
with them the trees, do not depend on how rows lie in blocks and tasks.

Trees grow best first: a leaf limit takes the leaves with the largest gain, none takes all. The
candidates of all leaves that can still be taken are found in one round, so a tree costs as many
rounds as it has levels, whatever the leaf limit. ``symmetric`` growth takes one split per level
for all nodes of the level, by the sum of their gains.

Settings: column sample per tree, row sample per tree by a hash of the row's id, least hessian
sum of a child, least gain of a split, L2 penalty. Runs that differ only in their number of trees
or in leaf limits that their depth rules out are one run, scored at each of the numbers.

Work is dealt as (run, block). While the table is one block of ``block_rows``, a task reads a
run's only block piece by piece from the files and holds it (about 100 bytes a row), and all sums
are complete in it, so its rounds follow each other there, runs in parallel and the long ones
first, of two siblings only the smaller one is summed, and the area of the rows left out is found
where their margins are. A larger table takes one aggregation per round over all blocks and runs,
and writes the margins once a tree, so a lost executor costs one tree. Both give the same trees
and areas.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.operators.shap import Tree, _leaf
from lendmill.session import materialise

GRAIN = float(1 << 20)    # gradients and hessians are multiples of 1 / GRAIN
BLOCK_ROWS = 8_000_000
PIECE_ROWS = 500_000      # rows of a block that are stored and read at once
CHUNK_ROWS = 65_536       # rows whose gradients, nodes and sums are taken at once, in the cache
PACK_SUMS = 4_096         # sums of a pack of features, which stay in the processor's cache
CHUNK_SLOTS = 16          # nodes whose sums are taken at once
COUNTED_ROWS = 50_000     # rows that tell the smaller of two siblings
STATE_BYTES = 64 << 20    # margins of a block, where there are several blocks
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    """One model's settings; ``leaves`` 0 means no limit besides the depth."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    num_leaves: int = 0
    growth: str = "best"      # or "symmetric"


# ---- trees ---------------------------------------------------------------------------------

@dataclass
class Nodes:
    """A tree as parallel arrays; feature -1 marks a leaf. ``limit``: range number, goes left if
    the cell is not above it."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray    # of a leaf: what it adds to the margin
    cover: np.ndarray    # hessian sum
    gain: np.ndarray

    def leaf_of(self, cells: np.ndarray) -> np.ndarray:
        """The leaf of every row: the rows of a node are cut in two, node by node."""
        at = np.zeros(cells.shape[1], np.int32)
        todo = [(0, np.arange(len(at)))]
        while todo:
            n, rows = todo.pop()
            if self.feature[n] < 0:
                at[rows] = n
            elif len(rows):
                low = cells[self.feature[n]].take(rows, mode="wrap") <= self.limit[n]
                todo += [(self.left[n], rows.compress(low)), (self.right[n], rows.compress(~low))]
        return at

    def packed(self) -> list:
        return [getattr(self, n).tolist() for n in NODE_PARTS]

    @staticmethod
    def unpacked(parts: list) -> "Nodes":
        return Nodes(*[np.array(p, k) for p, k in zip(parts, NODE_KINDS)])


NODE_PARTS = ["feature", "limit", "left", "right", "value", "cover", "gain"]
NODE_KINDS = [np.int32, np.int32, np.int32, np.int32, np.float64, np.float64, np.float64]


class Growing:
    """A tree while it grows: asks for nodes' best splits and takes them, best first."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.depth = [0]
        self.parts: list[tuple] = [(-1, 0)]         # the split of a node: feature, range
        self.child: list[tuple] = [(-1, -1)]
        self.best: dict[int, tuple] = {}            # gain, feature, range, GL, HL, G, H
        self.taken: list[int] = []

    def wanted(self) -> list[int]:
        """Leaves whose best split is not known and may matter."""
        leaves = [c for n in self.taken for c in self.child[n]] if self.taken else [0]
        return [n for n in leaves if n not in self.best and self.depth[n] < self.s.max_depth]

    def take(self, found: dict[int, tuple]) -> None:
        self.best.update(found)
        self.taken = self._replay()
        for n in self.taken:
            if self.child[n][0] < 0:
                _, feature, limit = self.best[n][:3]
                self.parts[n] = (feature, limit)
                self.child[n] = (len(self.depth), len(self.depth) + 1)
                for _ in range(2):
                    self.depth.append(self.depth[n] + 1)
                    self.parts.append((-1, 0))
                    self.child.append((-1, -1))

    def _replay(self) -> list[int]:
        """Splits in the order of their gains among those known. What is not known yet can only
        push others out, so every split of the final tree that is known is among them."""
        most = self.s.num_leaves - 1 if self.s.num_leaves else 1 << 30
        heap, taken = [], []

        def offer(n: int) -> None:
            if n in self.best and self.best[n][0] > max(self.s.gamma, LEAST_GAIN):
                heapq.heappush(heap, (-self.best[n][0], n))

        offer(0)
        while heap and len(taken) < most:
            _, n = heapq.heappop(heap)
            taken.append(n)
            for c in self.child[n]:
                if c >= 0:
                    offer(c)
        return taken

    def skeleton(self) -> Nodes:
        """The splits known so far, for walking rows to the wanted nodes."""
        n = len(self.depth)
        feature = np.array([p[0] for p in self.parts], np.int32)
        limit = np.array([p[1] for p in self.parts], np.int32)
        child = np.array(self.child, np.int32)
        zero = np.zeros(n)
        return Nodes(feature, limit, child[:, 0], child[:, 1], zero, zero, zero)

    def finished(self, root: tuple | None = None) -> Nodes:
        """The tree of the taken splits, renumbered from the root in the order of taking."""
        number, order = {0: 0}, [0]
        for n in self.taken:
            for c in self.child[n]:
                number[c] = len(order)
                order.append(c)
        # a split that a better one pushed out belongs to the leaf above it
        self.place = np.zeros(len(self.depth), np.int32)
        for n, children in enumerate(self.child):
            self.place[n] = number.get(n, self.place[n])
            for c in children:
                if c >= 0:
                    self.place[c] = self.place[n]
        taken = set(self.taken)
        total = {0: self.best[0][5:7] if 0 in self.best else root or (0.0, 0.0)}
        for n in self.taken:
            _, _, _, gl, hl, g, h = self.best[n]
            total[self.child[n][0]], total[self.child[n][1]] = (gl, hl), (g - gl, h - hl)
        rate, l2 = self.s.learning_rate, self.s.reg_lambda
        rows = []
        for n in order:
            g, h = total[n]
            if n in taken:
                (feature, limit), (left, right) = self.parts[n], self.child[n]
                rows.append((feature, limit, number[left], number[right], 0.0, h, self.best[n][0]))
            else:
                rows.append((-1, 0, -1, -1, -rate * g / (h + l2) if h + l2 > 0 else 0.0, h, 0.0))
        return Nodes(*[np.array(c, k) for c, k in zip(zip(*rows), NODE_KINDS)])


# ---- sums and splits -----------------------------------------------------------------------

@dataclass
class Packs:
    """Cells with several features in one number, so that one count adds up all of them: the sums
    of a feature are those of its pack, added over the other features of the pack."""

    numbers: list[np.ndarray]                 # rows of a pack
    members: list[list[tuple[int, int]]]      # of a pack: features (-1: not asked), their ranges
    width: int                                # features asked for

    @staticmethod
    def of(cells: np.ndarray) -> "Packs":
        counts = cells.max(axis=1).astype(int) + 1 if cells.shape[1] else np.ones(len(cells), int)
        members: list[list[tuple[int, int]]] = []
        sizes: list[int] = []
        for f in sorted(range(len(cells)), key=lambda f: -counts[f]):
            n = int(counts[f])
            k = next((k for k, size in enumerate(sizes) if size * n <= PACK_SUMS), len(sizes))
            if k == len(sizes):
                members.append([])
                sizes.append(1)
            members[k].append((f, n))
            sizes[k] *= n
        numbers = []
        for pack in members:
            number = np.zeros(cells.shape[1], np.uint16)
            for f, n in pack:
                number *= np.uint16(n)
                number += cells[f]
            numbers.append(number)
        return Packs(numbers, members, len(cells))

    def only(self, features: np.ndarray) -> "Packs":
        """Those of some features, in their order."""
        place = {int(f): i for i, f in enumerate(features)}
        asked = [[(place.get(f, -1), n) for f, n in pack] for pack in self.members]
        kept = [k for k, pack in enumerate(asked) if any(f >= 0 for f, _ in pack)]
        return Packs([self.numbers[k] for k in kept], [asked[k] for k in kept], len(place))


def paired(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Gradient and hessian as the two parts of one number, which are added at once."""
    if g.base is not None and g.base is h.base and g.base.dtype == np.complex128:
        return g.base     # as ``gradients`` makes them
    both = np.empty(len(g), np.complex128)
    both.real, both.imag = g, h
    return both


def sums_of(cells: Packs, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int,
            ranges: int) -> np.ndarray:
    """(2, features, slots, ranges) sums of the rows with a slot (0 or more)."""
    out, both = np.zeros((2, cells.width, slots, ranges)), paired(g, h)
    sizes = [int(np.prod([n for _, n in pack])) for pack in cells.members]
    for s in range(0, slots, CHUNK_SLOTS):
        end = min(s + CHUNK_SLOTS, slots)
        total = [np.zeros((end - s) * size, np.complex128) for size in sizes]
        # some rows at a time: their numbers and weights stay in the processor's cache
        for a in range(0, len(slot), CHUNK_ROWS):
            some = slice(a, a + CHUNK_ROWS)
            here = slot[some]
            rows = np.flatnonzero(here >= 0 if slots <= CHUNK_SLOTS else (here >= s) & (here < end))
            if not len(rows):
                continue
            whole = len(rows) == len(here)
            weight = both[some] if whole else both[some].take(rows, mode="wrap")
            of_row = here.take(rows, mode="wrap").astype(np.intp) - s if slots > 1 else None
            for number, size, sums in zip(cells.numbers, sizes, total):
                place = number[some] if whole else number[some].take(rows, mode="wrap")
                place = place.astype(np.intp)
                if slots > 1:
                    place += of_row * size
                np.add.at(sums, place, weight)
        for pack, sums in zip(cells.members, total):
            parts = np.stack([sums.real, sums.imag])
            after = len(sums) // (end - s)
            for f, n in pack:
                after //= n
                if f >= 0:
                    out[:, f, s:end, :n] = (parts.reshape(-1, after) @ np.ones(after)).reshape(
                        2, end - s, -1, n).sum(axis=2)
    return out


def sums_by_sibling(wanted: list[int], parent: dict[int, int], held: dict[int, np.ndarray],
                    cells: Packs, at: np.ndarray, g: np.ndarray, h: np.ndarray,
                    ranges: int) -> np.ndarray:
    """``sums_of`` the wanted nodes where ``at`` gives the rows' nodes (-1: none). Of two
    siblings the one with fewer rows is summed, the other is the parent's sum less it; sums of
    multiples of 1 / GRAIN are exact, so that is the same. ``held`` keeps the open nodes' sums."""
    size = max(int(at.max(initial=-1)), *wanted) + 1
    # which one is smaller decides on the time alone: every so many rows tell enough
    rows = np.bincount(at[::1 + len(at) // COUNTED_ROWS] + 1, minlength=size + 1)[1:]
    sibling: dict[int, int] = {}
    for n in wanted:
        other = [m for m in wanted if m != n and parent.get(m) == parent.get(n)]
        if other and parent[n] in held:
            sibling[n] = other[0]
    summed = [n for n in wanted if n not in sibling or (rows[n], n) < (rows[sibling[n]], sibling[n])]
    slot = np.full(size + 1, -1, at.dtype)    # the last one is that of rows in no node
    slot[summed] = np.arange(len(summed))
    found = sums_of(cells, slot.take(at, mode="wrap"), g, h, len(summed), ranges)
    own = {n: found[:, :, i] for i, n in enumerate(summed)}
    for n in wanted:
        if n not in own:
            own[n] = held[parent[n]] - own[sibling[n]]
    for n in wanted:
        held.pop(parent.get(n), None)
    held.update(own)
    return np.stack([own[n] for n in wanted], axis=2)


def best_splits(sums: np.ndarray, s: Settings, features: np.ndarray) -> list[tuple]:
    """Best split of every slot: gain, feature, range, left sums, all sums. The gain is what the
    split adds to sum(G**2 / (H + l2)); ties go to the earlier feature, then the lower range."""
    g, h = sums
    gl, hl = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    ga, ha = gl[:, :, -1:], hl[:, :, -1:]
    gr, hr = ga - gl, ha - hl
    l2 = s.reg_lambda
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda a, b: np.where(b + l2 > 0, a * a / (b + l2), 0.0)
        gain = part(gl, hl) + part(gr, hr) - part(ga, ha)
    allowed = (hl >= s.min_child_weight) & (hr >= s.min_child_weight)
    if s.growth == "symmetric":
        # one split for all slots: a node that it leaves whole adds nothing
        shared = np.where(allowed, gain, 0.0).sum(axis=1)
        shared[:, -1] = -np.inf
        f, b = divmod(int(shared.argmax()), shared.shape[1])
        picks = [(float(shared[f, b]), f, b)] * gain.shape[1]
    else:
        gain[~allowed] = -np.inf
        gain[:, :, -1] = -np.inf
        flat = gain.transpose(1, 0, 2).reshape(gain.shape[1], -1)
        top = flat.argmax(axis=1)
        picks = [(float(flat[i, t]), *divmod(int(t), gain.shape[2])) for i, t in enumerate(top)]
    return [(v, int(features[f]), b, float(gl[f, i, b]), float(hl[f, i, b]),
             float(ga[f, i, 0]), float(ha[f, i, 0])) for i, (v, f, b) in enumerate(picks)]


def gradients(margin: np.ndarray, label: np.ndarray, weights: tuple) -> tuple:
    """First and second derivatives of the weighted log loss, as multiples of 1 / GRAIN."""
    both = np.empty(len(margin), np.complex128)
    for a in range(0, len(margin), CHUNK_ROWS):
        some = slice(a, a + CHUNK_ROWS)
        p = np.exp(-margin[some])
        p += 1
        np.divide(1, p, out=p)
        w = np.where(label[some] == 1, weights[1], weights[0])
        for part, out in ((p - label[some], both.real), (p * (1 - p), both.imag)):
            part *= w
            part *= GRAIN
            np.round(part, out=part)
            np.divide(part, GRAIN, out=out[some])
    return both.real, both.imag


def drawn(key: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Rows of a tree's sample: a hash of the row's key, the tree and the seed."""
    if share >= 1:
        return np.ones(len(key), bool)
    out = np.empty(len(key), bool)
    for a in range(0, len(key), CHUNK_ROWS):
        x = key[a:a + CHUNK_ROWS].view(np.uint64) + np.uint64(
            (tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64)
        np.less(x, share * (1 << 53), out=out[a:a + CHUNK_ROWS])
    return out


def tree_columns(columns: list[int], tree: int, share: float, seed: int) -> np.ndarray:
    """Positions among a run's features that a tree may use; at least one."""
    n = max(1, int(len(columns) * share))
    if n == len(columns):
        return np.arange(n)
    return np.sort(np.random.default_rng([seed, tree]).choice(len(columns), n, replace=False))


@dataclass
class Run:
    """One model: its settings, the fold it leaves out (-1: none), its columns of cells."""

    settings: Settings
    fold: int
    columns: list[int]
    weights: tuple[float, float]
    seed: int
    ranges: int
    marks: list[int] = field(default_factory=list)   # numbers of trees at which it is scored

    def rows(self, block: "Block", tree: int) -> np.ndarray:
        use = drawn(block.key, tree, self.settings.subsample, self.seed)
        return use & self.inside(block) if self.fold >= 0 else use

    def inside(self, block: "Block") -> np.ndarray:
        """Rows outside the fold that the run leaves out."""
        return block.fold != self.fold if self.fold >= 0 else np.ones(len(block.fold), bool)

    def work(self) -> float:
        """Rows times levels, as a share of those of one level of the table."""
        return self.settings.n_estimators * self.settings.max_depth * (1 if self.fold < 0 else 0.7)


@dataclass
class Block:
    cells: np.ndarray    # columns x rows, one byte each
    key: np.ndarray
    label: np.ndarray
    fold: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, i: int) -> "Block":
        n = batch.column("n")[i].as_py()
        read = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
        return Block(read("cells", np.uint8).reshape(-1, n), read("key", np.int64),
                     read("label", np.uint8), read("fold", np.int8))

    @staticmethod
    def joined(pieces: list["Block"], run: Run) -> "Block":
        """One block of its pieces: the columns of a run, its own rows before those it leaves out."""
        masks = [run.inside(p) for p in pieces]
        parts = [*zip(pieces, masks), *zip(pieces, [~m for m in masks])]
        cells = np.empty((len(run.columns), sum(len(m) for m in masks)), np.uint8)
        for c, column in zip(run.columns, cells):
            np.concatenate([p.cells[c].compress(m) for p, m in parts], out=column)
        return Block(cells, *[np.concatenate([getattr(p, name).compress(m) for p, m in parts])
                              for name in ("key", "label", "fold")])


BLOCK = "block long, n int, cells binary, key binary, label binary, fold binary"


def step_down(cells: np.ndarray, at: np.ndarray, growing: Growing, new: list[int]) -> None:
    """Rows in the ``new`` splits move on to their children, which are numbered side by side."""
    size = len(growing.depth)
    start, limit, low = np.zeros(size, np.intp), np.full(size, 255, np.uint8), np.arange(size)
    for n in new:
        start[n], limit[n], low[n] = growing.parts[n][0] * cells.shape[1], growing.parts[n][1], \
            growing.child[n][0]
    low, flat, place = low.astype(at.dtype), cells.reshape(-1), np.arange(CHUNK_ROWS)
    for a in range(0, len(at), CHUNK_ROWS):
        here = at[a:a + CHUNK_ROWS].astype(np.intp)
        cell = start.take(here, mode="wrap")
        cell += place[:len(here)]
        cell += a
        above = flat.take(cell, mode="wrap") > limit.take(here, mode="wrap")
        np.add(low.take(here, mode="wrap"), above, out=at[a:a + CHUNK_ROWS], casting="unsafe")


def fit_block(run: Run, block: Block) -> tuple[list[Nodes], dict[int, np.ndarray]]:
    """All trees of a run whose rows are one block, and its margins at each mark."""
    s, inside = run.settings, run.inside(block)
    n, own = len(inside), int(inside.sum())
    order = None
    if run.columns != list(range(len(block.cells))) or not inside[:own].all():
        order = np.concatenate([np.flatnonzero(inside), np.flatnonzero(~inside)])
        block = Block.joined([block], run)
    # the rows that the run leaves out stand behind its own; they only walk down the trees
    cells, key, label = block.cells, block.key[:own], block.label[:own]
    packs, margin, trees, at_mark = Packs.of(cells[:, :own]), np.zeros(n), [], {}
    g = h = None
    for t in range(s.n_estimators):
        del g, h     # before the next ones are made
        g, h = gradients(margin[:own], label, run.weights)
        use = drawn(key, t, s.subsample, run.seed) if s.subsample < 1 else None
        mine = tree_columns(run.columns, t, s.colsample_bytree, run.seed)
        part = packs.only(mine)
        growing, at = Growing(s), np.zeros(n, np.int16 if s.max_depth < 14 else np.int32)
        held: dict[int, np.ndarray] = {}
        while wanted := growing.wanted():
            parent = {c: n for n in growing.taken for c in growing.child[n]}
            seen = at[:own] if use is None else np.where(use, at[:own], at.dtype.type(-1))
            sums = sums_by_sibling(wanted, parent, held, part, seen, g, h, run.ranges)
            split = {n for n, c in enumerate(growing.child) if c[0] >= 0}
            growing.take(dict(zip(wanted, best_splits(sums, s, mine))))
            new = [n for n, c in enumerate(growing.child) if c[0] >= 0 and n not in split]
            if new:
                step_down(cells, at, growing, new)
        tree = growing.finished()
        value = tree.value[growing.place]
        for a in range(0, n, CHUNK_ROWS):
            margin[a:a + CHUNK_ROWS] += value.take(at[a:a + CHUNK_ROWS], mode="wrap")
        trees.append(tree)
        if t + 1 in run.marks:
            at_mark[t + 1] = margin.copy()
            if order is not None:
                at_mark[t + 1][order] = margin
    return trees, at_mark


def area(label: np.ndarray, score: np.ndarray) -> float | None:
    """Exact area under the ROC curve, ties counted half, as ``evaluate.roc_auc`` has it."""
    _, place = np.unique(score, return_inverse=True)
    pos, neg = np.bincount(place, label == 1), np.bincount(place, label == 0)
    pairs = float(pos.sum()) * float(neg.sum())
    wins = float((pos * (np.cumsum(neg) - neg + neg / 2)).sum())
    return wins / pairs if pairs else None


# ---- quantising ----------------------------------------------------------------------------

def cut_values(df: DataFrame, columns: list[str], ranges: int) -> list[np.ndarray]:
    """At most ``ranges`` - 1 cuts a column, from one pass that merges sketches."""
    wanted = [k / ranges for k in range(1, ranges)]
    found = df.approxQuantile(columns, wanted, 1 / (4 * ranges))
    return [np.unique(np.array(v, np.float64)) for v in found]


def quantise(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Columns x rows range numbers: how many cuts lie below each value."""
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]) \
        .astype(np.uint8)


def blocks_of(df: DataFrame, columns: list[str], cuts: list[np.ndarray], label: str, id_col: str,
              fold: str | None, block_rows: int, runs: int = 1) -> DataFrame:
    """The quantised table in blocks of at most ``block_rows`` rows, written once; the only block
    in pieces of the same number, where the rows lie."""
    width = len(columns)
    values = F.array(*[F.col(c).cast("double") for c in columns])
    rows = df.select(values.alias("x"), F.xxhash64(id_col).alias("key"),
                     F.col(label).cast("int").alias("label"),
                     (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"))
    # other tables are cut by hash, a margin per run and row, into blocks enough for all cores
    total = rows.count()
    one = total <= block_rows
    if not one:
        evenly = -(-total // df.sparkSession.sparkContext.defaultParallelism)
        block_rows = min(block_rows, max(1_000, min(evenly, STATE_BYTES // (8 * runs))))
        rows = rows.repartition(-(-total // block_rows), "key")
    else:
        block_rows = min(block_rows, PIECE_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = 0 if one else TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        count = 0

        def block(parts):
            nonlocal number
            cells = np.concatenate([p[0] for p in parts], axis=1)
            row = [cells.tobytes(), *[np.concatenate([p[i] for p in parts]).tobytes()
                                      for i in (1, 2, 3)]]
            out = pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([cells.shape[1]], pa.int32()),
                 *[pa.array([r], pa.binary()) for r in row]],
                names=["block", "n", "cells", "key", "label", "fold"])
            number += 0 if one else 1
            return out

        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for a in range(0, len(x), block_rows):
                some = slice(a, a + block_rows)
                take = lambda n, k: batch.column(n).to_numpy()[some].astype(k)
                part = (quantise(x[some], cuts), take("key", np.int64), take("label", np.uint8),
                        take("fold", np.int8))
                if held and count + len(part[1]) > block_rows:
                    yield block(held)
                    held, count = [], 0
                held.append(part)
                count += len(part[1])
        if held:
            yield block(held)

    return materialise(rows.mapInArrow(run, BLOCK), "boosting-blocks")


# ---- one block: runs in parallel -----------------------------------------------------------

def _fit_runs(blocks: DataFrame, runs: list[Run]
              ) -> tuple[dict[int, list[Nodes]], dict[tuple[int, int], float | None]]:
    """Every run on the only block."""
    spark = blocks.sparkSession

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, list[Block]] = {}
        batch = None
        for batch in batches:
            for i in range(batch.num_rows):
                pieces.setdefault(batch.column("run")[i].as_py(), []).append(Block.of(batch, i))
        del batch     # the pieces hold their bytes until they are joined
        for k in list(pieces):
            block = Block.joined(pieces.pop(k), runs[k])
            run = replace(runs[k], columns=list(range(len(block.cells))))
            trees, margins = fit_block(run, block)
            held = block.fold == run.fold
            areas = {m: area(block.label[held], margin[held]) for m, margin in margins.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([k]), pa.array([json.dumps([t.packed() for t in trees])]),
                 pa.array([list(areas)], pa.list_(pa.int64())),
                 pa.array([list(areas.values())], pa.list_(pa.float64()))],
                names=["run", "trees", "marks", "areas"])

    # one task per run, the long ones first. Each reads the pieces from the files: neither the
    # driver nor an exchange holds the block, which is bounded by block_rows
    order = sorted(range(len(runs)), key=lambda k: -runs[k].work())
    numbers = spark.createDataFrame(list(enumerate(order)), "place long, run long")
    dealt = blocks.coalesce(1).hint("shuffle_replicate_nl").crossJoin(
        numbers.repartitionByRange(len(runs), "place").drop("place"))
    found = materialise(dealt.mapInArrow(
        work, "run long, trees string, marks array<long>, areas array<double>"), "boosting-runs")
    rows = found.collect()  # a row per run
    trees = {r.run: [Nodes.unpacked(p) for p in json.loads(r.trees)] for r in rows}
    return trees, {(r.run, m): a for r in rows for m, a in zip(r.marks, r.areas)}


# ---- many blocks: one aggregation per round ------------------------------------------------

BEST = ("run long, node long, gain double, feature long, range long, left_g double, "
        "left_h double, g double, h double")


def _round(state: DataFrame, runs: list[Run], growing: dict[int, Growing], tree: int,
           tasks: int) -> dict[int, dict[int, tuple]]:
    """Best splits of all wanted nodes of all runs: sums per task, merged per run where the
    splits are found; only those reach the driver."""
    wanted = {k: g.wanted() for k, g in growing.items()}
    wanted = {k: w for k, w in wanted.items() if w}
    shapes = {k: growing[k].skeleton() for k in wanted}
    mine = {k: tree_columns(runs[k].columns, tree, runs[k].settings.colsample_bytree,
                            runs[k].seed) for k in wanted}

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.of(batch, i)
                margins = _margins(batch, i, len(runs))
                for k, nodes in wanted.items():
                    run, shape = runs[k], shapes[k]
                    use = np.flatnonzero(run.rows(block, tree))
                    cells = block.cells[run.columns][:, use]
                    slot = np.full(len(shape.feature), -1, np.int32)
                    slot[nodes] = np.arange(len(nodes))
                    g, h = gradients(margins[k][use], block.label[use], run.weights)
                    sums = sums_of(Packs.of(cells[mine[k]]), slot[shape.leaf_of(cells)], g, h,
                                   len(nodes), run.ranges)
                    total[k] = total[k] + sums if k in total else sums
        for k, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([sums.tobytes()])],
                                             names=["run", "sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, sums in zip(batch.column("run").to_pylist(), batch.column("sums")):
                sums = np.frombuffer(sums.as_buffer(), np.float64)
                total[k] = total[k] + sums if k in total else sums
        for k, sums in total.items():
            run = runs[k]
            sums = sums.reshape(2, len(mine[k]), len(wanted[k]), run.ranges)
            rows = [(k, n, *b) for n, b in zip(wanted[k], best_splits(sums, run.settings, mine[k]))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                             names=[f.split()[0] for f in BEST.split(", ")])

    found: dict[int, dict[int, tuple]] = {k: {} for k in wanted}
    if wanted:
        best = (state.mapInArrow(partial, "run long, sums binary").repartition(tasks, "run")
                .mapInArrow(merge, BEST))
        for r in best.collect():  # a row per run and open node
            found[r.run][r.node] = tuple(r[2:])
    return found


def _margins(batch: pa.RecordBatch, i: int, runs: int) -> np.ndarray:
    """Runs x rows margins of a block; zero before the first tree."""
    held = batch.column("margins")[i]
    if not held.is_valid:
        return np.zeros((runs, batch.column("n")[i].as_py()))
    return np.frombuffer(held.as_buffer(), np.float64).reshape(runs, -1)


def _advance(state: DataFrame, runs: list[Run], trees: dict[int, Nodes]) -> DataFrame:
    """The margins after one more tree of every run that still grows."""
    names = state.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                block = Block.of(batch, i)
                margins = _margins(batch, i, len(runs)).copy()
                for k, tree in trees.items():
                    margins[k] += tree.value[tree.leaf_of(block.cells[runs[k].columns])]
                made.append(margins.tobytes())
            columns = [batch.column(n) for n in names[:-1]] + [pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return materialise(state.mapInArrow(work, state.schema), "boosting-state")


def _fit_rounds(blocks: DataFrame, runs: list[Run]
                ) -> tuple[dict[int, list[Nodes]], dict[tuple[int, int], float | None]]:
    from lendmill.operators.evaluate import roc_auc

    spark = blocks.sparkSession
    tasks = min(len(runs), int(spark.conf.get("spark.sql.shuffle.partitions")))
    state = blocks.withColumn("margins", F.lit(None).cast("binary"))
    trees: dict[int, list[Nodes]] = {k: [] for k in range(len(runs))}
    marked = []
    for t in range(max(r.settings.n_estimators for r in runs)):
        growing = {k: Growing(r.settings) for k, r in enumerate(runs)
                   if t < r.settings.n_estimators}
        while any(g.wanted() for g in growing.values()):
            for k, found in _round(state, runs, growing, t, tasks).items():
                growing[k].take(found)
        new = {k: g.finished() for k, g in growing.items()}
        for k, tree in new.items():
            trees[k].append(tree)
        state = _advance(state, runs, new)
        for k, r in enumerate(runs):
            if t + 1 in r.marks:
                own = F.expr(f"substring(margins, {k} * 8 * n + 1, 8 * n)")
                marked.append(state.select(F.lit(k).cast("bigint").alias("run"),
                                           F.lit(t + 1).cast("bigint").alias("mark"),
                                           own.alias("margin"), "label", "fold"))
    scored = None
    for part in marked:
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        return trees, {}
    areas = roc_auc(margins_long(scored, runs), "label", "score", ["run", "mark"])
    return trees, {(r.run, r.mark): r.roc_auc for r in areas.collect()}  # a row per run and mark


# ---- models --------------------------------------------------------------------------------

@dataclass
class BoostedTrees:
    """A fitted model: trees over range numbers, the cuts behind them, and what scoring needs."""

    trees: list[Nodes]
    cuts: list[np.ndarray]
    settings: dict
    codes: dict = field(default_factory=dict)   # feature position: sorted values, their codes, other

    def margin(self, x: np.ndarray) -> np.ndarray:
        cells = quantise(self.coded(x), self.cuts)
        out = np.zeros(len(x))
        for tree in self.trees:
            out += tree.value[tree.leaf_of(cells)]
        return out

    def coded(self, x: np.ndarray) -> np.ndarray:
        """The rows with category columns replaced by their target statistics."""
        if not self.codes:
            return x
        x = x.copy()
        for j, (values, codes, other) in self.codes.items():
            at = np.searchsorted(values, x[:, j]).clip(0, len(values) - 1)
            x[:, j] = np.where(values[at] == x[:, j], codes[at], other)
        return x

    def probability(self, features: Column) -> Column:
        """Probability of class 1 for an ``array<double>`` of features."""
        width, model = len(self.cuts), self

        @F.arrow_udf("double")
        def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for rows in batches:
                x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                yield pa.array(1 / (1 + np.exp(-model.margin(x))))

        return compute(features)

    def paths(self) -> list[Tree]:
        """The trees as leaf paths over feature values, as SHAP and LIME read them."""
        out = []
        for tree in self.trees:
            splits: list[tuple[int, float]] = []
            leaves, todo = [], [(0, [])]
            while todo:
                n, path = todo.pop()
                f = int(tree.feature[n])
                if f < 0:
                    leaves.append(_leaf(float(tree.value[n]), path))
                    continue
                cuts, b = self.cuts[f], int(tree.limit[n])
                k = len(splits)
                splits.append((f, float(cuts[b]) if b < len(cuts) else float("inf")))
                for child, left in ((int(tree.left[n]), True), (int(tree.right[n]), False)):
                    share = tree.cover[child] / tree.cover[n] if tree.cover[n] else 0.5
                    todo.append((child, [*path, (f, float(share), k, left)]))
            out.append(Tree(np.array([f for f, _ in splits], np.int64),
                            np.array([v for _, v in splits], np.float64), leaves))
        return out

    def importance(self) -> np.ndarray:
        """Gain per feature, scaled to sum to one."""
        total = np.zeros(len(self.cuts))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return total / total.sum() if total.sum() > 0 else total

    def state(self) -> str:
        return json.dumps({
            "trees": [t.packed() for t in self.trees], "cuts": [c.tolist() for c in self.cuts],
            "settings": self.settings, "codes": {j: [v.tolist(), k.tolist(), o]
                                                 for j, (v, k, o) in self.codes.items()}})

    @staticmethod
    def of_state(text: str) -> "BoostedTrees":
        raw = json.loads(text)
        return BoostedTrees([Nodes.unpacked(t) for t in raw["trees"]],
                            [np.array(c, np.float64) for c in raw["cuts"]], raw["settings"],
                            {int(j): (np.array(v), np.array(k), o)
                             for j, (v, k, o) in raw["codes"].items()})


def margins_long(scored: DataFrame, runs: list[Run]) -> DataFrame:
    """(run, mark, label, score) of the rows that a run left out."""
    folds = [r.fold for r in runs]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                k, mark = batch.column("run")[i].as_py(), batch.column("mark")[i].as_py()
                read = lambda n, d: np.frombuffer(batch.column(n)[i].as_buffer(), d)
                held = read("fold", np.int8) == folds[k]
                n = int(held.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, k)), pa.array(np.full(n, mark)),
                     pa.array(read("label", np.uint8)[held].astype(np.int32)),
                     pa.array(read("margin", np.float64)[held])],
                    names=["run", "mark", "label", "score"])

    return scored.mapInArrow(work, "run long, mark long, label int, score double")


def fit_many(blocks: DataFrame, runs: list[Run]
             ) -> tuple[dict[int, list[Nodes]], dict[tuple[int, int], float | None]]:
    """Trees of every run, and the ROC-AUC of the rows it left out by (run, mark)."""
    one = len(blocks.select("block").distinct().limit(2).collect()) <= 1
    return (_fit_runs if one else _fit_rounds)(blocks, runs)


def points_of(grid: dict) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def settings_of(params: dict, growth: str) -> Settings:
    """Settings under the names of the published grids."""
    names = {"depth": "max_depth", "iterations": "n_estimators"}
    return Settings(growth=growth, **{names.get(k, k): v for k, v in params.items()})


def shared_settings(s: Settings) -> Settings:
    """Those of the run that grows a point's trees: without their number, and without a leaf limit
    that a tree of this depth cannot reach."""
    leaves = s.num_leaves if s.num_leaves < 1 << s.max_depth else 0
    return replace(s, n_estimators=0, num_leaves=leaves)


def search(df: DataFrame, features: list[str], grid: dict, growth: str = "best", folds: int = 3,
           label: str = "default", id_col: str = "app_id", seed: int = 42,
           weights: tuple[float, float] = (1.0, 1.0), ranges: int = 64,
           block_rows: int = BLOCK_ROWS, versions: dict[int, list[str]] | None = None,
           codes: dict | None = None
           ) -> tuple[BoostedTrees, dict, list[tuple[dict, float | None, list]]]:
    """Every grid point on every fold and on all rows, at once; the best point by mean ROC-AUC
    (ties: the earlier point) with its model on all rows. ``df`` has the column ``fold``.

    ``versions`` names other columns to use for the features of a run that leaves out fold k
    (-1: none), for statistics that must not see the fold.
    """
    points = points_of(grid)
    of_fold = lambda k: (versions or {}).get(k, features)
    columns = list(dict.fromkeys(c for k in range(-1, folds) for c in of_fold(k)))
    place = {c: i for i, c in enumerate(columns)}
    # points that differ only in their number of trees share a run
    groups: dict[Settings, list[int]] = {}
    for p in points:
        s = settings_of(p, growth)
        groups.setdefault(shared_settings(s), []).append(s.n_estimators)
    runs, place_of = [], {}
    for key, sizes in groups.items():
        for k in [*range(folds), -1]:
            place_of[key, k] = len(runs)
            runs.append(Run(replace(key, n_estimators=max(sizes)), k,
                            [place[c] for c in of_fold(k)], weights, seed, ranges,
                            sorted(set(sizes)) if k >= 0 else []))
    cuts = cut_values(df, columns, ranges)
    blocks = blocks_of(df, columns, cuts, label, id_col, "fold" if folds else None, block_rows,
                       len(runs))
    trees, found = fit_many(blocks, runs)
    table = []
    for p in points:
        s = settings_of(p, growth)
        own = [found.get((place_of[shared_settings(s), k], s.n_estimators))
               for k in range(folds)]
        known = [a for a in own if a is not None]
        table.append((p, sum(known) / len(known) if known else None, own))
    best = max(range(len(points)), key=lambda i: (table[i][1] or 0.0, -i))
    s = settings_of(points[best], growth)
    number = place_of[shared_settings(s), -1]
    model = BoostedTrees(trees[number][:s.n_estimators], [cuts[c] for c in runs[number].columns],
                         asdict(s), codes or {})
    return model, points[best], table
