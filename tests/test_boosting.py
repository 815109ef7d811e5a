"""Histogram boosting against plain enumeration; blocks, folds, persistence, explanations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendmill.operators import boosting, evaluate, shap, train
from lendmill.operators.target_codes import ordered_codes
from lendmill.sources.models import load_classifier, save_classifier

NAMES = ["a", "b", "c"]


def toy(rows=240, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        a, b, c = rng.gauss(0, 1), rng.randint(0, 6), rng.choice([0.0, 1.0, 5.0])
        y = int(rng.random() < 1 / (1 + math.exp(-(2 * a - (b > 3) + (c == 5.0) * a))))
        out.append((i, a, float(b), c, y, i % 3))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(toy(), "app_id long, a double, b double, c double, "
                                        "default int, fold int")


def plain_gain(g, h, rows, left, s):
    def part(some):
        return sum(g[i] for i in some) ** 2 / (sum(h[i] for i in some) + s.reg_lambda)
    right = [i for i in rows if i not in left]
    if min(sum(h[i] for i in left), sum(h[i] for i in right)) < s.min_child_weight:
        return -math.inf
    return part(left) + part(right) - part(rows)


def plain_split(x, cuts, g, h, rows, s):
    """Best (gain, feature, cut) by trying every cut of every feature."""
    best = (-math.inf, 0, 0)
    for f in range(x.shape[1]):
        for k, cut in enumerate(cuts[f]):
            left = {i for i in rows if x[i, f] <= cut}
            if 0 < len(left) < len(rows):
                gain = plain_gain(g, h, rows, left, s)
                if gain > best[0] + 1e-9:
                    best = (gain, f, k)
    return best


def plain_tree(x, cuts, g, h, s):
    """Leaves as sets of rows, splitting the leaf of the largest gain first."""
    leaves = [(list(range(len(x))), 0)]
    most = s.num_leaves or 1 << 30
    while len(leaves) < most:
        options = [(plain_split(x, cuts, g, h, rows, s), i) for i, (rows, d) in enumerate(leaves)
                   if d < s.max_depth]
        options = [o for o in options if o[0][0] > max(s.gamma, 1e-6)]
        if not options:
            break
        (gain, f, k), i = max(options, key=lambda o: o[0][0])
        rows, depth = leaves.pop(i)
        leaves += [([r for r in rows if x[r, f] <= cuts[f][k]], depth + 1),
                   ([r for r in rows if x[r, f] > cuts[f][k]], depth + 1)]
    return [rows for rows, _ in leaves]


def plain_symmetric(x, cuts, g, h, s):
    leaves = [list(range(len(x)))]
    for _ in range(s.max_depth):
        best = (-math.inf, 0, 0)
        for f in range(x.shape[1]):
            for k, cut in enumerate(cuts[f]):
                total = 0.0
                for rows in leaves:
                    left = {i for i in rows if x[i, f] <= cut}
                    total += max(plain_gain(g, h, rows, left, s), 0.0) if 0 < len(left) < len(
                        rows) else 0.0
                if total > best[0] + 1e-9:
                    best = (total, f, k)
        if best[0] <= max(s.gamma, 1e-6):
            break
        _, f, k = best
        leaves = [part for rows in leaves for part in (
            [r for r in rows if x[r, f] <= cuts[f][k]], [r for r in rows if x[r, f] > cuts[f][k]])]
    return [rows for rows in leaves if rows]


@pytest.mark.parametrize("changes", [
    {"max_depth": 3}, {"max_depth": 4, "num_leaves": 5}, {"max_depth": 3, "gamma": 4.0},
    {"max_depth": 3, "min_child_weight": 8.0, "reg_lambda": 0.5},
    {"max_depth": 3, "growth": "symmetric"}])
def test_trees_equal_plain_enumeration(table, changes):
    rows = toy()
    x = np.array([r[1:4] for r in rows])
    y = np.array([r[4] for r in rows])
    s = boosting.Settings(n_estimators=3, learning_rate=0.5, **changes)
    grid = {k: [v] for k, v in changes.items() if k != "growth"}
    model, _, _ = boosting.search(table, NAMES, {"n_estimators": [3], "learning_rate": [0.5], **grid},
                                  s.growth, 0, weights=(1.0, 2.0), ranges=16)
    margin = np.zeros(len(x))
    for _ in range(3):
        g, h = boosting.gradients(margin, y, (1.0, 2.0))
        grow = plain_symmetric if s.growth == "symmetric" else plain_tree
        for leaf in grow(x, model.cuts, g, h, s):
            margin[leaf] -= 0.5 * g[leaf].sum() / (h[leaf].sum() + s.reg_lambda)
    assert np.allclose(model.margin(x), margin, atol=1e-9)


@pytest.mark.parametrize("kind,grid", [
    ("best", {"n_estimators": [2, 4], "max_depth": [3], "subsample": [0.7],
              "colsample_bytree": [0.7], "learning_rate": [0.3]}),
    ("best", {"n_estimators": [3], "num_leaves": [5], "learning_rate": [0.3, 0.1]}),
    ("symmetric", {"iterations": [3], "depth": [3], "learning_rate": [0.3]})])
def test_blocks_do_not_change_trees_or_scores(table, monkeypatch, kind, grid):
    one = boosting.search(table, NAMES, grid, kind, 3)
    calls = []
    rounds = boosting._fit_rounds
    monkeypatch.setattr(boosting, "_fit_rounds", lambda *a: calls.append(1) or rounds(*a))
    monkeypatch.setattr(boosting, "STATE_BYTES", 1)
    many = boosting.search(table.repartition(5), NAMES, grid, kind, 3, block_rows=100)
    assert calls
    assert one[0].state() == many[0].state()
    assert one[1:] == many[1:]


def test_a_left_out_fold_has_no_influence(spark, table):
    grid = {"n_estimators": [4], "max_depth": [3], "learning_rate": [0.3]}
    cuts = boosting.cut_values(table, NAMES, 64)
    changed = table.withColumn("default", F.when(F.col("fold") == 1, 1 - F.col("default"))
                               .otherwise(F.col("default")))
    trees = []
    for df in (table, changed):
        blocks = boosting.blocks_of(df, NAMES, cuts, "default", "app_id", "fold", 1_000)
        run = boosting.Run(boosting.settings_of({k: v[0] for k, v in grid.items()}, "best"), 1,
                           [0, 1, 2], (1.0, 1.0), 42, 64, [4])
        trees.append([t.packed() for t in boosting.fit_many(blocks, [run])[0][0]])
    assert trees[0] == trees[1]


def test_fold_scores_are_areas_of_left_out_rows(spark, table):
    """The score of a point equals the area of models fitted without the fold."""
    grid = {"n_estimators": [5], "max_depth": [2], "learning_rate": [0.3]}
    _, _, ((_, mean, by_fold),) = boosting.search(table, NAMES, grid, "best", 3)
    x = np.array([r[1:4] for r in toy()])
    y, fold = (np.array([r[i] for r in toy()]) for i in (4, 5))
    cuts = boosting.cut_values(table, NAMES, 64)
    blocks = boosting.blocks_of(table, NAMES, cuts, "default", "app_id", "fold", 1_000)
    for k in range(3):
        run = boosting.Run(boosting.settings_of({n: v[0] for n, v in grid.items()}, "best"), k,
                           [0, 1, 2], (1.0, 1.0), 42, 64, [5])
        trees = boosting.fit_many(blocks, [run])[0][0]
        p = boosting.BoostedTrees(trees, cuts, {}).margin(x)[fold == k]
        pos, neg = p[y[fold == k] == 1], p[y[fold == k] == 0]
        area = np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])
        assert abs(area - by_fold[k]) < 1e-12
    assert abs(mean - sum(by_fold) / 3) < 1e-12


def test_one_class_and_tiny_tables(spark):
    df = spark.createDataFrame([(1, 0.5, 1.0, 2.0, 0), (2, 0.7, 1.0, 2.0, 0)],
                               "app_id long, a double, b double, c double, default int")
    fitted = train.train(df, NAMES, "histogram", {"n_estimators": 3})
    p = [r.p_model for r in train.score(fitted, df).collect()]
    assert all(0 < v < 0.5 for v in p)


def test_persistence_importance_and_shap(spark, table, tmp_path):
    fitted = train.train(table, NAMES, "leafwise", {"n_estimators": 8, "num_leaves": 6})
    save_classifier(fitted, str(tmp_path), spark)
    loaded = load_classifier(spark, str(tmp_path))
    one, two = (train.score(f, table).orderBy("app_id").collect() for f in (fitted, loaded))
    assert one == two
    assert abs(sum(r.importance for r in train.feature_importance(loaded, spark).collect()) - 1) < 1e-9
    rows = shap.add_tree_shap(table, loaded).join(train.score(loaded, table), "app_id").collect()
    for r in rows:
        assert abs(r.base_value + sum(r.shap) - math.log(r.p_model / (1 - r.p_model))) < 1e-9


# ---- ordered target statistics ---------------------------------------------------------------

def test_codes_never_depend_on_the_own_label(spark):
    rng = random.Random(3)
    rows = [(i, float(rng.randrange(4)), float(i % 2), rng.random() < 0.4) for i in range(200)]
    schema = "app_id long, k double, m double, default boolean"
    df = spark.createDataFrame(rows, schema).withColumn("default", F.col("default").cast("int"))
    flipped = df.withColumn("default", F.when(F.col("app_id") == 77, 1 - F.col("default"))
                            .otherwise(F.col("default")))
    def codes(some):
        out, versions, model = ordered_codes(some, ["k", "m"], ["k"], "default", "app_id")
        name = versions[-1][0]
        return {r.app_id: r[name] for r in out.collect()}, model
    (a, model), (b, _) = codes(df), codes(flipped)
    prior = sum(r[3] for r in rows) / len(rows)
    change = 1 / len(rows)  # the prior moves with every label
    assert abs(a[77] - b[77]) <= change + 1e-12
    place = {r.app_id: r.p for r in df.select("app_id", F.pmod(
        F.xxhash64(F.lit(42), "app_id"), F.lit(1 << 52)).alias("p")).collect()}
    for i, k, _, _ in rows:  # equal to walking the rows in order
        earlier = [r[3] for r in rows if r[1] == k and place[r[0]] < place[i]]
        assert abs(a[i] - (sum(earlier) + prior) / (len(earlier) + 1)) < 1e-12
    values, found, _ = model[0]
    for v, m in zip(values, found):
        mine = [r[3] for r in rows if r[1] == v]
        assert abs(m - (sum(mine) + prior) / (len(mine) + 1)) < 1e-12


def test_codes_of_a_fold_come_from_the_other_rows(spark):
    rows = [(i, float(i % 5), int(i % 7 < 3), i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "app_id long, k double, default int, fold int")
    flipped = df.withColumn("default", F.when(F.col("fold") == 1, 1 - F.col("default"))
                            .otherwise(F.col("default")))
    tables = []
    for some in (df, flipped):
        out, versions, _ = ordered_codes(some, ["k"], ["k"], "default", "app_id", 3)
        tables.append({r.app_id: r[versions[1][0]] for r in out.collect()})
    assert tables[0] == tables[1]


def test_ordered_boosting_scores_with_whole_statistics(spark):
    rng = random.Random(9)
    rows = [(i, float(rng.randrange(6)), rng.random(), 0) for i in range(400)]
    rows = [(i, k, x, int(rng.random() < (0.1 + 0.15 * k))) for i, k, x, _ in rows]
    df = spark.createDataFrame(rows, "app_id long, k double, x double, default int")
    fitted = train.grid_search(df, ["k", "x"], {"iterations": [5, 10], "depth": [2]}, "ordered",
                               categorical=["k"])
    assert fitted.cv_score > 0.6
    unseen = spark.createDataFrame([(1, 99.0, 0.5)], "app_id long, k double, x double")
    assert 0 < train.score(fitted, unseen).first().p_model < 1


# ---- interactions and interventional values --------------------------------------------------

def shapley(play, n):
    """Shapley values and halved Shapley interactions of a game by enumeration."""
    single, pair = np.zeros(n), np.zeros((n, n))
    for mask in range(1 << n):
        size = bin(mask).count("1")
        for i in range(n):
            if mask >> i & 1:
                continue
            w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            single[i] += w * (play(mask | 1 << i) - play(mask))
            for j in range(n):
                if j != i and not mask >> j & 1:
                    w = math.factorial(size) * math.factorial(n - size - 2) / (
                        2 * math.factorial(n - 1))
                    pair[i, j] += w * (play(mask | 1 << i | 1 << j) - play(mask | 1 << i)
                                       - play(mask | 1 << j) + play(mask))
    np.fill_diagonal(pair, single - pair.sum(axis=1))
    return single, pair


@pytest.fixture(scope="module")
def small_model(table):
    model, _, _ = boosting.search(table, NAMES, {"n_estimators": [4], "max_depth": [4],
                                                 "learning_rate": [0.4]}, "best", 0, ranges=16)
    return model


def test_interactions_equal_enumeration(small_model):
    trees = small_model.paths()
    x = np.array([r[1:4] for r in toy()[:25]])
    found = shap.interaction_matrix(trees, x)
    for row, ours in zip(x, found):
        total = np.zeros((3, 3))
        for tree in trees:
            for leaf in tree.leaves:
                held = [all((row[tree.split_feature[k]] <= tree.split_threshold[k]) == left
                            for k, left in steps) for steps in leaf.steps]

                def play(mask, leaf=leaf, held=held):
                    out = leaf.value
                    for f, o, z in zip(leaf.features, held, leaf.shares):
                        out *= o if mask >> f & 1 else z
                    return out
                total += shapley(play, 3)[1]
        assert np.allclose(ours, total, atol=1e-10)
    assert np.allclose(found.sum(axis=2), shap.shap_matrix(trees, x), atol=1e-10)


def test_interventional_values_equal_enumeration(small_model):
    trees = small_model.paths()
    rows = np.array([r[1:4] for r in toy()])
    x, others = rows[:20], rows[20:60]
    background = shap.Background(trees, others)
    found = shap.shap_matrix(trees, x, background=background)
    for row, ours in zip(x, found):
        def play(mask, row=row):
            mixed = others.copy()
            for f in range(3):
                if mask >> f & 1:
                    mixed[:, f] = row[f]
            return small_model.margin(mixed).mean()
        assert np.allclose(ours, shapley(play, 3)[0], atol=1e-10)
        assert abs(background.base - play(0)) < 1e-10


def test_interaction_columns(spark, table, small_model):
    fitted = train.Fitted("histogram", small_model, NAMES, {})
    df = shap.add_interactions(table, fitted)
    partners = {r.feature: r for r in shap.strongest_partners(df, NAMES).collect()}
    x = np.array([r[1:4] for r in toy()])
    mean = np.abs(shap.interaction_matrix(small_model.paths(), x)).mean(axis=0)
    np.fill_diagonal(mean, -1)
    for i, n in enumerate(NAMES):
        assert partners[n].partner == NAMES[int(mean[i].argmax())]
        assert abs(partners[n].mean_abs_interaction - mean[i].max()) < 1e-12
    rows = shap.interaction_dependence(df, NAMES, "a").collect()
    assert len(rows) == len(x) and {r.partner for r in rows} == {partners["a"].partner}
    empty = shap.add_interactions(table.limit(0), fitted)
    assert empty.count() == 0


@pytest.mark.parametrize("changes", [{}, {"num_leaves": 6}, {"growth": "symmetric"}])
def test_of_two_siblings_the_smaller_one_is_summed(monkeypatch, changes):
    rng = np.random.default_rng(3)
    n, depth = 40_000, 5
    cells = rng.integers(0, 16, (4, n)).astype(np.uint8)
    label = (rng.random(n) < cells[0] * cells[1] / 300 + 0.1).astype(np.uint8)
    block = boosting.Block(cells, np.arange(n), label, (np.arange(n) % 3).astype(np.int8))
    run = boosting.Run(boosting.Settings(n_estimators=3, max_depth=depth, subsample=0.9, **changes),
                       1, [0, 1, 2, 3], (1.0, 2.0), 42, 16, [3])
    sums_of, rows = boosting.sums_of, []

    def counted(cells, slot, *rest):
        rows.append(int((slot >= 0).sum()))
        return sums_of(cells, slot, *rest)

    monkeypatch.setattr(boosting, "sums_of", counted)
    trees, margins = boosting.fit_block(run, block)
    used = max(rows)
    assert sum(rows) <= 3 * used * (1 + (depth - 1) / 2)
    # the same trees as sums of every node, and margins of the trees walked from their roots
    monkeypatch.setattr(boosting, "sums_by_sibling",
                        lambda wanted, parent, held, cells, at, g, h, ranges: sums_of(
                            cells, np.select([at == n for n in wanted], range(len(wanted)), -1),
                            g, h, len(wanted), ranges))
    plain, again = boosting.fit_block(run, block)
    assert [t.packed() for t in trees] == [t.packed() for t in plain]
    assert (margins[3] == again[3]).all()
    assert (margins[3] == sum(t.value[t.leaf_of(cells)] for t in trees)).all()


def test_many_blocks_keep_all_cores_busy(spark):
    rows = spark.range(30_000).selectExpr("id AS app_id", "CAST(id % 97 AS double) AS a",
                                          "CAST(id % 2 AS int) AS `default`", "0 AS fold")
    cuts = boosting.cut_values(rows, ["a"], 8)
    blocks = boosting.blocks_of(rows, ["a"], cuts, "default", "app_id", "fold", 20_000)
    wanted = min(30, spark.sparkContext.defaultParallelism)
    assert blocks.count() >= wanted and blocks.agg(F.sum("n")).first()[0] == 30_000


def test_leaf_limits_beyond_the_depth_share_a_run(table, monkeypatch):
    """Depth 2 has at most 4 leaves: limits of 4 and 9 are one run, a limit of 3 is another."""
    seen, fit_many = [], boosting.fit_many
    monkeypatch.setattr(boosting, "fit_many", lambda b, runs: seen.extend(runs) or fit_many(b, runs))
    grid = {"n_estimators": [3], "max_depth": [2], "num_leaves": [3, 4, 9]}
    model, best, scores = boosting.search(table, NAMES, grid, "best", 3)
    assert len(seen) == 2 * 4
    assert [p["num_leaves"] for p, _, _ in scores] == [3, 4, 9]
    assert scores[1][1:] == scores[2][1:]
    alone = [boosting.search(table, NAMES, {k: [v] for k, v in p.items()}, "best", 3)
             for p, _, _ in scores]
    assert [a[2][0][1:] for a in alone] == [s[1:] for s in scores]
    assert model.settings["num_leaves"] == best["num_leaves"]


@pytest.mark.parametrize("asked", [[0, 1, 2, 3, 4, 5], [4, 0, 5]])
def test_sums_of_packed_features_equal_sums_by_feature(asked):
    rng = np.random.default_rng(5)
    n, ranges, slots = 40_000, 64, 3
    cells = np.stack([rng.integers(0, k, n) for k in (64, 3, 64, 5, 64, 17)]).astype(np.uint8)
    slot = rng.integers(-1, slots, n)
    g, h = (np.round(rng.normal(size=n) * boosting.GRAIN) / boosting.GRAIN for _ in range(2))
    packs = boosting.Packs.of(cells).only(np.array(asked))
    assert len(packs.numbers) < len(asked)     # several features are counted at once
    found = boosting.sums_of(packs, slot, g, h, slots, ranges)
    for i, f in enumerate(asked):
        for s in range(slots):
            at = slot == s
            for part, weight in zip(found, (g, h)):
                assert (part[i, s] == np.bincount(cells[f][at], weight[at], ranges)).all()
    assert boosting.sums_of(packs, np.full(n, -1), g, h, 1, ranges).sum() == 0


def test_areas_are_found_with_the_margins(spark, table, monkeypatch):
    """One block: no margins are written or ordered again, and the area is that of roc_auc."""
    monkeypatch.setattr(boosting, "margins_long", None)
    _, _, ((_, mean, _),) = boosting.search(table, NAMES, {"n_estimators": [3]}, "best", 3)
    assert 0.5 < mean < 1
    rng = np.random.default_rng(2)
    label, score = rng.integers(0, 2, 500), rng.integers(0, 40, 500) / 7
    rows = spark.createDataFrame(list(zip(label.tolist(), score.tolist())), "y int, s double")
    assert boosting.area(label, score) == evaluate.roc_auc(rows, "y", "s").first().roc_auc
    assert boosting.area(np.zeros(5), np.arange(5.0)) is None


def test_a_block_in_pieces_gives_the_same_models(table, monkeypatch):
    """The only block is stored and read in pieces, and no task but a run's own ever holds it."""
    grid = {"n_estimators": [2, 4], "max_depth": [3], "subsample": [0.7], "learning_rate": [0.3]}
    one = boosting.search(table.coalesce(1), NAMES, grid, "best", 3)
    dealt, fit_many = [], boosting.fit_many
    monkeypatch.setattr(boosting, "fit_many", lambda b, runs: dealt.append(b) or fit_many(b, runs))
    monkeypatch.setattr(boosting, "_fit_rounds", None)
    monkeypatch.setattr(boosting, "PIECE_ROWS", 50)
    many = boosting.search(table.coalesce(1), NAMES, grid, "best", 3)
    assert dealt[0].count() == 5 and dealt[0].agg(F.max("n")).first()[0] <= 50
    assert one[0].state() == many[0].state()
    assert one[1:] == many[1:]


def test_rows_step_down_as_the_tree_walks_them():
    rng = np.random.default_rng(4)
    cells = rng.integers(0, 16, (3, boosting.CHUNK_ROWS + 5_000)).astype(np.uint8)
    growing, at = boosting.Growing(boosting.Settings(max_depth=3)), np.zeros(cells.shape[1], np.int16)
    while wanted := growing.wanted():
        before = len(growing.depth)
        # the third node asked for is never worth a split
        growing.take({n: (float(n != 2), int(n) % 3, 7, 1.0, 1.0, 2.0, 2.0) for n in wanted})
        new = [n for n, c in enumerate(growing.child) if c[0] >= before]
        boosting.step_down(cells, at, growing, new)
    tree = growing.finished()
    assert len(tree.feature) > 7
    assert (growing.place[at] == tree.leaf_of(cells)).all()


def test_sums_of_more_nodes_than_are_taken_at_once():
    rng = np.random.default_rng(6)
    n, slots = 90_000, 2 * boosting.CHUNK_SLOTS + 3
    cells, slot = rng.integers(0, 8, (2, n)).astype(np.uint8), rng.integers(-1, slots, n)
    g, h = boosting.gradients(rng.normal(size=n), rng.integers(0, 2, n), (1.0, 2.0))
    found = boosting.sums_of(boosting.Packs.of(cells), slot, g, h, slots, 8)
    for s in range(slots):
        for f in range(2):
            at = slot == s
            assert (found[0, f, s] == np.bincount(cells[f][at], g[at], 8)).all()
            assert (found[1, f, s] == np.bincount(cells[f][at], h[at], 8)).all()
