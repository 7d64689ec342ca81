"""Boosting and extremely randomised trees against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchstats.operators import trees as T

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 700
    x = np.stack([rng.normal(size=n), rng.integers(0, 4, n).astype(float), rng.exponential(size=n)])
    label = np.clip((x[0] + 0.5 * x[1] + rng.normal(size=n) > 0.4).astype(int) + (x[2] > 1.2), 0, 2)
    weight = rng.integers(1, 4, n).astype(float)
    fold = np.sort(rng.integers(-1, 2, n))
    rows = [(float(x[0, i]) if i % 50 else None, float(x[1, i]), float(x[2, i]), int(label[i]), float(weight[i]), int(fold[i]))
            for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int, weight double, fold int").repartition(3).persist()
    x[0, ::50] = -np.inf
    return df, x, label, weight, fold


def boosted_by_brute_force(x, label, weight, cuts, rounds, depth, rate):
    """(trees as nested dicts, margins): every cut of every node tried in turn."""
    total = np.array([weight[label == k].sum() for k in range(3)])
    margin = np.repeat(np.log(total / total.sum())[:, None], len(label), axis=1)
    trees = []

    def grow(rows, g, h, level):
        best = None
        if level < depth:
            for f, cut in ((f, c) for f in range(len(x)) for c in cuts[f]):
                left, right = rows[x[f, rows] <= cut], rows[x[f, rows] > cut]
                if len(left) and len(right):
                    wl, wr = weight[left].sum(), weight[right].sum()
                    gain = wl * wr / (wl + wr) * (g[left].sum() / wl - g[right].sum() / wr) ** 2
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, cut, left, right
        if best is None:
            return {"value": 2 / 3 * g[rows].sum() / h[rows].sum() if level else 0.0}
        gain, f, cut, left, right = best
        return {"gain": gain, "f": f, "cut": cut, "left": grow(left, g, h, level + 1), "right": grow(right, g, h, level + 1)}

    def value(tree, i):
        while "f" in tree:
            tree = tree["left"] if x[tree["f"], i] <= tree["cut"] else tree["right"]
        return tree["value"]

    for _ in range(rounds):
        p = T.softmax(margin)
        for k in range(3):
            tree = grow(np.arange(len(label)), weight * ((label == k) - p[k]), weight * p[k] * (1 - p[k]), 0)
            trees.append(tree)
            margin[k] = margin[k] + rate * np.array([value(tree, i) for i in range(len(label))])
    return trees, margin


def same_tree(forest, node, tree):
    if "f" not in tree:
        assert forest.feature[node] == -1 and np.isclose(forest.value[node, 0], tree["value"])
        return
    assert forest.feature[node] == tree["f"] and np.isclose(forest.threshold[node], tree["cut"])
    assert np.isclose(forest.gain[node], tree["gain"])
    same_tree(forest, forest.left[node], tree["left"])
    same_tree(forest, forest.left[node] + 1, tree["right"])


@pytest.mark.parametrize("driver_bytes,wide", [(1 << 30, 256), (0, 256), (0, 1)])
def test_boosting_equals_brute_force(monkeypatch, table, driver_bytes, wide):
    """Splits, gains, leaf values and margins, for two folds at once; sums on the driver or on the executors."""
    monkeypatch.setattr(T, "DRIVER_BYTES", driver_bytes)
    monkeypatch.setattr(T, "WIDE", wide)
    monkeypatch.setattr(T, "BLOCK_ROWS", 100)
    df, x, label, weight, fold = table
    params = {"maxIter": 2, "maxDepth": 3, "stepSize": 0.3}
    models, state = T.train_boosting(df, FEATS, [1, T.ALL_ROWS], params)
    cuts = T.quantile_cuts(df, FEATS)
    scored = T.scored_blocks(state, [1]).toPandas()
    T.released(state)
    for model, train in zip(models, [fold < 1, fold < 9]):
        trees, margin = boosted_by_brute_force(x[:, train], label[train], weight[train], cuts, 2, 3, 0.3)
        for t, tree in enumerate(trees):
            forest = model.forests[t // 3]
            same_tree(forest, forest.root[t % 3], tree)
        assert np.allclose(model.probabilities(x[:, train]), T.softmax(margin))
    p = models[0].probabilities(x[:, fold == 1])
    assert len(scored) == (fold == 1).sum()
    assert np.allclose(np.sort(scored.p_home), np.sort(p[0])) and np.allclose(np.sort(scored.p_draw), np.sort(p[1]))


def test_boosting_is_one_job_per_level(monkeypatch, table):
    df, *_ = table
    calls = []
    real = T.combined
    monkeypatch.setattr(T, "combined", lambda *a, **k: calls.append(a[2]) or real(*a, **k))
    _, state = T.train_boosting(df, FEATS, [0, 1, 2, 3], {"maxIter": 3, "maxDepth": 2})
    T.released(state)
    assert len(calls) == 3 * 2
    assert calls[0][0] == 4 * 3 and calls[1][0] <= 4 * 3  # all folds and classes at once, one child of each pair


def test_subsample_and_empty_folds(table):
    df, x, label, *_ = table
    models, state = T.train_boosting(df, FEATS, [-5, T.ALL_ROWS], {"maxIter": 3, "maxDepth": 2, "subsamplingRate": 0.5})
    T.released(state)
    assert all((f.feature == -1).all() for f in models[0].forests)  # nothing to learn from
    p = models[1].probabilities(x)
    assert np.allclose(p.sum(axis=0), 1) and (p.argmax(axis=0) == label).mean() > 0.5


@pytest.mark.parametrize("driver_bytes", [1 << 30, 0])
def test_extra_trees(monkeypatch, table, driver_bytes):
    """Cuts lie within their node's range, sums and leaf shares equal a recount, equal seeds give equal trees."""
    monkeypatch.setattr(T, "DRIVER_BYTES", driver_bytes)
    monkeypatch.setattr(T, "SMALL_BLOCK_ROWS", 150)
    df, x, label, weight, fold = table
    params = {"numTrees": 7, "maxDepth": 5}
    models, state = T.train_extra_trees(df, FEATS, [1, T.ALL_ROWS], params)
    scored = T.scored_blocks(state, [1], boosting=False).toPandas()
    T.released(state)
    for model, train in zip(models, [fold < 1, fold < 9]):
        xs, ys = x[:, train], label[train]
        n = np.bincount(ys, minlength=3)
        w = weight[train] * (n.sum() / (3 * n))[ys]
        assert sum(len(f.root) for f in model.forests) == 7
        splits = 0
        for forest in model.forests:
            def walk(node, rows, depth):
                total = np.bincount(ys[rows], w[rows], minlength=3)
                assert len(rows) and np.allclose(forest.value[node], total / total.sum())
                if forest.feature[node] < 0:
                    return 0
                v, cut = xs[forest.feature[node], rows], forest.threshold[node]
                assert depth < 5 and v.max() > cut and v.min() <= cut
                left, right = rows[v <= cut], rows[v > cut]
                l, r = (np.bincount(ys[q], w[q], minlength=3) for q in (left, right))
                gini = lambda s: s.sum() * (1 - ((s / s.sum()) ** 2).sum())
                assert np.isclose(forest.gain[node], gini(total) - gini(l) - gini(r))
                return 1 + walk(forest.left[node], left, depth + 1) + walk(forest.left[node] + 1, right, depth + 1)
            splits += sum(walk(r, np.arange(train.sum()), 0) for r in forest.root)
        assert splits > 7 * 8
        assert len({round(float(t), 9) for f in model.forests for t in f.threshold[f.feature == 0]}) > 10
    p = models[0].probabilities(x[:, fold == 1])
    assert np.allclose(np.sort(scored.p_away), np.sort(p[2]))
    again, state = T.train_extra_trees(df, FEATS, [1], params)
    T.released(state)
    assert np.allclose(again[0].probabilities(x), T.train_extra_trees(df, FEATS, [1], params)[0][0].probabilities(x))


def test_cuts_are_uniform_in_the_range():
    rng = np.random.default_rng(1)
    ranges = np.tile([2.0, -6.0], (20_000, 1, 1))
    cut = T.drawn_cuts(ranges, rng.random((20_000, 1)))
    assert cut.min() >= 2 and cut.max() < 6
    assert np.allclose(np.histogram(cut, 8, (2, 6))[0] / 20_000, 1 / 8, atol=0.01)
    same = T.drawn_cuts(np.array([[[3.0, -3.0]], [[np.inf, np.inf]]]), np.array([[0.5], [0.5]]))
    assert np.isnan(same).all()


def test_scores_and_importances(table):
    df, x, label, *_ = table
    models, state = T.train_boosting(df, FEATS, [T.ALL_ROWS], {"maxIter": 5, "maxDepth": 3})
    T.released(state)
    out = T.score_rows(models[0], df.withColumn("extra", F.lit("k"))).toPandas()
    assert np.allclose(out.p_home + out.p_draw + out.p_away, 1) and (out.extra == "k").all() and len(out) == len(label)
    imp = models[0].importances()
    assert np.isclose(imp.sum(), 1) and imp.min() > 0


def test_boosting_writes_blocks_every_few_rounds(table, monkeypatch):
    df, *_ = table
    written, kept = [], T.work_table
    monkeypatch.setattr(T, "work_table", lambda rows, name: written.append(name) or kept(rows, name))
    monkeypatch.setattr(T, "WRITE_ROUNDS", 3, raising=False)
    params = {"maxIter": 7, "maxDepth": 2}
    models, state = T.train_boosting(df, FEATS, [0, 1], params)
    assert len(written) == 4  # the first blocks, after rounds 3 and 6, and the last ones
    x = df.select(*FEATS, "label", "weight", "fold")
    plain = {tuple(r)[:2]: tuple(r)[2:] for r in T.score_rows(models[1], x.filter("fold = 1")).select(
        "a", "c", "p_home", "p_draw", "p_away").collect()}
    got = sorted(tuple(r)[1:] for r in T.scored_blocks(state, [0, 1]).filter("fold = 1").select(
        "fold", "p_home", "p_draw", "p_away").collect())
    T.released(state)
    assert np.allclose(got, sorted(plain.values()))


@pytest.mark.parametrize("subtree_rows,least,driver_bytes", [(1 << 16, 1, 1 << 30), (120, 1, 1 << 30), (120, 9, 0)])
def test_forest(monkeypatch, table, subtree_rows, least, driver_bytes):
    """With every row drawn once and all features at each node a tree is known: each node takes its best cut, sums equal a
    recount, no two leaves of one parent predict the same class; whether tasks grow whole trees or small subtrees."""
    monkeypatch.setattr(T, "SUBTREE_ROWS", subtree_rows)
    monkeypatch.setattr(T, "DRIVER_BYTES", driver_bytes)
    monkeypatch.setattr(T, "drawn_counts", lambda seed, tree, block, n: np.ones(n, np.uint8))
    monkeypatch.setattr(T, "subset_size", lambda strategy, n: n)
    df, x, label, weight, fold = table
    model = T.train_forest(df, FEATS, {"numTrees": 2, "maxDepth": 5, "minInstancesPerNode": least})
    cuts = T.quantile_cuts(df, FEATS)
    n = np.bincount(label, minlength=3)
    w = weight * (n.sum() / (3 * n))[label]
    gini = lambda s: s.sum() * (1 - ((s / s.sum()) ** 2).sum())
    sums = lambda q: np.bincount(label[q], w[q], minlength=3)
    assert sum(len(f.root) for f in model.forests) == 2

    def walk(forest, node, rows, depth):
        total = sums(rows)
        assert np.allclose(forest.value[node], total / total.sum())
        if forest.feature[node] < 0:
            return 1
        best = max(gini(total) - gini(sums(rows[x[f, rows] <= c])) - gini(sums(rows[x[f, rows] > c])) for f in range(3) for c in cuts[f]
                   if min((x[f, rows] <= c).sum(), (x[f, rows] > c).sum()) >= least)
        cut = x[forest.feature[node], rows] <= forest.threshold[node]
        assert depth < 5 and np.isclose(forest.gain[node], best) and min(cut.sum(), (~cut).sum()) >= least
        assert np.isclose(forest.gain[node], gini(total) - gini(sums(rows[cut])) - gini(sums(rows[~cut])))
        a, b = forest.left[node], forest.left[node] + 1
        assert max(forest.feature[a], forest.feature[b]) >= 0 or forest.value[a].argmax() != forest.value[b].argmax()
        return walk(forest, a, rows[cut], depth + 1) + walk(forest, b, rows[~cut], depth + 1)

    for forest in model.forests:
        assert all(walk(forest, r, np.arange(len(label)), 0) > 8 for r in forest.root)


def test_forest_draws(table):
    """Rows and features are drawn: trees differ, equal seeds give equal trees; classes are told apart; few rows go to a task."""
    df, x, label, weight, fold = table
    model, again = (T.train_forest(df, FEATS, {"numTrees": 8, "maxDepth": 4}) for _ in range(2))
    p = model.probabilities(x)
    assert np.array_equal(p, again.probabilities(x)) and np.allclose(p.sum(axis=0), 1)
    balanced = np.mean([(p.argmax(axis=0) == k)[label == k].mean() for k in range(3)])
    assert balanced > 0.6
    forest = model.forests[0]
    assert len({float(forest.threshold[r]) for r in forest.root}) > 1
    got = model.transform(df).toPandas()
    assert len(got) == len(label) and set(got.prediction) <= {0.0, 1.0, 2.0}
    counts = T.drawn_counts(1, 2, 3, 100_000)
    assert abs(counts.mean() - 1) < 0.02 and abs((counts == 0).mean() - np.exp(-1)) < 0.01
    assert [T.subset_size(s, 45) for s in ("sqrt", "log2")] == [7, 6]


def test_pairs_of_features_give_the_plain_histograms():
    """Joint bins of neighbours, added up: of an odd number of features, over lists of rows, into some of the slots."""
    rng = np.random.default_rng(2)
    for n_feats in (1, 4, 5):
        out, plain, rows = np.zeros((6, n_feats, 7, 2)), np.zeros((6, n_feats, 7, 2)), []
        for n in (50, 0, 333):
            x, slot, stats = rng.integers(0, 7, (n_feats, n)).astype(np.uint8), rng.integers(1, 5, n), rng.normal(size=(2, n))
            rows.append((slot, T.pair_codes(x, 7), *stats))
            for f in range(n_feats):
                np.add.at(plain, (slot, f, x[f]), stats.T)
        T.add_pairs(out, rows)
        assert np.allclose(out, plain) and not out[[0, 5]].any()


def test_margins_only_of_rows_that_a_run_needs(table):
    """A row keeps margins of the runs that train or are tested on it, no others."""
    df, x, label, weight, fold = table
    _, state = T.train_boosting(df, FEATS, [0, 1], {"maxIter": 2, "maxDepth": 2})
    kept = sum(len(r["margin"]) for r in state.select("margin").collect())
    T.released(state)
    assert kept == 8 * 3 * ((fold <= 0).sum() + (fold <= 1).sum()) < 8 * 3 * 2 * len(label)


def test_walks_of_uneven_trees():
    """Rows that reach a leaf early are left out of the further steps; nodes equal a walk row by row."""
    rng = np.random.default_rng(3)
    for share in (0.15, 0.5, 1.0):
        forest = T.Forest.roots(np.zeros((2, 1)))
        nodes = forest.root
        for _ in range(8):
            pick = nodes[(rng.random(len(nodes)) < share) | (np.arange(len(nodes)) == 0)]
            z = np.zeros((len(pick), 1))
            nodes = forest.split(pick, rng.integers(0, 4, len(pick)), rng.random(len(pick)), np.ones(len(pick)), z, z)
        x = rng.random((4, 200))
        for tree, count in ((0, None), (1, 70), (1, 0)):
            got = forest.landed(tree, x, count)
            for i in range(200 if count is None else count):
                node = forest.root[tree]
                while forest.feature[node] >= 0:
                    node = forest.left[node] + (x[forest.feature[node], i] > forest.threshold[node])
                assert got[i] == node


@pytest.mark.parametrize("numbers", [3, 4])
def test_large_and_small_nodes_are_counted_alike(monkeypatch, numbers):
    rng = np.random.default_rng(4)
    x, label = rng.integers(0, 32, (6, 900)).astype(np.uint8), rng.integers(0, 3, 900).astype(np.uint8)
    nodes, drawn = np.array([0, 2, 3]), np.stack([rng.permutation(6)[:2] for _ in range(4)])
    rows = [np.arange(0, 500), np.arange(500, 520), np.arange(520, 900)]
    weight, count = rng.random(900), rng.integers(1, 4, 900).astype(np.uint8)
    plain = np.zeros((4, 2, 32, numbers))
    for node, some in zip(nodes, rows):
        for j in range(2):
            np.add.at(plain, (node, j, x[drawn[node, j], some], label[some]), weight[some])
            if numbers > 3:
                np.add.at(plain, (node, j, x[drawn[node, j], some], 3), count[some])
    for least in (1, 100, 10_000):
        monkeypatch.setattr(T, "NODE_ROWS", least)
        out = np.zeros(plain.shape)
        T.add_nodes(out, T.class_codes(x, label, 32), x, label, nodes, rows, drawn, [weight[r] for r in rows], [count[r] for r in rows])
        assert np.allclose(out, plain)


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_forest_leaves_no_rows_on_the_disks(spark, table, monkeypatch):
    """Each group of trees hands over its rows in a shuffle that goes with it; the setting is as before."""
    import time
    from matchstats.session import SHUFFLE_CLEANUP
    df, *_ = table
    monkeypatch.setattr(T, "GROUP_BYTES", 1)  # a group for each tree
    seen, real = [], T._forest

    def grown(*a):
        before, until = shuffle_files(spark), time.time() + 20
        out = real(*a)
        while shuffle_files(spark) > before and time.time() < until:  # files are removed in the background
            time.sleep(0.1)
        seen.append(shuffle_files(spark) - before)
        return out

    monkeypatch.setattr(T, "_forest", grown)
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    T.train_forest(df, FEATS, {"numTrees": 3, "maxDepth": 3})
    assert len(seen) == 3 and max(seen) <= 0 and spark.conf.get(SHUFFLE_CLEANUP, None) == was
