"""Newton's fit, boosted trees, their explanations and prefix sums: against plain versions, on several layouts."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from usagelens.functions.prefix import prefix_sums, row_numbers
from usagelens.operators import boosting, logit, ml
from usagelens.plans.catalog import tables
from usagelens.session import written

NAMES = list("abcdef")


def plain_newton(x, y, penalty=1.0):
    """Penalised logistic objective, intercept included, by Newton's method in numpy."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve(penalty * np.eye(len(beta)) + x.T @ (x * (p * (1 - p))[:, None]), penalty * beta + x.T @ (p - y))
    return beta


def some_rows(n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.normal(size=n).round(1), rng.integers(0, 400, n) / 7, rng.exponential(size=n),
                         rng.integers(0, 2, n), rng.normal(size=n)]).astype(float)
    y = (x[:, 0] + 3 * x[:, 4] + rng.normal(size=n) * 3 > 5).astype(int)
    return x, y


def frame_of(spark, x, y, parts=1):
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in NAMES) + ", y int").repartition(parts)


# ---- Newton
@pytest.mark.parametrize("parts", [1, 3, 7])
def test_newton_equals_a_plain_solve(spark, parts):
    x, y = some_rows()
    x = (x - x.mean(0)) / x.std(0)
    w, b = logit.newton_logit(frame_of(spark, x, y, parts), NAMES, "y")
    assert np.abs(np.array([*w, b]) - plain_newton(x, y)).max() < 1e-9


def test_newton_halves_steps_and_ends_without_rows(spark):
    x, y = some_rows()
    x[:, 1] *= 1e4  # unscaled and nearly separable: full steps overshoot
    y = (x[:, 1] > 0).astype(int)
    w, b = logit.newton_logit(frame_of(spark, x, y), NAMES, "y")
    z = np.hstack([x, np.ones((len(x), 1))]) @ np.array([*w, b])
    assert all(map(math.isfinite, [*w, b])) and ((z > 0) == y).mean() > 0.99
    assert logit.newton_logit(frame_of(spark, x, y).where("false"), NAMES, "y") == ([0.0] * 6, 0.0)
    w, b = logit.newton_logit(frame_of(spark, x[:40], np.ones(40, int)), NAMES, "y")  # one class
    assert b > 0 and all(map(math.isfinite, w))


def test_churn_fit_equals_the_objective_on_any_layout(spark):
    feats = ml.prepare_ml_features(tables(spark, SF_SMALL)["user_metrics"])
    pdf = feats.toPandas()
    x = pdf[ml.FEATURES].to_numpy(float)
    sd = x.std(0)
    want = plain_newton((x - x.mean(0)) / np.where(sd > 0, sd, 1), pdf["churn_flag"].to_numpy(float))
    for frame in (feats, feats.repartition(5)):
        w, b = ml.train_churn_model(frame).weights
        assert np.abs(np.array([*w, b]) - want).max() < 1e-9


# ---- boosting
def plain_boost(x, y, keys, cuts, rounds, seed, depth=4, step=0.08, lam=1.0, least=1.0):
    """The same trees by direct search over every node's rows, in floating point."""
    margin, trees = np.zeros(len(y)), []
    for r in range(rounds):
        used = sorted(random.Random(f"{seed}:{r}").sample(range(6), 5))
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        sample = boosting.sampled(keys, seed, r, 0.9)
        tree = {}

        def split(rows, node, level):
            gs, hs = g[rows].sum(), h[rows].sum()
            best = None
            for f in used if level < depth else ():
                for cut in cuts[f]:
                    left = rows[x[rows, f] < cut]
                    right = rows[x[rows, f] >= cut]
                    if h[left].sum() < least or h[right].sum() < least:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + lam) for s in (left, right)) - gs ** 2 / (hs + lam)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, cut, left, right)
            if best is None:
                tree[node] = ("leaf", -step * gs / (hs + lam))
                return
            tree[node] = (best[1], best[2])
            split(best[3], 2 * node + 1, level + 1)
            split(best[4], 2 * node + 2, level + 1)

        split(np.flatnonzero(sample), 0, 0)
        trees.append(tree)
        for i in range(len(y)):
            node = 0
            while tree[node][0] != "leaf":
                node = 2 * node + 1 + (x[i, tree[node][0]] >= tree[node][1])
            margin[i] += tree[node][1]
    return trees, margin


def test_boosting_equals_direct_search_on_any_layout(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 2)
    x, y = some_rows()
    forests = []
    for parts, most in ((1, 64), (3, 64), (7, 2)):
        monkeypatch.setattr(boosting, "MOST", most)  # 2: histograms are added up by tasks before they come to the driver
        forests.append(boosting.boost(frame_of(spark, x, y, parts), NAMES, "y", "id", rounds=5, bins=20))
    assert forests[0] == forests[1] == forests[2]
    forest = forests[0]
    keys = np.array([r.k for r in spark.range(len(x)).select(F.xxhash64("id").alias("k")).collect()])
    cuts = boosting.quantile_cuts(frame_of(spark, x, y), NAMES, 20)
    trees, margin = plain_boost(x, y, keys, cuts, 5, 42)
    for tree, want in zip(forest.trees, trees):
        for node, (f, v) in want.items():
            if f == "leaf":
                assert tree.feature[node] == -1 and tree.value[node] == pytest.approx(v, abs=1e-5)
            else:
                assert (tree.feature[node], tree.cut[node]) == (f, v)
    assert np.abs(forest.margin(x) - margin).max() < 1e-5
    assert sum(forest.importances()) == pytest.approx(1) and boosting.Forest.of_record(forest.record()) == forest


def test_boosting_deals_the_rows_of_one_file_to_all_cores(spark, monkeypatch):
    held = []
    monkeypatch.setattr(boosting, "written", lambda df: held.append(written(df)) or held[-1])
    monkeypatch.setattr(boosting, "LIGHT", 50, raising=False)
    boosting.boost(frame_of(spark, *some_rows()), NAMES, "y", "id", rounds=2, bins=20)
    assert held and all(f.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1 for f in held)


def test_boosting_of_binned_blocks_equals_the_trees_on_values(spark, monkeypatch):
    x, y = some_rows()
    x[::9, 3], x[5::50, 1], x[7::50, 1] = np.nan, np.inf, -np.inf
    rows, forests, held = frame_of(spark, x, y), [], set(spark.sparkContext._jsc.getPersistentRDDs())
    for block, light, heavy, most, bins in ((65_536, 8_192, 1 << 20, 64, 20), (17, 40, 100, 2, 20), (64, 50, 200, 64, 200)):
        for name, value in (("ROWS", block), ("LIGHT", light), ("HEAVY", heavy), ("MOST", most), ("BLOCK", 3)):
            monkeypatch.setattr(boosting, name, value)
        forests.append(boosting.boost(rows, NAMES, "y", "id", rounds=5, bins=bins))
        cuts = boosting.quantile_cuts(rows, NAMES, bins)
        codes = np.array([np.where(np.isnan(v), -1, np.searchsorted(c, v, side="right")) for v, c in zip(x.T, cuts)])
        assert all(np.isnan(c).sum() <= 1 and not np.isnan(c[:-1]).any() for c in cuts)
        for tree in forests[-1].trees:  # a row takes the same way by its bins as by its values
            assert (boosting._place(boosting._coded(tree, cuts), codes, 4) == boosting.leaf_of(tree, x)).all()
    assert forests[0] == forests[1] and len(forests[2].trees) == 5
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held  # nothing stays in the cache


def test_boosting_margins_stay_in_step_with_the_trees(spark):
    x, y = some_rows()
    rows = frame_of(spark, x, y)
    cuts, forest = boosting.quantile_cuts(rows, NAMES, 20), boosting.boost(rows, NAMES, "y", "id", rounds=4, bins=20)
    state = boosting._packed(rows, NAMES, cuts, "y", "id")
    for r, tree in enumerate([None, *forest.trees]):
        state = boosting._round(state, cuts, tree, r == 2, (42, r, 0.9))
    blocks = state.select("key", "label", "margin", "added", "g", "h").collect()
    key, label, *numbers = (np.concatenate([np.frombuffer(b[c], np.int64 if c == "key" else float) for b in blocks])
                            for c in ("key", "label", "margin", "added", "g", "h"))
    place = {r.k: r.id for r in rows.select("id", F.xxhash64("id").alias("k")).collect()}
    margin = forest.margin(x)[[place[k] for k in key]]
    p, keep = 1 / (1 + np.exp(-margin)), boosting.sampled(key, 42, 4, 0.9)
    assert len(key) == len(x) and np.abs(numbers[0] + numbers[1] - margin).max() < 1e-12
    for got, want in zip(numbers[2:], (p - label, p * (1 - p))):
        assert (got[~keep] == 0).all() and np.abs(got[keep] - want[keep] * 2.0 ** boosting.UNIT).max() <= 0.6


def test_sampling_share_and_seeds():
    keys = np.arange(100_000)
    marks = [boosting.sampled(keys, s, r, 0.9) for s, r in ((1, 0), (1, 1), (2, 0))]
    assert all(abs(m.mean() - 0.9) < 0.005 for m in marks) and not (marks[0] == marks[1]).all() and not (marks[0] == marks[2]).all()
    assert (boosting.sampled(keys[::-1], 1, 0, 0.9)[::-1] == marks[0]).all()


def test_quantile_cuts(spark):
    x, y = some_rows(1000)
    x[:, 5] = np.repeat([3.0, 8.0], 500)  # a third and more share a value
    for parts in (1, 5):
        cuts = boosting.quantile_cuts(frame_of(spark, x, y, parts), NAMES, 16)
        assert cuts[5].tolist() == [8.0] and cuts[4].tolist() == [1.0] and cuts[0].tolist() == [float(v) for v in range(1, 9)]
        values = np.sort(x[:, 3])
        first = [v for v, k in zip(values, np.arange(1000) * 16 // 1000)]  # all distinct: cut where a sixteenth begins
        want = [values[np.flatnonzero(np.arange(1000) * 16 // 1000 == k)[0]] for k in range(1, 16)]
        assert len(first) == 1000 and cuts[3].tolist() == want


def test_boosting_without_rows(spark):
    x, y = some_rows(10)
    forest = boosting.boost(frame_of(spark, x, y).where("false"), NAMES, "y", "id", rounds=3)
    assert forest.margin(x).tolist() == [0.0] * 10 and forest.importances() == [0.0] * 6


# ---- Shapley values
def worth(tree, x, inside, node=0):
    """Expected leaf value when only the features ``inside`` are known: the others follow both branches by cover."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = 2 * node + 1, 2 * node + 2
    if f in inside:
        return worth(tree, x, inside, right if x[f] >= tree.cut[node] else left)
    return sum(tree.cover[c] / tree.cover[node] * worth(tree, x, inside, c) for c in (left, right))


def test_tree_explanations_equal_all_subsets(spark):
    x, y = some_rows()
    forest = boosting.boost(frame_of(spark, x, y), NAMES, "y", "id", rounds=6)
    explainer = boosting.Explainer(forest)
    got = explainer.values(x[:25])
    assert np.abs(got.sum(1) + explainer.base - forest.margin(x[:25])).max() < 1e-12
    assert explainer.base == pytest.approx(sum(worth(t, x[0], ()) for t in forest.trees))
    for row, values in zip(x[:25], got):
        for f in range(6):
            others = [k for k in range(6) if k != f]
            want = sum(math.factorial(len(s)) * math.factorial(5 - len(s)) / math.factorial(6)
                       * sum(worth(t, row, {*s, f}) - worth(t, row, set(s)) for t in forest.trees)
                       for size in range(6) for s in itertools.combinations(others, size))
            assert values[f] == pytest.approx(want, abs=1e-12)


def test_churn_trees_explain_save_and_permute(spark, scratch):
    feats = ml.prepare_ml_features(tables(spark, SF_SMALL)["user_metrics"])
    model = ml.train_churn_model(feats, "gbt", rounds=4)
    shap = ml.shap_values(model, feats)
    total = shap.groupBy("user_id").agg((F.sum("shap_value") + F.first("base_value")).alias("m"))
    worst = total.join(model.transform(feats).select("user_id", "margin"), "user_id").agg(F.max(F.abs(F.col("m") - F.col("margin")))).first()[0]
    assert shap.count() == 6 * feats.count() and worst < 1e-12
    model.save(f"{scratch}/trees", spark)
    assert ml.load_model(spark, f"{scratch}/trees").forest == model.forest
    top = ml.explain_top(ml.score(model, feats), shap, 5)
    assert top.count() == 30


@pytest.mark.parametrize("backend", ["logreg", "gbt"])
def test_permutation_equals_plain(spark, backend):
    import hashlib

    feats = ml.prepare_ml_features(tables(spark, SF_SMALL)["user_metrics"])
    model = ml.train_churn_model(feats, backend, rounds=3)
    pdf = feats.toPandas()
    pdf["h"] = [hashlib.md5(f"42:{u}".encode()).hexdigest() for u in pdf["user_id"]]
    pdf = pdf.sort_values(["h", "user_id"]).reset_index(drop=True)
    x, y, n = pdf[ml.FEATURES].to_numpy(float), pdf["churn_flag"].to_numpy(), len(pdf)
    if backend == "gbt":
        margin = model.forest.margin
    else:
        mean, sd = np.array([model.stats[c] for c in ml.FEATURES]).T
        margin = lambda v: (v - mean) / sd @ np.array(model.coefficients) + model.intercept
    base, want = ((margin(x) > 0) == y).mean(), {}
    for f, name in enumerate(ml.FEATURES):
        acc = []
        for r in range(4):
            shift = 1 + int(hashlib.md5(f"42:{r}".encode()).hexdigest()[:12], 16) % (n - 1)
            v = x.copy()
            v[:, f] = x[(np.arange(n) + shift) % n, f]
            acc.append(((margin(v) > 0) == y).mean())
        want[name] = base - np.mean(acc)
    got = {r.feature: r.permutation_importance for r in ml.permutation_importance(model, feats.repartition(5), 4).collect()}
    assert got == pytest.approx(want, abs=1e-12)


# ---- prefix sums
def test_prefix_sums_of_any_layout(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(10 ** 9), rng.choice([None, 0, 1, 5, 2 ** 40])) for _ in range(3000)]
    rows = list({k: (k, v) for k, v in rows}.values())
    want, done = {}, 0
    for k, v in sorted(rows):
        want[k] = done
        done += v or 0
    for parts, shuffles in ((1, 1), (4, 3), (9, 16)):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffles))
        try:
            frame = spark.createDataFrame(rows, "k long, v long").repartition(parts)
            assert {r.k: r.before for r in prefix_sums(frame, ["k"], {"before": "v"}).collect()} == want
            assert sorted((r.k, r.at) for r in row_numbers(frame, ["k"], "at").collect()) == [(k, i) for i, k in enumerate(sorted(want))]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    empty = prefix_sums(spark.createDataFrame([], "k long, v long"), ["k"], {"before": "v"})
    assert empty.columns == ["k", "v", "before"] and empty.count() == 0


def test_prefix_partitions_follow_the_rows(spark):
    """Many small shuffle partitions merge for few rows and stay many for many."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for name in sizes:
        spark.conf.set(name, "64k")
    try:
        frames = [spark.range(n).select(F.xxhash64("id").alias("k"), "id") for n in (100, 200_000)]
        few, many = (prefix_sums(f, ["k"], {"before": "id"}).rdd.getNumPartitions() for f in frames)
        assert few == 1 and many > 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        for name in sizes:
            spark.conf.unset(name)
