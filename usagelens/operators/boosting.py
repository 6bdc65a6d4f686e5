"""Second-order gradient boosting on histograms, and exact Shapley values of its trees.

Features are cut at exact quantiles; rows are kept as bins, in blocks, with
their margins and each round's gradients. Every tree level is one pass: each
task adds up (gradient, hessian) per node, feature and bin for its rows, the
tasks' histograms are added up, and the driver picks each node's split from at
most ``nodes x features x bins`` cells. Gradients are whole multiples of 2^-24, so
sums do not depend on the order of addition and trees not on the layout.
Rows and features are sampled by seeded hashes.
"""
from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.prefix import prefix_sums
from usagelens.session import ship, written

#: Gradients and hessians are rounded to multiples of 2^-UNIT; 64-bit sums hold 10^11 rows.
UNIT = 24
#: Histograms that come to the driver; more are added up in so many tasks before.
MOST = 64
#: Rounds after which the state is written; between, it is held in Spark's cache.
BLOCK = 16
#: Rows of a block at most, and of a task at least and at most.
ROWS, LIGHT, HEAVY = 65_536, 8_192, 1_048_576
#: Columns of the state, a row per block: gradients and hessians are those of the round.
STATE = ["key", "label", "codes", "margin", "added", "g", "h"]


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i+1 and 2i+2). ``feature`` -1: a leaf. A row goes right where its value is >= ``cut``."""
    feature: list[int]
    cut: list[float]
    value: list[float]
    cover: list[float]
    gain: list[float]


@dataclass
class Forest:
    """Trees whose leaf values add up to the margin, from ``base`` on."""
    features: list[str]
    trees: list[Tree] = field(default_factory=list)
    base: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Margins of the rows of ``x`` (one column per feature)."""
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += np.array(tree.value)[leaf_of(tree, x)]
        return out

    def importances(self) -> list[float]:
        """Mean gain of each feature's splits, as shares of their sum."""
        gains: list[list[float]] = [[] for _ in self.features]
        for tree in self.trees:
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    gains[f].append(g)
        mean = [sum(g) / len(g) if g else 0.0 for g in gains]
        return [m / sum(mean) if sum(mean) else 0.0 for m in mean]

    def record(self) -> dict:
        return asdict(self)

    @staticmethod
    def of_record(record: dict) -> "Forest":
        return Forest(record["features"], [Tree(**t) for t in record["trees"]], record["base"])


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Heap place of the leaf that each row reaches."""
    feature, cut = np.array(tree.feature), np.array(tree.cut)
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(int(math.log2(len(feature) + 1)) - 1):
        f = feature[node]
        right = x[rows, np.maximum(f, 0)] >= cut[node]
        node = np.where(f < 0, node, 2 * node + 1 + right)
    return node


def sampled(keys: np.ndarray, seed: int, round_: int, share: float) -> np.ndarray:
    """Marks the rows of one round's sample: a seeded hash of each row's key against ``share``."""
    with np.errstate(over="ignore"):
        h = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 1_000_003 + round_ + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53 < share


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per feature the values at which a new bin begins: all distinct values but the first, or exact quantiles.

    Distinct values are counted first, so no value that many rows share weighs on a task.
    """
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v"))
                                           for i, c in enumerate(features)])).alias("p")).select("p.f", "p.v")
    counts = long.groupBy("f", "v").agg(F.count("*").alias("n"), F.lit(1).cast("long").alias("one"))
    placed = prefix_sums(counts, ["f", "v"], {"before": "n", "rank": "one"})
    firsts = placed.groupBy("f").agg(F.min("before").alias("b0"), F.min("rank").alias("r0"), F.count("*").alias("values"), F.sum("n").alias("n0"))
    near = placed.join(firsts, "f")  # a row per feature on the right
    bin_ = F.when(F.col("values") <= bins, F.col("rank") - F.col("r0")).otherwise(
        F.floor((F.col("before") - F.col("b0")) * bins / F.col("n0")))
    found = near.groupBy("f", bin_.alias("bin")).agg(F.min("v").alias("v")).collect()
    return [np.sort(np.array([r["v"] for r in found if r["f"] == i], float))[1:] for i in range(len(features))]  # NaN last


def _block(parts: Sequence[np.ndarray]) -> pa.RecordBatch:
    """One row of state: the arrays of a block of rows as bytes."""
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=STATE[:len(parts)])


def _blocks(batches: Iterator[pa.RecordBatch], names: Sequence[str], kinds: Sequence) -> Iterator[list[np.ndarray]]:
    """The arrays ``names`` of every block."""
    for b in batches:
        for i in range(b.num_rows):
            yield [np.frombuffer(b.column(n)[i].as_buffer(), k) for n, k in zip(names, kinds)]


def _packed(rows: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], label: str, key: str) -> DataFrame:
    """The rows in blocks (key hash, label, bin per feature, margin 0), dealt evenly to the cores: tasks of at least ``LIGHT`` and about ``HEAVY`` rows at most.

    A value's bin is the number of cuts up to it: it is >= cut i where its bin is > i. Null and NaN get -1, as they are >= no cut.
    """
    count, most, kind = rows.count(), ROWS, _kind(cuts)
    tasks = min(max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // HEAVY)), max(1, -(-count // LIGHT)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, most):
                part = b.slice(at, most)
                values = [part.column(f"f{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(cuts))]
                codes = [np.where(np.isnan(v), -1, np.searchsorted(c, v, side="right")).astype(kind) for v, c in zip(values, cuts)]
                none = np.zeros(part.num_rows)
                yield _block([part.column("key").to_numpy(), part.column("label").to_numpy(zero_copy_only=False).astype(float), np.stack(codes), none, none])

    given = rows.select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("label"),
                        *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    return given.repartition(tasks).mapInArrow(run, ", ".join(f"{n} binary" for n in STATE[:5]))


def _kind(cuts: Sequence[np.ndarray]) -> np.dtype:
    """The smallest whole numbers that hold every bin and -1."""
    return np.min_scalar_type(-1 - max(len(c) for c in cuts))


def _coded(tree: Tree, cuts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per node its feature and the place of its cut among the feature's cuts."""
    return np.array(tree.feature), np.array([np.searchsorted(cuts[f], c) if f >= 0 else 0 for f, c in zip(tree.feature, tree.cut)])


def _place(coded: tuple[np.ndarray, np.ndarray], codes: np.ndarray, levels: int) -> np.ndarray:
    """Heap place that each row (a column of bins) reaches after so many levels; see :func:`leaf_of`."""
    feature, at = coded
    n, flat = codes.shape[1], codes.reshape(-1)
    node, rows, begin = np.zeros(n, np.int64), np.arange(n), np.maximum(feature, 0) * n
    for _ in range(levels):
        right = flat[begin[node] + rows] > at[node]
        node = np.where(feature[node] < 0, node, 2 * node + 1 + right)
    return node


def _round(state: DataFrame, cuts: Sequence[np.ndarray], tree: Tree | None, settle: bool, sample) -> DataFrame:
    """The state with the last ``tree`` added, and the gradients and hessians of the next round, in whole units (0: not in its sample).

    Trees since the last ``settle`` are added up apart from the margin before them.
    """
    kind, width = _kind(cuts), len(cuts)
    coded = tree and _coded(tree, cuts)
    value, depth = (np.array(tree.value), int(math.log2(len(tree.value) + 1)) - 1) if tree else (None, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, y, codes, margin, added in _blocks(batches, STATE[:5], (np.int64, float, kind, float, float)):
            if coded:
                added = added + value[_place(coded, codes.reshape(width, -1), depth)]
            if settle:
                margin, added = margin + added, np.zeros(len(key))
            p = 1 / (1 + np.exp(-(margin + added)))
            keep = sampled(key, *sample)
            yield _block([key, y, codes, margin, added, *[np.where(keep, np.rint(v * 2.0 ** UNIT), 0.0) for v in (p - y, p * (1 - p))]])

    return state.mapInArrow(run, ", ".join(f"{n} binary" for n in STATE))


def _level(state: DataFrame, cuts: Sequence[np.ndarray], tree: Tree, depth: int, used: Sequence[int],
           many: bool) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """{(node, feature): (gradients, hessians) per bin} of one tree level, in whole units.

    ``many``: there are more tasks than histograms may come to the driver.
    """
    first, width, kind = 2 ** depth - 1, max(len(c) for c in cuts) + 1, _kind(cuts)
    shape, coded, last = (2, 2 ** depth, len(used), width), _coded(tree, cuts), [len(c) for c in cuts]

    def packed(sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape, np.int64)
        for codes, *of in _blocks(batches, ("codes", "g", "h"), (kind, float, float)):
            codes = codes.reshape(len(last), -1)
            node = _place(coded, codes, depth) - first
            live = node >= 0  # rows in leaves above this level are done
            if not live.all():
                node, codes, of = node[live], codes[:, live], [v[live] for v in of]
            for k, f in enumerate(used):
                cell = node * width + np.where(codes[f] < 0, last[f], codes[f])
                for s, v in zip(sums, of):  # whole numbers below 2^53: exact
                    s[:, k] += np.bincount(cell, v, shape[1] * width).astype(np.int64).reshape(shape[1], width)
        yield packed(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape, np.int64)
        for b in batches:
            for blob in b.column(0).to_pylist():
                sums += np.frombuffer(blob, np.int64).reshape(shape)
        yield packed(sums)

    partial = state.select("codes", "g", "h").mapInArrow(run, "sums binary")
    if many:
        partial = partial.repartition(MOST).mapInArrow(add, "sums binary")
    sums = np.zeros(shape, np.int64)
    for row in partial.collect():
        sums += np.frombuffer(row["sums"], np.int64).reshape(shape)
    return {(first + node, f): (sums[0, node, k], sums[1, node, k]) for node in range(shape[1]) for k, f in enumerate(used)
            if sums[1, node, k].any()}


def best_split(cells: dict[int, tuple[np.ndarray, np.ndarray]], cuts, lam: float, least: float):
    """(gain, feature, cut, left sums, right sums) of a node, or None; ties go to the first feature and the lowest cut."""
    best, unit = None, 2.0 ** -UNIT
    for f in sorted(cells):
        g, h = (np.cumsum(c) for c in cells[f])
        parent = (g[-1] * unit) ** 2 / (h[-1] * unit + lam)
        sides = [(c[:len(cuts[f])], c[-1] - c[:len(cuts[f])]) for c in (g, h)]
        (lg, rg), (lh, rh) = ([s.astype(float) * unit for s in side] for side in sides)
        gain = np.where((lh >= least) & (rh >= least), lg * lg / (lh + lam) + rg * rg / (rh + lam) - parent, -1.0)
        at = int(gain.argmax()) if len(gain) else 0
        if len(gain) and gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
            best = (float(gain[at]), f, float(cuts[f][at]), *((sides[0][i][at], sides[1][i][at]) for i in (0, 1)))
    return best


def grow(levels, cuts, depth: int, step: float, lam: float, least: float, used: Sequence[int]) -> Tree:
    """One tree; ``levels(tree, depth)`` gives the histograms of the nodes at a depth."""
    n, unit = 2 ** (depth + 1) - 1, 2.0 ** -UNIT
    tree = Tree([-1] * n, [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n)
    open_ = {0}
    for d in range(depth):
        cells = levels(tree, d)
        children = set()
        for node in sorted(open_):
            of = {f: cells[node, f] for f in used if (node, f) in cells}
            if not of:
                continue
            if not node:
                _settle(tree, 0, tuple(c.sum() for c in next(iter(of.values()))), step, lam, unit)
            split = best_split(of, cuts, lam, least)
            if split:
                tree.gain[node], tree.feature[node], tree.cut[node] = split[0], split[1], split[2]
                tree.value[node] = 0.0
                for child, sums in zip((2 * node + 1, 2 * node + 2), split[3:]):
                    _settle(tree, child, sums, step, lam, unit)
                    children.add(child)
        open_ = children
        if not open_:
            break
    return tree


def _settle(tree: Tree, node: int, sums: tuple[int, int], step: float, lam: float, unit: float) -> None:
    g, h = sums[0] * unit, sums[1] * unit
    tree.value[node], tree.cover[node] = float(-step * g / (h + lam)), float(h)


def boost(rows: DataFrame, features: Sequence[str], label: str, key: str, rounds: int = 160, depth: int = 4, step: float = 0.08,
          row_share: float = 0.9, feature_share: float = 0.9, lam: float = 1.0, least: float = 1.0, bins: int = 256,
          seed: int = 42) -> Forest:
    """Fit ``rounds`` trees to the log-loss of ``label`` (0/1) on all ``rows`` (a table).

    Each tree sees the rows and features that a hash of ``seed`` and its number
    picks (rows by ``key``). A split needs a gain, and a hessian of ``least`` on
    either side; leaves are regularised by ``lam``. Trees depend on rows,
    parameters and seed, not on the layout. Without rows the trees are empty.

    Eager: rows are packed once into blocks of bins, dealt evenly to the cores.
    Every round adds one tree to the margins and holds the round's gradients
    (Spark's cache, which spills to disk); every tree level is one pass over
    bins and gradients. Every ``BLOCK`` rounds the state is written, so a lost
    task repeats a bounded number of rounds.
    """
    ship(rows.sparkSession)
    features = list(features)
    cuts = quantile_cuts(rows, features, bins)
    forest, many = Forest(features), False
    state, held = _packed(rows, features, cuts, label, key), []
    try:
        for r in range(rounds):
            used = sorted(random.Random(f"{seed}:{r}").sample(range(len(features)), max(1, int(feature_share * len(features)))))
            settle = r % BLOCK == 0
            state = _round(state, cuts, forest.trees[-1] if r else None, settle, (seed, r, row_share))
            if settle:
                state = written(state)
                many = state.rdd.getNumPartitions() > MOST
            held.append(state.persist())
            forest.trees.append(grow(lambda t, d: _level(state, cuts, t, d, used, many), cuts, depth, step, lam, least, used))
            while len(held) > 1:
                held.pop(0).unpersist()
    finally:
        for one in held:
            one.unpersist()
    return forest


# ---- Shapley values
def _weights(size: int) -> list[float]:
    """Shapley's weight of a coalition of each size among ``size`` players, without the player itself."""
    return [math.factorial(s) * math.factorial(size - s - 1) / math.factorial(size) for s in range(size)]


def _leaf_games(tree: Tree, node: int = 0, path: tuple = ()) -> Iterator[tuple[float, dict[int, tuple[list, float]]]]:
    """(value, {feature: (conditions (node, right), share of cover)}) of every leaf.

    A coalition's worth at a leaf is the leaf's value, times, for each feature
    of the path, whether the row meets its conditions (a feature inside the
    coalition) or the share of cover that does (outside).
    """
    if tree.feature[node] < 0:
        game: dict[int, tuple[list, float]] = {}
        for at, right, share in path:
            conditions, z = game.get(tree.feature[at], ([], 1.0))
            game[tree.feature[at]] = ([*conditions, (at, right)], z * share)
        yield tree.value[node], game
        return
    for right in (0, 1):
        child = 2 * node + 1 + right
        yield from _leaf_games(tree, child, (*path, (node, right, tree.cover[child] / tree.cover[node])))


class Explainer:
    """Shapley values of a forest's margins; a feature outside a coalition follows both branches by cover.

    A leaf's game is a product over the features of its path, at most one per
    level, so its values for all patterns of met conditions form a small table.
    """

    def __init__(self, forest: Forest):
        self.forest, self.base, self.games = forest, forest.base, []
        for tree in forest.trees:
            of_tree = []
            for value, game in _leaf_games(tree):
                self.base += value * math.prod(share for _, share in game.values())
                if game:
                    of_tree.append(([(f, game[f][0]) for f in game], _tables(value, [game[f][1] for f in game])))
            self.games.append((tree, of_tree))

    def values(self, x: np.ndarray) -> np.ndarray:
        """One value per row and feature; a row's values and ``base`` add up to its margin."""
        out = np.zeros((len(x), len(self.forest.features)))
        for tree, of_tree in self.games:
            right = [x[:, f] >= c if f >= 0 else None for f, c in zip(tree.feature, tree.cut)]
            for players, tables in of_tree:
                pattern = np.zeros(len(x), np.int64)
                for k, (_, conditions) in enumerate(players):
                    met = np.ones(len(x), bool)
                    for at, way in conditions:
                        met &= right[at] if way else ~right[at]
                    pattern |= met.astype(np.int64) << k
                for (f, _), table in zip(players, tables):
                    out[:, f] += table[pattern]
        return out


def _tables(value: float, shares: list[float]) -> list[np.ndarray]:
    """Per player, its Shapley value in a leaf's game for every pattern of met conditions (bit j: those of player j)."""
    size, weights, out = len(shares), _weights(len(shares)), []
    for k in range(size):
        others, table = [j for j in range(size) if j != k], np.zeros(2 ** size)
        for bits in range(2 ** size):
            worth = 0.0
            for inside in range(2 ** len(others)):
                part = weights[inside.bit_count()]
                for m, j in enumerate(others):
                    part *= (bits >> j & 1) if inside >> m & 1 else shares[j]
                worth += part
            table[bits] = value * ((bits >> k & 1) - shares[k]) * worth
        out.append(table)
    return out
