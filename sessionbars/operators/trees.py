"""Boosted regression trees of few rows, grown within one task.

Spark ML's boosting runs some jobs for every level of every tree, whatever the
rows; for a fold of some thousand rows that is nearly all of its time.  Here one
task grows the same trees in numpy: the library's thresholds, its bags (one
generator per round, seeded by round), its feature subsets (one draw per node, in
the order in which the library takes nodes off its stack), its gains in the same
order of additions, its ties and its leaves.  ``fits_in_a_task`` says where that
holds; all else is the library's.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import Broadcast
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to here the library takes all rows for its thresholds, beyond it a sample.
MOST_ROWS = 10_000
MAX_BINS = 32
_MEMORY = 256 << 20
_EPSILON = 2.0**-52
_NONE = -np.finfo(np.float64).max


def arities(df: DataFrame, col: str = "features") -> list[int] | None:
    """For each feature 0 (a number) or 2 (yes or no), as the column's attributes
    say; None where they don't say or there are others."""
    about = df.schema[col].metadata.get("ml_attr", {})
    attrs, n = about.get("attrs", {}), about.get("num_attrs")
    if n is None or set(attrs) - {"numeric", "binary"} or sum(map(len, attrs.values())) != n:
        return None
    out = [0] * n
    for a in attrs.get("binary", []):
        out[a["idx"]] = 2
    return out


def features_of_a_node(strategy: str, n: int) -> int:
    """The library's reading of a share of the features, written with a point."""
    return math.ceil(float(strategy) * n)


#: What an estimator may not say otherwise, as ``boost`` knows nothing else.
_PLAIN = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "maxBins": MAX_BINS, "maxMemoryInMB": _MEMORY >> 20,
          "lossType": "squared", "impurity": "variance", "weightCol": None, "validationIndicatorCol": None}
_READ = ("maxDepth", "maxIter", "stepSize", "subsamplingRate", "featureSubsetStrategy", "seed")


def fits_in_a_task(est: GBTRegressor, rows: int, kinds: list[int] | None) -> dict | None:
    """The settings of ``boost`` if it grows the estimator's trees on so many rows in one partition, else None."""
    said = {p.name: v for p, v in est.extractParamMap().items()}
    if kinds is None or not 2 <= rows <= MOST_ROWS or any(said.get(k, v) != v for k, v in _PLAIN.items()):
        return None
    p = {k: said[k] for k in _READ}
    ok = "." in p["featureSubsetStrategy"] and 0 < p["subsamplingRate"] < 1 and 2 ** p["maxDepth"] * len(kinds) * MAX_BINS * 32 <= _MEMORY
    return p if ok else None


def all_finite(df: DataFrame, label: str, col: str = "features") -> bool:
    """Whether no label and no feature is null, NaN or infinite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    return df.filter(odd(F.col(label).cast("double")) | F.exists(vector_to_array(col), odd)).isEmpty()


def matrix(df: DataFrame, label: str, features: int) -> tuple[np.ndarray, np.ndarray]:
    """The few rows of a fold's side, as they lie."""
    rows = df.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y")).collect()
    return np.array([r["x"] for r in rows], np.float64).reshape(len(rows), features), np.array([r["y"] for r in rows], np.float64)


def boosting_errors(spark: SparkSession, jobs: dict, folds: Broadcast) -> dict:
    """The errors of ``boost`` for each job, given as (fold, settings): a task each, in one Spark job.
    ``folds`` has for each fold (x, y), (other x, other y) and the kinds of its features."""

    def run(job):
        name, (fold, params) = job
        train, test, kinds = folds.value[fold]
        return name, boost(*train, *test, kinds, params)

    return dict(spark.sparkContext.parallelize(list(jobs.items()), len(jobs)).map(run).collect()) if jobs else {}


# The generators: Java's linear congruential one and Spark's xorshift, whose seeds are hashed.
# All work on arrays of states at once.


def _murmur(words: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    """MurmurHash3 of 8 bytes given as two 32-bit words."""
    u = np.uint32
    for k in words:
        k = k * u(0xCC9E2D51)
        k = ((k << u(15)) | (k >> u(17))) * u(0x1B873593)
        h = h ^ k
        h = ((h << u(13)) | (h >> u(19))) * u(5) + u(0xE6546B64)
    h = h ^ u(8)
    h = (h ^ (h >> u(16))) * u(0x85EBCA6B)
    h = (h ^ (h >> u(13))) * u(0xC2B2AE35)
    return h ^ (h >> u(16))


def _hashed(seeds: np.ndarray) -> np.ndarray:
    """States of Spark's xorshift generators for seeds (int64)."""
    big = seeds.astype(">i8").reshape(-1, 1).view(np.uint8).reshape(-1, 8)
    words = [np.ascontiguousarray(big[:, a : a + 4]).view("<u4").reshape(-1) for a in (0, 4)]
    low = _murmur(words, np.full(len(seeds), 0x3C074A61, np.uint32))
    high = _murmur(words, low)
    return (high.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)


def _next(state: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    s = state ^ (state << np.uint64(21))
    s ^= s >> np.uint64(35)
    s ^= s << np.uint64(4)
    return s, s & np.uint64((1 << bits) - 1)


def _double(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    state, a = _next(state, 26)
    state, b = _next(state, 27)
    return state, ((a << np.uint64(27)) + b).astype(np.float64) * 2.0**-53


def bags(seeds: np.ndarray, rows: int, rate: float) -> np.ndarray:
    """seeds x rows: which rows of a single partition the bag of each seed holds."""
    state, out = _hashed(seeds + 1), np.empty((len(seeds), rows), bool)
    for i in range(rows):
        state, x = _double(state)
        out[:, i] = x < rate
    return out


class Subsets:
    """For each seed the feature subsets of its nodes, in the order of asking."""

    def __init__(self, seeds: np.ndarray, features: int, size: int):
        self.features, self.size = features, size
        self.state = (seeds.astype(np.uint64) ^ np.uint64(0x5DEECE66D)) & np.uint64((1 << 48) - 1)
        self.drawn = np.empty((len(seeds), 0, size), np.int64)

    def _int(self) -> np.ndarray:
        self.state = (self.state * np.uint64(0x5DEECE66D) + np.uint64(0xB)) & np.uint64((1 << 48) - 1)
        return (self.state >> np.uint64(16)).astype(np.uint32).view(np.int32).astype(np.int64)

    def _more(self, nodes: int) -> np.ndarray:
        longs = np.stack([(self._int() << 32) + self._int() for _ in range(nodes)], 1).reshape(-1)
        out = np.tile(np.arange(self.size), (len(longs), 1))
        state = _hashed(longs)
        for item in range(self.size, self.features):
            state, x = _double(state)
            at = (x * (item + 1)).astype(np.int64)
            hit = np.flatnonzero(at < self.size)
            out[hit, at[hit]] = item
        return out.reshape(-1, nodes, self.size)

    def take(self, seed: int, lo: int, hi: int) -> np.ndarray:
        while self.drawn.shape[1] < hi:
            self.drawn = np.concatenate([self.drawn, self._more(max(32, self.drawn.shape[1]))], 1)
        return self.drawn[seed, lo:hi]


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """The library's candidate thresholds of one feature, from all rows."""
    v, count = np.unique(values + 0.0, return_counts=True)
    if len(v) <= bins:
        return (v[:-1] + v[1:]) / 2.0
    stride, out = len(values) / bins, []
    current, target = float(count[0]), len(values) / bins
    for i in range(1, len(v)):
        before, current = current, current + float(count[i])
        if abs(before - target) < abs(current - target):
            out.append((v[i - 1] + v[i]) / 2.0)
            target += stride
    return np.array(out)


class Bins:
    """Thresholds found on the training rows, and rows as bin numbers."""

    def __init__(self, x: np.ndarray, kinds: list[int]):
        bins = min(MAX_BINS, len(x))
        self.yes_no = np.array(kinds) == 2
        self.splits = [np.zeros(0) if k else thresholds(x[:, j], bins) for j, k in enumerate(kinds)]
        self.count = np.array([1 if k else len(s) for k, s in zip(kinds, self.splits)])

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.stack([x[:, j].astype(np.int64) if k else np.searchsorted(s, x[:, j]) for j, (k, s) in enumerate(zip(self.yes_no, self.splits))], 1)


def _variance(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.where(n == 0, 0.0, (q - s * s / np.where(n == 0, 1.0, n)) / np.where(n == 0, 1.0, n))


def grow(binned: np.ndarray, bins: Bins, y: np.ndarray, bag: np.ndarray, depth: int, subsets, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One tree: its predictions for the training rows and for ``others`` (bin numbers both)."""
    n_features, most = binned.shape[1], int(max(bins.count.max(), 1)) + 1
    usable = np.arange(most - 1) < bins.count[:, None]
    both = np.concatenate([binned, others])
    value = np.zeros(len(both))
    node = np.zeros(len(both), np.int64)  # place in this level's group, -1 where settled
    stats = None  # per node of the level: count, sum, sum of squares, as its parent's split left them
    nodes, asked = 1, 0
    for level in range(depth + 1):
        subset = subsets(asked, asked + nodes)
        asked += nodes
        at = np.flatnonzero(bag & (node[: len(y)] >= 0))
        cell = ((node[at] * n_features)[:, None] + np.arange(n_features)) * most + binned[at]
        size, cell = nodes * n_features * most, cell.reshape(-1)
        label = np.repeat(y[at], n_features)
        shape = (nodes, n_features, most)
        agg = np.stack([np.bincount(cell, minlength=size), np.bincount(cell, label, size), np.bincount(cell, label * label, size)]).astype(np.float64).reshape(3, *shape)
        left = np.cumsum(agg, axis=3)
        total = left[..., -1:]
        left = left[..., :-1]
        yes = np.flatnonzero(bins.yes_no)
        if len(yes):
            a, b = agg[:, :, yes, 0], agg[:, :, yes, 1]
            mean = [np.where(c[0] > 0, c[1] / np.where(c[0] > 0, c[0], 1.0), np.inf) for c in (a, b)]
            swapped = mean[1] < mean[0]
            left[:, :, yes, 0] = np.where(swapped, b, a)
        right = total - left
        if stats is None:
            first = next((f for f in subset[0].tolist() if bins.count[f]), None)
            stats = (left[:, :, first, 0] + right[:, :, first, 0]) if first is not None else total[:, :, 0, 0]
        impurity = _variance(*stats)
        here = left[0] + right[0]
        here = np.where(here == 0, 1.0, here)
        low, high = _variance(*left), _variance(*right)
        gain = impurity[:, None, None] - left[0] / here * low - right[0] / here * high
        gain = np.where((left[0] >= 1) & (right[0] >= 1) & usable & (gain >= 0), gain, _NONE)
        best_split = gain.argmax(2)
        best = np.take_along_axis(np.take_along_axis(gain, best_split[..., None], 2)[..., 0], subset, 1)
        pick = best.argmax(1)
        every = np.arange(nodes)
        feature = subset[every, pick]
        split = best_split[every, feature]
        leaf = best[every, pick] <= 0 if level < depth else np.ones(nodes, bool)
        mean = np.where(stats[0] == 0, 0.0, stats[1] / np.where(stats[0] == 0, 1.0, stats[0]))
        live = np.flatnonzero(node >= 0)
        where = node[live]
        settled = leaf[where]
        value[live[settled]] = mean[where[settled]]
        node[live[settled]] = -1
        live, where = live[~settled], where[~settled]
        if not len(live):
            break
        f = feature[where]
        own = both[live, f]
        goes_left = own <= split[where]
        if len(yes):
            turn = np.zeros((nodes, n_features), bool)
            turn[:, yes] = swapped
            goes_left = np.where(bins.yes_no[f], (own == 1) == turn[where, f], goes_left)
        # children in the library's order: each pushes its left, then its right one, and the last is taken first
        sides = []
        for part, imp in ((left, low), (right, high)):
            s = part[:, every, feature, split]
            v = imp[every, feature, split]
            sides.append((s, (level + 1 == depth) | (np.abs(v) < _EPSILON)))
        ends = np.stack([sides[0][1], sides[1][1]], 1)
        go = ~ends & ~leaf[:, None]
        order = [(i, side) for i in range(nodes) for side in (0, 1) if go[i, side]][::-1]
        place = np.full((nodes, 2), -1)
        for k, (i, side) in enumerate(order):
            place[i, side] = k
        side = np.where(goes_left, 0, 1)
        s = np.where(goes_left, sides[0][0][:, where], sides[1][0][:, where])
        done = ends[where, side]
        value[live[done]] = np.where(s[0] == 0, 0.0, s[1] / np.where(s[0] == 0, 1.0, s[0]))[done]
        node[live] = np.where(done, -1, place[where, side])
        if not order:
            break
        nodes = len(order)
        stats = np.stack([sides[side][0][:, i] for i, side in order], 1)
    return value[: len(y)], value[len(y) :]


def boost(x: np.ndarray, y: np.ndarray, other_x: np.ndarray, other_y: np.ndarray, kinds: list[int], params: dict) -> list[float]:
    """Mean absolute error on the other rows after each round of boosting on (x, y), all in one partition."""
    bins = Bins(x, kinds)
    binned, others = bins.of(x), bins.of(other_x)
    seeds = np.arange(params["maxIter"], dtype=np.int64) + params["seed"]
    bag = bags(seeds, len(y), params["subsamplingRate"])
    some = features_of_a_node(params["featureSubsetStrategy"], len(kinds))
    drawn = Subsets(seeds, len(kinds), some)
    if some == len(kinds):
        all_of = np.arange(some)
    pred, other, out = np.zeros(len(y)), np.zeros(len(other_y)), []
    for m in range(params["maxIter"]):
        subsets = (lambda lo, hi: np.tile(all_of, (hi - lo, 1))) if some == len(kinds) else (lambda lo, hi, m=m: drawn.take(m, lo, hi))
        weight = params["stepSize"] if m else 1.0
        a, b = grow(binned, bins, 2.0 * (y - pred) if m else y, bag[m], params["maxDepth"], subsets, others)
        pred, other = pred + weight * a, other + weight * b
        out.append(float(np.abs(other_y - other).mean()) if len(other_y) else math.nan)
    return out
