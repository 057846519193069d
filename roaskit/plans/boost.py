"""Gradient-boosted trees of ``GBTClassifier``, grown by one task from the binned rows of a frame.

Spark ML runs two stages per level of every tree, so a search of hundreds of trees waits for hundreds of thousands of
short jobs.  But a tree sees a row only through its bins (32 a feature at most) and its label: rows of equal bins are
one *unit* with a count per label.  The units are made in one distributed pass, and a task grows all trees of a fit from
them, with Spark ML's own split points, feature draws, losses, gains and stopping rules.  Fits run side by side.

A frame of one task keeps each row as a unit, in order, with Spark ML's own subsampling draws and sums in the same
order: its trees are Spark ML's, but for the last bit of an exponential, which may decide between equal splits in a long
fit.  In a larger frame a unit's drawn rows are binomial (the law of drawing each of its
rows by itself).  A frame of more than ``MOST_UNITS`` units is left to Spark ML, whose tasks share the rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaskit.session import importable_in_workers

#: Units that a task grows trees from; about 300 bytes each with 50 features.
MOST_UNITS = 1 << 20
#: Codes of a group of features whose sums are made at once.
GROUP_CODES = 1024
#: Values of a block of sums or draws held at once.
BLOCK = 1 << 18
UNIT = "place long, bins binary, pos long, neg long"
EPSILON = 2.0 ** -52  # of Spark's pure nodes


# --- Spark's random numbers ------------------------------------------------------------------

def _u32(x):
    return x & np.uint64(0xFFFFFFFF)


def _murmur(seed: np.ndarray, start) -> np.ndarray:
    """``scala.util.hashing.MurmurHash3.bytesHash`` of 64-bit numbers in big-endian order."""
    rot = lambda x, r: _u32((x << np.uint64(r)) | (x >> np.uint64(32 - r)))
    h = np.broadcast_to(np.asarray(start, np.uint64), seed.shape)
    for half in (seed >> np.uint64(32), _u32(seed)):
        k = half.astype(np.uint32).byteswap().astype(np.uint64)
        k = _u32(rot(_u32(k * np.uint64(0xCC9E2D51)), 15) * np.uint64(0x1B873593))
        h = _u32(rot(h ^ k, 13) * np.uint64(5) + np.uint64(0xE6546B64))
    h = h ^ np.uint64(8)
    h = _u32((h ^ (h >> np.uint64(16))) * np.uint64(0x85EBCA6B))
    h = _u32((h ^ (h >> np.uint64(13))) * np.uint64(0xC2B2AE35))
    return h ^ (h >> np.uint64(16))


def hashed_seeds(seeds) -> np.ndarray:
    """``XORShiftRandom.hashSeed``: the first states."""
    seeds = np.asarray(seeds, np.int64).view(np.uint64)
    low = _murmur(seeds, 0x3C074A61)
    return (_murmur(seeds, low) << np.uint64(32)) | low


def _shifted(s: np.ndarray) -> np.ndarray:
    s = s ^ (s << np.uint64(21))
    s = s ^ (s >> np.uint64(35))
    return s ^ (s << np.uint64(4))


def next_doubles(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(next states, ``nextDouble``) of many ``XORShiftRandom``."""
    one = _shifted(state)
    two = _shifted(one)
    high = (one & np.uint64((1 << 26) - 1)) << np.uint64(27)
    return two, (high + (two & np.uint64((1 << 27) - 1))).astype(np.float64) * 2.0 ** -53


_MULTIPLIER, _MASK = 0x5DEECE66D, (1 << 48) - 1


def next_longs(seeds: np.ndarray, n: int) -> np.ndarray:
    """(seeds, n): the first ``nextLong`` of ``java.util.Random`` of each seed."""
    state, out = (seeds.astype(np.uint64) ^ np.uint64(_MULTIPLIER)) & np.uint64(_MASK), np.empty((len(seeds), n), np.uint64)
    words = []
    for i in range(2 * n):
        state = (state * np.uint64(_MULTIPLIER) + np.uint64(0xB)) & np.uint64(_MASK)
        words.append(state >> np.uint64(16))
        if i % 2:
            high, low = words[-2:]
            out[:, i // 2] = (high << np.uint64(32)) + low - ((low >> np.uint64(31)) << np.uint64(32))
    return out.view(np.int64)


def feature_draws(seeds: np.ndarray, n: int, k: int) -> np.ndarray:
    """``SamplingUtils.reservoirSampleAndCount`` of ``range(n)`` for every seed: (seeds, k) features in the order drawn."""
    held = np.tile(np.arange(k), (len(seeds), 1))
    state = hashed_seeds(seeds)
    for item in range(k, n):
        state, u = next_doubles(state)
        at = (u * (item + 1)).astype(np.int64)
        row = np.flatnonzero(at < k)
        held[row, at[row]] = item
    return held


class NodeFeatures:
    """The features that each node of each tree may split by, in the order drawn; a node draws when its turn comes."""

    def __init__(self, seed: int, trees: int, features: int, k: int):
        self.seed, self.trees, self.features, self.k, self.nodes, self.first, self.held = seed, trees, features, k, 64, 0, ()

    def of(self, tree: int, start: int, count: int) -> np.ndarray:
        if self.k == self.features:
            return np.broadcast_to(np.arange(self.k), (count, self.k))
        if start + count > self.nodes or not self.first <= tree < self.first + len(self.held):
            while start + count > self.nodes:
                self.nodes *= 2
            many = max(1, min(self.trees - tree, BLOCK // (self.nodes * self.k)))
            longs = next_longs(np.arange(tree, tree + many) + self.seed, self.nodes)
            self.first, self.held = tree, feature_draws(longs.ravel(), self.features, self.k).reshape(many, self.nodes, self.k)
        return self.held[tree - self.first, start:start + count]


def row_draws(seed: int, trees: int, rows: int, rate: float) -> Iterator[np.ndarray]:
    """Per tree the rows drawn (0 or 1) of a frame of one partition, as ``BaggedPoint`` draws them."""
    step = max(1, min(trees, 8 * BLOCK // max(rows, 1)))
    for first in range(0, trees, step):
        state = hashed_seeds(np.arange(first, min(first + step, trees)) + seed + 1)
        drawn = np.empty((rows, len(state)), np.uint8)
        for i in range(rows):
            state, u = next_doubles(state)
            drawn[i] = u < rate
        yield from np.ascontiguousarray(drawn.T)


class Binomials:
    """How many of ``counts`` rows are drawn, each at ``rate``: an inverse table per count up to ``MOST``, numpy's beyond."""

    MOST, SLOTS = 2048, 256

    def __init__(self, counts: np.ndarray, rate: float):
        self.counts, self.rate = counts, rate
        self.large = np.flatnonzero(counts > self.MOST)
        values, rank = np.unique(np.where(counts > self.MOST, 0, counts), return_inverse=True)
        logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, self.MOST + 1)))])
        below, guide, starts = [], [], np.concatenate([[0], np.cumsum(values + 1)])
        for n in values.tolist():
            k = np.arange(n + 1)
            share = np.cumsum(np.exp(logs[n] - logs[k] - logs[n - k] + k * np.log(rate) + (n - k) * np.log1p(-rate)))
            share[-1] = np.inf
            below.append(share)
            guide.append(np.searchsorted(share, np.arange(self.SLOTS) / self.SLOTS, side="right"))
        self.below, self.guide = np.concatenate(below), np.concatenate(guide)
        self.start, self.slot = starts[rank], rank * self.SLOTS

    def draw(self, rng: np.random.Generator) -> np.ndarray:
        u = rng.random(len(self.counts))
        told = self.guide.take(self.slot + (u * self.SLOTS).astype(np.int64))
        more = np.flatnonzero(u >= self.below.take(self.start + told))
        while len(more):
            told[more] += 1
            more = more[u[more] >= self.below[self.start[more] + told[more]]]
        if len(self.large):
            told[self.large] = rng.binomial(self.counts[self.large], self.rate)
        return told


# --- growing ---------------------------------------------------------------------------------

class Tree:
    """Nodes in arrays; a leaf's child is itself, so that a row goes down as many steps as the tree is deep."""

    def __init__(self, most: int):
        self.many, self.depth = 1, 0
        self.feature, self.cut, self.left = np.zeros(most, np.int64), np.full(most, 255), np.arange(most)
        self.impurity, self.gain, self.stats = np.zeros(most), np.zeros(most), np.zeros((3, most))

    def sealed(self) -> "Tree":
        for name in ("feature", "cut", "left", "impurity", "gain"):
            setattr(self, name, getattr(self, name)[:self.many].copy())
        self.stats = self.stats[:, :self.many].copy()
        self.value = np.where(self.stats[0] > 0, self.stats[1] / np.maximum(self.stats[0], 1), 0.0)
        return self

    def step(self, at: np.ndarray, flat: np.ndarray, base: np.ndarray) -> np.ndarray:
        """One step down for units at the nodes ``at``, whose bins are ``flat[base:]``."""
        went = flat.take(base + self.feature.take(at)) > self.cut.take(at)
        return self.left.take(at) + went

    def leaves(self, flat: np.ndarray, base: np.ndarray) -> np.ndarray:
        at = np.zeros(len(base), np.int64)
        for _ in range(self.depth):
            at = self.step(at, flat, base)
        return at


def _impurity(stats: np.ndarray) -> np.ndarray:
    n, s, q = stats
    return (q - s * s / n) / n


class Sums:
    """Count, sum and sum of squares of the labels per node, feature and bin.

    ``in_order`` adds up row by row, as Spark does.  Otherwise features are put into groups of few joint values, the sums
    are made per joint value, and a feature's bins are sums of those: far fewer additions."""

    def __init__(self, bins: np.ndarray, splits: list[np.ndarray], in_order: bool):
        self.sizes = np.array([len(t) + 1 for t in splits])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.width, self.in_order = int(self.starts[-1]), in_order
        if not in_order:
            self.groups = [(code, sizes, [self._spread(bins, *g) for g in members]) for code, sizes, members in self._grouped(bins)]
        elif bins.size <= BLOCK:
            self.codes = (bins + self.starts[:-1]).astype(np.int64)
        else:
            self.columns = [(f, bins[:, f].astype(np.int64)) for f in np.flatnonzero(self.sizes > 1).tolist()]
        # blocks of features with about as many bins: the places of their bins, and which of their splits there are
        self.blocks, self.block, self.within = [], np.full(len(splits), -1), np.zeros(len(splits), np.int64)
        for some in (np.flatnonzero(self.sizes == 2), np.flatnonzero(self.sizes > 2)):
            if len(some):
                self.block[some], self.within[some] = len(self.blocks), np.arange(len(some))
                most = self.sizes[some].max()
                real = np.arange(most) < self.sizes[some, None]
                self.blocks.append((some, np.where(real, self.starts[some, None] + np.arange(most), self.width), real[:, 1:]))

    def _grouped(self, bins: np.ndarray) -> list[tuple[np.ndarray, list[int], list]]:
        """Groups (features, joint value of every unit, their count): a feature joins those that it depends on most.  Small
        groups are then summed together: (joint code, the groups' counts, the groups)."""
        def joined(one, two):
            joint = one[1] * two[2] + two[1]
            found = np.flatnonzero(np.bincount(joint, minlength=1))
            names = np.zeros(one[2] * two[2], np.int64)
            names[found] = np.arange(len(found))
            return one[0] + two[0], names[joint], len(found)

        groups = []
        for f in np.flatnonzero(self.sizes > 1).tolist():
            alone = joined(([], np.zeros(len(bins), np.int64), 1), ([f], bins[:, f].astype(np.int64), int(self.sizes[f])))
            tried = [(g, joined(groups[g], alone)) for g in range(len(groups))]
            tried = [(t[2] / (groups[g][2] * alone[2]), g, t) for g, t in tried if t[2] <= GROUP_CODES]
            share, g, best = min(tried, key=lambda x: x[:2], default=(1.0, 0, None))
            if share < 0.9:
                groups[g] = best
            else:
                groups.append(alone)
        told = []
        for group in sorted(groups, key=lambda g: g[2]):
            if told and math.prod(told[-1][1]) * group[2] <= GROUP_CODES:
                code, sizes, members = told[-1]
                told[-1] = code * group[2] + group[1], [*sizes, group[2]], [*members, group]
            else:
                told.append((group[1], [group[2]], [group]))
        return told

    def _spread(self, bins: np.ndarray, features: list[int], code: np.ndarray, many: int):
        """Which bins of the features a joint value is in, and the places of those bins."""
        first = np.zeros(many, np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        spread, at = np.zeros((many, int(self.sizes[features].sum()))), 0
        for f in features:
            spread[np.arange(many), at + bins[first, f].astype(np.int64)] = 1.0
            at += self.sizes[f]
        return spread, np.concatenate([np.arange(self.starts[f], self.starts[f + 1]) for f in features])

    def of(self, some: np.ndarray | None, node: np.ndarray, nodes: int, stats: np.ndarray) -> np.ndarray:
        """(3, nodes, width + 1): of the units ``some`` at ``node``; the last column stays 0, units of node ``nodes`` are left out."""
        out = np.zeros((3, nodes, self.width + 1))
        if not self.in_order:
            for code, sizes, members in self.groups:
                many = math.prod(sizes)
                flat = node * many + code
                sums = np.stack([np.bincount(flat, w, (nodes + 1) * many)[:nodes * many] for w in stats]).reshape(3, nodes, *sizes)
                for k, (spread, places) in enumerate(members):
                    other = tuple(2 + j for j in range(len(sizes)) if j != k)
                    out[:, :, places] = (sums.sum(axis=other) if other else sums) @ spread
            return out
        if hasattr(self, "codes"):
            features = self.codes.shape[1]
            flat, size = (node[:, None] * self.width + self.codes[some]).ravel(), (nodes + 1) * self.width
            told = [np.bincount(flat, None, size), *(np.bincount(flat, np.repeat(w, features), size) for w in stats[1:])]
            out[:, :, :-1] = np.stack(told).reshape(3, -1, self.width)[:, :nodes]
            return out
        for f, column in self.columns:
            size, start = self.sizes[f], self.starts[f]
            flat = node * size + column.take(some)
            told = [np.bincount(flat, None, (nodes + 1) * size), *(np.bincount(flat, w, (nodes + 1) * size) for w in stats[1:])]
            out[:, :, start:start + size] = np.stack(told).reshape(3, -1, size)[:, :nodes]
        return out

    def best_splits(self, hist: np.ndarray, order: np.ndarray, impurity: np.ndarray | None):
        """Per node: gain, feature, cut, stats left and right, impurity; with no valid split the gain is -inf."""
        nodes, made = hist.shape[1], []
        gains, cuts = np.full((nodes, len(self.sizes)), -np.inf), np.zeros((nodes, len(self.sizes)), np.int64)
        for some, place, real in self.blocks:
            if place.shape[1] == 2:
                left, right = hist[:, :, place[:, 0]], hist[:, :, place[:, 1]]
                made.append((left[..., None], (right + left - left)[..., None]))
            else:
                cum = np.cumsum(hist[:, :, place], axis=3)
                made.append((cum[..., :-1], cum[..., -1:] - cum[..., :-1]))
        if impurity is None:  # the root's stats are both sides of the first split looked at
            first = next((f for f in order[0].tolist() if self.sizes[f] > 1), None)
            impurity = np.zeros(nodes)
            if first is not None:
                left, right = (x[:, 0, self.within[first], 0] for x in made[self.block[first]])
                impurity = _impurity((left + right).reshape(3, 1))
        for (some, _, real), (left, right) in zip(self.blocks, made):
            total = left[0] + right[0]
            gain = (impurity[:, None, None] - left[0] / total * _impurity(left)) - right[0] / total * _impurity(right)
            gain = np.where(real & (left[0] >= 1) & (right[0] >= 1) & (gain >= 0.0), gain, -np.inf)
            cut = np.argmax(gain, axis=2)
            gains[:, some], cuts[:, some] = np.take_along_axis(gain, cut[:, :, None], axis=2)[:, :, 0], cut
        row = np.arange(nodes)
        best = order[row, np.argmax(np.take_along_axis(gains, order, axis=1), axis=1)]
        sides = np.zeros((2, 3, nodes))
        for b, two in enumerate(made):
            which = np.flatnonzero(self.block[best] == b)
            for side, x in zip(sides, two):
                side[:, which] = x[:, which, self.within[best[which]], cuts[which, best[which]]]
        return gains[row, best], best, cuts[row, best], sides, impurity


def grow_tree(sums: Sums, some: np.ndarray | None, flat: np.ndarray, base: np.ndarray, stats: np.ndarray, depth: int,
              drawn: Callable[[int, int], np.ndarray]) -> tuple[Tree, np.ndarray]:
    """One regression tree of the units ``some`` (all, if None) of those with bins ``flat[base:]``, with their stats (weight,
    weighted label, weighted square); and the leaf of every unit."""
    at, level, impurity, turn = np.zeros(len(base), np.int64), np.zeros(1, np.int64), None, 0
    tree = Tree(min(2 ** (depth + 1) - 1, 2 * max(1, len(base)) + 1))
    tree.stats[:, 0] = [np.cumsum(w)[-1] if len(w) else 0.0 for w in stats]
    for deep in range(1, depth + 1):
        nodes = len(level)
        slot = np.full(tree.many, nodes)
        slot[level] = np.arange(nodes)
        hist = sums.of(some, slot.take(at if some is None else at.take(some)), nodes, stats)
        gain, feature, cut, sides, impurity = sums.best_splits(hist, drawn(turn, nodes), impurity)
        turn += nodes
        valid, split = gain > -np.inf, np.flatnonzero(gain > 0)
        if deep == 1 and valid[0]:
            tree.stats[:, 0] = sides[0][:, 0] + sides[1][:, 0]
        tree.impurity[level], tree.gain[level] = np.where(valid, impurity, -1.0), np.where(valid, gain, 0.0)
        if not len(split):
            break
        child = tree.many + 2 * np.arange(len(split))
        tree.feature[level[split]], tree.cut[level[split]], tree.left[level[split]] = feature[split], cut[split], child
        both = np.stack([child, child + 1], axis=1).ravel()
        tree.stats[:, both] = sides[:, :, split].transpose(1, 2, 0).reshape(3, -1)
        tree.impurity[both] = told = _impurity(tree.stats[:, both])
        tree.many += len(both)
        tree.depth = deep
        at = tree.step(at, flat, base)
        more = np.flatnonzero(~(np.abs(told) < EPSILON))[::-1]  # Spark takes the node put on its stack last
        if not len(more):
            break
        level, impurity = both[more], told[more]
    return tree.sealed(), at


def features_per_node(strategy: str, features: int) -> int:
    """Of a share like "0.8096", a number of features, or "auto" and "all" (all of them, as of a single tree)."""
    if strategy in ("auto", "all"):
        return features
    return min(int(strategy), features) if strategy.isdigit() else int(np.ceil(float(strategy) * features))


#: What a learner may set for its trees to be grown here.
PARAMS = ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy", "seed")


def params_of(learner) -> dict | None:
    """The parameters of the learner's trees; None for another learner, or one with settings that only Spark ML knows."""
    known = isinstance(learner, GBTClassifier) and {p.name for p in learner._paramMap} <= {*PARAMS, "featuresCol", "labelCol"}
    if not known or not re.fullmatch(r"auto|all|[0-9.]+", learner.getFeatureSubsetStrategy()):
        return None
    return {name: learner.getOrDefault(name) for name in PARAMS}


def grow(bins: np.ndarray, pos: np.ndarray, neg: np.ndarray, splits: list[np.ndarray], params: dict, in_order: bool) -> Iterator[Tree]:
    """The trees of a fit, one after another: the first counts once, the others ``stepSize`` times."""
    trees, rate, seed = params["maxIter"], params["subsamplingRate"], params["seed"]
    sums = Sums(bins, splits, in_order)
    flat, base = bins.ravel(), np.arange(len(bins), dtype=np.int64) * bins.shape[1]
    features = NodeFeatures(seed, trees, len(splits), features_per_node(params["featureSubsetStrategy"], len(splits)))
    margin, n1, n0, some = np.zeros(len(bins)), pos, neg, np.arange(len(bins)) if in_order else None
    if rate < 1.0 and in_order:
        draws = row_draws(seed, trees, len(bins), rate)
    elif rate < 1.0:
        draws = Binomials(np.concatenate([pos, neg]), rate)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for m in range(trees):
            if rate < 1.0 and in_order:
                some = np.flatnonzero(next(draws))
                n1, n0 = pos[some], neg[some]
            elif rate < 1.0:
                n1, n0 = np.split(draws.draw(np.random.default_rng([abs(seed), m])), 2)
            up, down = np.ones(1), -np.ones(1)
            if m:
                now = margin if some is None else margin[some]
                up, down = 4.0 / (1.0 + np.exp(2.0 * now)), -4.0 / (1.0 + np.exp(-2.0 * now))
            one, two = n1 * up, n0 * down
            stats = np.stack([n1 + n0, one + two, one * up + two * down])
            tree, at = grow_tree(sums, some, flat, base, stats, params["maxDepth"], lambda start, count: features.of(m, start, count))
            margin += tree.value.take(at) * (1.0 if m == 0 else params["stepSize"])
            yield tree


def staged_margins(trees: Iterator[Tree], bins: np.ndarray, step: float, counts: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(k, margin of the first k trees) of other units, for each k of ``counts``."""
    flat, base = bins.ravel(), np.arange(len(bins), dtype=np.int64) * bins.shape[1]
    margin = np.zeros(len(bins))
    for m, tree in enumerate(trees):
        margin = margin + tree.value.take(tree.leaves(flat, base)) * (1.0 if m == 0 else step)
        if m + 1 in counts:
            yield m + 1, margin


def probability(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


# --- frames ----------------------------------------------------------------------------------

def find_splits(rows: DataFrame, learner: GBTClassifier) -> list[np.ndarray]:
    """Spark ML's split points of every feature.  Its checks of the rows (labels 0 and 1, no NaN) are made here, too."""
    jvm, java = rows.sparkSession._jvm, learner._to_java()
    module = lambda package, name: getattr(getattr(package, f"{name}$"), "MODULE$")
    instances = module(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(java, rows._jdf, jvm.scala.Some(2))
    strategy = java.getOldBoostingStrategy(module(jvm.scala.collection.immutable, "Map").empty(),
                                           module(jvm.org.apache.spark.mllib.tree.configuration, "Algo").Classification()).treeStrategy().copy()
    strategy.setAlgo("Regression")
    strategy.setImpurity(module(jvm.org.apache.spark.mllib.tree.impurity, "Variance"))
    metadata = module(jvm.org.apache.spark.ml.tree.impl, "DecisionTreeMetadata").buildMetadata(instances, strategy, 1, "all")
    found = module(jvm.org.apache.spark.ml.tree.impl, "RandomForest").findSplits(instances, metadata, learner.getSeed())
    return [np.array([s.threshold() for s in some], np.float64) for some in found]


def _binned(splits: list[np.ndarray], in_order: bool, train: bool) -> Callable:
    """Of rows (label, features...): units, one a row, or one for all rows of a batch with equal bins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            pos, neg = (label == 1).astype(np.int64), (label == 0).astype(np.int64)
            if train and not (pos + neg).all():
                raise ValueError("a label is neither 0 nor 1")
            bins = np.empty((len(label), len(splits)), np.uint8)
            for f, t in enumerate(splits):
                values = batch.column(f + 1).to_numpy(zero_copy_only=False)
                if train and not np.isfinite(values).all():
                    raise ValueError(f"feature {f} of a row to fit is null, NaN or infinite")
                bins[:, f] = ~(values <= t[0]) if len(t) == 1 else np.searchsorted(t, values, side="left")
            if not in_order and len(bins):
                keys, unit = np.unique(bins.view(f"V{len(splits)}").ravel(), return_inverse=True)
                pos, neg = (np.bincount(unit, x, len(keys)).astype(np.int64) for x in (pos, neg))
                bins = keys.view(np.uint8).reshape(-1, len(splits))
            ends = np.arange(0, bins.size + 1, len(splits), dtype=np.int32)
            cells = pa.BinaryArray.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(bins))])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(place, place + len(bins))), cells, pa.array(pos), pa.array(neg)],
                                             names=["place", "bins", "pos", "neg"])
            place += len(bins)
    return run


def units(rows: DataFrame, splits: list[np.ndarray], in_order: bool, train: bool = True) -> DataFrame:
    """The units of the rows (label, features...)."""
    importable_in_workers(rows.sparkSession)
    numbers = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(rows.columns)])
    told = numbers.mapInArrow(_binned(splits, in_order, train), UNIT)
    if in_order:
        return told
    told = told.groupBy("bins").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return told.select(F.lit(0).cast("long").alias("place"), "bins", "pos", "neg")


def gathered(batches: Iterator[pa.RecordBatch], features: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, pos, neg) of the units (role, place, bins, pos, neg) of role 0 and of role 1, in one order however they come."""
    parts = []
    for batch in batches:
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
        parts.append((bins, *(batch.column(c).to_numpy() for c in ("role", "place", "pos", "neg"))))
    bins, role, place, pos, neg = (np.concatenate(x) for x in zip(*parts))
    told = []
    for r in (0, 1):
        some = np.flatnonzero(role == r)
        keys = np.unique(bins[some].view(f"V{features}").ravel(), return_inverse=True)[1] if len(some) else some
        some = some[np.lexsort((keys, place[some]))]
        told.append((bins[some], pos[some], neg[some]))
    return told


def auc_of(pos: np.ndarray, neg: np.ndarray) -> float | None:
    """The exact ROC AUC of the counts per score, in order of the score (ties count one half)."""
    pairs = int(pos.sum()) * int(neg.sum())
    return float(np.sum(pos * (np.cumsum(neg) - neg + 0.5 * neg)) / pairs) if pairs else None


def _scored(batches, splits, params, in_order, counts, raw):
    """(trees, score, pos, neg) of the units of role 1, fitted on those of role 0, after each count of trees."""
    train, (bins, pos, neg) = gathered(batches, len(splits))
    for k, margin in staged_margins(grow(*train, splits, params, in_order), bins, params["stepSize"], counts):
        score, unit = np.unique(margin if raw else probability(margin), return_inverse=True)
        yield k, score, *(np.bincount(unit, x, len(score)).astype(np.int64) for x in (pos, neg))


def scores(splits: list[np.ndarray], params: dict, in_order: bool, fit: int) -> Callable:
    """Of the units of a train (role 0) and a test frame (role 1): rows of ``SCORED``, the fit's probabilities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, score, pos, neg in _scored(batches, splits, params, in_order, [params["maxIter"]], False):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), fit, np.int32)), pa.array(score), pa.array(pos), pa.array(neg)],
                                             names=["fit", "score", "pos", "neg"])
    return run


def stages(splits: list[np.ndarray], params: dict, in_order: bool, counts: list[int]) -> Callable:
    """Of the units of a train (role 0) and a test frame (role 1): the AUC (of the margins) after each count of trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = [(k, auc_of(pos, neg)) for k, _, pos, neg in _scored(batches, splits, params, in_order, counts, True)]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in told], pa.int32()), pa.array([auc for _, auc in told], pa.float64())],
                                         names=["trees", "auc"])
    return run


SCORED, STAGED = "fit int, score double, pos long, neg long", "trees int, auc double"
NODE = "tree int, node int, left int, feature int, cut int, value double, impurity double, gain double, n double, s double, q double"


def nodes(splits: list[np.ndarray], params: dict, in_order: bool) -> Callable:
    """Of the units of a frame (role 0): the nodes of all trees of a fit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, pos, neg = gathered(batches, len(splits))[0]
        for m, t in enumerate(grow(bins, pos, neg, splits, params, in_order)):
            ints = [np.full(t.many, m), np.arange(t.many), t.left, t.feature, t.cut]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in ints]
                                             + [pa.array(np.ascontiguousarray(x)) for x in (t.value, t.impurity, t.gain, *t.stats)],
                                             names=[c.split()[0] for c in NODE.split(", ")])
    return run


def spark_model(spark: SparkSession, told: list, splits: list[np.ndarray], learner: GBTClassifier) -> GBTClassificationModel:
    """Spark ML's model of the nodes (rows of ``NODE`` by tree and node); like Spark ML it joins leaves of equal value."""
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    package = jvm.org.apache.spark.ml.tree
    leaf, inner, cut_at, calculator = package.LeafNode, package.InternalNode, package.ContinuousSplit, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    tree_model = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    raw = np.array([(r["n"], r["s"], r["q"]) for r in told], ">f8").tobytes()
    numbers = gateway.new_array(gateway.jvm.double, 3 * len(told))
    jvm.java.nio.ByteBuffer.wrap(raw).asDoubleBuffer().get(numbers)
    cut_range, at, many = jvm.java.util.Arrays.copyOfRange, 0, told[-1]["tree"] + 1
    learners, weights = gateway.new_array(tree_model, many), gateway.new_array(gateway.jvm.double, many)
    for m in range(many):
        end = at
        while end < len(told) and told[end]["tree"] == m:
            end += 1
        made: dict[int, tuple] = {}
        for i in range(end - 1, at - 1, -1):  # children before parents
            r = told[i]
            stats = calculator(cut_range(numbers, 3 * i, 3 * i + 3), int(r["n"]))
            if r["left"] != r["node"]:
                (left, is_leaf, one), (right, leaf_too, two) = made.pop(r["left"]), made.pop(r["left"] + 1)
            if r["left"] == r["node"] or is_leaf and leaf_too and one == two:
                value = r["value"] if r["left"] == r["node"] else one
                made[r["node"]] = leaf(value, r["impurity"], stats), True, value
            else:
                split = cut_at(r["feature"], float(splits[r["feature"]][r["cut"]]))
                made[r["node"]] = inner(r["value"], r["impurity"], r["gain"], left, right, split, stats), False, r["value"]
        learners[m] = tree_model(made[0][0], len(splits))
        weights[m] = 1.0 if m == 0 else learner.getStepSize()
        at = end
    java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(learner.uid, learners, weights, len(splits), 2)
    model = GBTClassificationModel(java)
    learner._transfer_params_to_java()
    return learner._copyValues(model)
