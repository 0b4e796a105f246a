"""Boosted trees on quantised features: what one block of rows contributes, and how counts become splits.

Features are bins (at most 255) and everything that rows are reduced to is an
integer: rows and positive residuals (quantile loss) or scaled residuals
(squared loss) by node, feature and bin, residuals by leaf and residual bin,
scaled absolute errors.  Integers add up to the same sum in any order, so a
model is the same number for number whether its rows lie in one block, whose
counts are used as they are, or in thousands, whose counts Spark adds up first
(boosting.py drives both).

A tree is grown a level at a time: the counts of all open nodes at once, the
best split of each, rows moved to the children.  The value of a leaf is the
alpha-quantile of its residuals, found by counting them in RANGES bins of the
round's range and again inside the bin that holds it, or their shrunken mean.
"""

from __future__ import annotations

import io
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

#: Bins of a feature, bins in which residuals are counted (twice, one inside the other).
BINS, RANGES = 128, 512
#: Residuals and errors are counted in this many steps of the label's range.
STEPS = 1 << 40
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """What a fit is told; ``early_stopping`` 0 never stops, ``parallel_trees`` grow from the same residuals."""
    alpha: float = 0.95
    max_depth: int = 10
    learning_rate: float = 0.067
    n_estimators: int = 645
    subsample: float = 1.0
    colsample: float = 1.0
    early_stopping: int = 50
    seed: int = 0
    min_instances: int = 1
    reg_lambda: float = 1.0
    parallel_trees: int = 1
    squared: bool = False


@dataclass
class Tree:
    """Nodes: feature (-1: leaf), last bin that goes left, left child (the right one follows it),
    value, gain of the split, sampled training rows that reach it."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @staticmethod
    def root() -> "Tree":
        return Tree(np.array([-1]), np.array([0]), np.array([-1]), np.array([0.0]), np.array([0.0]), np.array([0.0]))

    def covered(self, leaf_rows: np.ndarray) -> None:
        """Sets ``cover`` from the rows of the leaves; children follow their parents."""
        self.cover = leaf_rows.astype(float)
        for k in np.flatnonzero(self.feature >= 0)[::-1]:
            self.cover[k] = self.cover[self.left[k]] + self.cover[self.left[k] + 1]

    def split(self, nodes: np.ndarray, feature: np.ndarray, bin_: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Gives each of ``nodes`` two children; returns the children's numbers."""
        first, k = len(self.feature), len(nodes)
        self.feature[nodes], self.bin[nodes], self.gain[nodes] = feature, bin_, gain
        self.left[nodes] = first + 2 * np.arange(k)
        more = lambda a, v: np.concatenate([a, np.full(2 * k, v, a.dtype)])
        self.feature, self.bin, self.left = more(self.feature, -1), more(self.bin, 0), more(self.left, -1)
        self.value, self.gain, self.cover = more(self.value, 0.0), more(self.gain, 0.0), more(self.cover, 0.0)
        return np.arange(first, first + 2 * k)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of bins."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        while len(rows):
            here = at[rows]
            at[rows] = self.left[here] + (x[rows, self.feature[here]] > self.bin[here])
            rows = rows[self.feature[at[rows]] >= 0]
        return at


@dataclass
class State:
    """A model on the way: trees so far, errors on the held-out rows by round, and whether it is done."""
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    done: bool = False

    def best(self) -> int:
        """Rounds to keep: up to the least error, all without held-out rows."""
        return int(np.argmin(self.errors)) + 1 if self.errors and not np.isnan(self.errors[0]) else len(self.errors)

    def to_bytes(self) -> bytes:
        sizes = np.array([len(t.feature) for t in self.trees], np.int64)
        join = lambda name, kind: np.concatenate([getattr(t, name) for t in self.trees]).astype(kind) if self.trees else np.zeros(0, kind)
        out = io.BytesIO()
        np.savez(out, base=np.array([self.base]), errors=np.array(self.errors), done=np.array([self.done]), sizes=sizes, feature=join("feature", np.int32),
                 bin=join("bin", np.int16), left=join("left", np.int32), value=join("value", float), gain=join("gain", float), cover=join("cover", float))
        return out.getvalue()

    @staticmethod
    def from_bytes(body: bytes) -> "State":
        z = np.load(io.BytesIO(bytes(body)))
        cuts = np.cumsum(z["sizes"])[:-1]
        parts = [np.split(z[c].astype(np.int64 if c in ("feature", "bin", "left") else float), cuts) for c in ("feature", "bin", "left", "value", "gain", "cover")]
        trees = [Tree(*p) for p in zip(*parts)] if len(z["sizes"]) else []
        return State(float(z["base"][0]), trees, z["errors"].tolist(), bool(z["done"][0]))


@dataclass
class Block:
    """Rows of a model: bins, labels, a hash that draws samples, whether a row is held out."""
    x: np.ndarray
    y: np.ndarray
    h: np.ndarray
    test: np.ndarray

    @staticmethod
    def of(width: int, x: bytes, y: bytes, h: bytes, test: bytes) -> "Block":
        return Block(np.frombuffer(x, np.uint8).reshape(-1, width), np.frombuffer(y, float), np.frombuffer(h, np.uint64), np.frombuffer(test, bool))


def edges_at(n: int, bins: int = BINS) -> list[int]:
    """Ranks, among ``n`` sorted values, of the values that begin a bin."""
    return sorted({i * n // bins for i in range(1, bins)} - {0}) if n else []


def to_bins(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin of each value: how many edges are not above it."""
    return np.searchsorted(edges, values, side="right").astype(np.uint8)


def features_of(width: int, s: Settings, round_: int, tree: int) -> np.ndarray:
    """The columns that a tree may use, drawn by its number."""
    k = max(1, round(s.colsample * width))
    return np.sort(np.random.default_rng([s.seed, round_, tree]).permutation(width)[:k])


def sampled(b: Block, s: Settings, round_: int, tree: int) -> np.ndarray:
    """Whether each training row is in a tree's sample, drawn by the row's hash."""
    if s.subsample >= 1:
        return ~b.test
    u = b.h + np.uint64((s.seed * 1_000_003 + round_ * 101 + tree + 1) * int(_MIX) % (1 << 64))
    u = (u ^ (u >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    u = (u ^ (u >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ~b.test & ((u >> np.uint64(11)).astype(float) / (1 << 53) < s.subsample)


def signal(y: np.ndarray, f: np.ndarray, s: Settings, step: float) -> np.ndarray:
    """What a row adds to the counts of its node besides 1."""
    return np.rint((y - f) / step).astype(np.int64) if s.squared else (y - f > 0).astype(np.int64)


def slope(n: np.ndarray, t: np.ndarray, s: Settings, step: float) -> np.ndarray:
    """Sum of the negative gradients of ``n`` rows whose signals sum to ``t``."""
    return t * step if s.squared else t - (1 - s.alpha) * n


def level_counts(b: Block, node: np.ndarray, rows: np.ndarray, signals: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, n, t) for the ``rows`` of a block: code = (node * columns + place) * 256 + bin, rising."""
    code = ((node[rows, None] * len(columns) + np.arange(len(columns))) * 256 + b.x[np.ix_(rows, columns)]).ravel()
    t = np.repeat(signals[rows], len(columns))
    low, high = (int(code.min()), int(code.max())) if len(code) else (0, 0)
    if high - low < max(1 << 16, 8 * len(code)):
        n = np.bincount(code - low)
        found = np.flatnonzero(n)
        total = np.zeros(len(n), np.int64)
        if len(code) and np.max(np.abs(t)) * len(t) < 1 << 53:
            total = np.rint(np.bincount(code - low, weights=t)).astype(np.int64)
        else:
            np.add.at(total, code - low, t)
        return found + low, n[found], total[found]
    found, inverse, n = np.unique(code, return_inverse=True, return_counts=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, inverse, t)
    return found, n, total


def best_splits(code: np.ndarray, n: np.ndarray, t: np.ndarray, columns: np.ndarray, s: Settings, step: float) -> tuple[np.ndarray, ...]:
    """(node, feature, bin, gain) of every node that a split improves; ties go to the first column and bin."""
    if not len(code):
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, float))
    group = code >> 8  # node and column
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(code)])
    upto_n, upto_t = np.cumsum(n), np.cumsum(t)
    before = lambda c, v: np.repeat(c[starts] - v[starts], sizes)
    left_n, left_t = upto_n - before(upto_n, n), upto_t - before(upto_t, t)
    all_n, all_t = (np.repeat(np.add.reduceat(v, starts), sizes) for v in (n, t))
    right_n, right_t = all_n - left_n, all_t - left_t
    score = lambda m, v: slope(m, v, s, step) ** 2 / (m + s.reg_lambda)
    gain = np.where((left_n >= s.min_instances) & (right_n >= s.min_instances), score(left_n, left_t) + score(right_n, right_t) - score(all_n, all_t), -1.0)
    node = group // len(columns)
    firsts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    most = np.repeat(np.maximum.reduceat(gain, firsts), np.diff(np.r_[firsts, len(code)]))
    at = np.flatnonzero((gain == most) & (gain > 1e-9))
    at = at[np.r_[True, node[at][1:] != node[at][:-1]]] if len(at) else at
    return node[at], columns[group[at] % len(columns)], code[at] & 255, gain[at]


def moved(b: Block, node: np.ndarray, tree: Tree) -> np.ndarray:
    """Rows whose node was split go to its children; -1 for those in a finished node."""
    split = (node >= 0) & (tree.feature[node] >= 0)
    at = node[split]
    out = np.full(len(node), -1)
    out[split] = tree.left[at] + (b.x[split, tree.feature[at]] > tree.bin[at])
    return out


def residual_bins(residual: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Bin of each residual in RANGES bins of ``width`` from ``low``."""
    place = np.divide(residual - low, width, out=np.zeros(len(residual)), where=width > 0)
    return np.clip(place, 0, RANGES - 1).astype(np.int64)


def quantile_bins(leaf: np.ndarray, bin_: np.ndarray, n: np.ndarray, rank: dict[int, int]) -> dict[int, tuple[int, int]]:
    """{leaf: (bin that holds the row of this rank, rows of the leaf in lower bins)} from rising counts."""
    out = {}
    starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]]) if len(leaf) else []
    for a, z in zip(starts, [*starts[1:], len(leaf)]):
        upto = np.cumsum(n[a:z])
        k = int(np.searchsorted(upto, rank[int(leaf[a])], side="right"))
        out[int(leaf[a])] = int(bin_[a + k]), int(upto[k] - n[a + k])
    return out


def count_pairs(leaf: np.ndarray, bin_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code, n = np.unique(leaf * RANGES + bin_, return_counts=True)
    return code // RANGES, code % RANGES, n


def quantile_rank(n: int, alpha: float) -> int:
    """Rank, from 0, of the alpha-quantile among ``n`` rows."""
    return max(0, int(np.ceil(alpha * n)) - 1)


def error_steps(y: np.ndarray, f: np.ndarray, s: Settings, step: float) -> int:
    """Sum of the held-out rows' errors in whole steps: absolute ones, or for squared loss squared ones of coarser steps."""
    if s.squared:
        e = np.rint((y - f) / (step * (1 << 16))).astype(object)
        return int((e * e).sum()) if len(e) else 0
    return int(np.rint(np.abs(y - f) / step).astype(np.int64).sum())


def error_of(steps: int, n: int, s: Settings, step: float) -> float:
    """Mean absolute error, or root of the mean squared one."""
    if not n:
        return float("nan")
    return float(np.sqrt(steps / n) * step * (1 << 16)) if s.squared else steps * step / n


def stopped(errors: Sequence[float], s: Settings) -> bool:
    """Whether the error has not fallen for ``early_stopping`` rounds, or all rounds are done."""
    if len(errors) >= s.n_estimators:
        return True
    return bool(s.early_stopping and errors and not np.isnan(errors[0]) and len(errors) - 1 - int(np.argmin(errors)) >= s.early_stopping)


# -- a model whose rows lie in one block -----------------------------------------------------------

def grow(b: Block, f: np.ndarray, s: Settings, round_: int, number: int, step: float) -> Tree:
    """One tree from the rows of a block."""
    tree, columns, mask = Tree.root(), features_of(b.x.shape[1], s, round_, number), sampled(b, s, round_, number)
    signals, node = signal(b.y, f, s, step), np.where(mask, 0, -1)
    for _ in range(s.max_depth):
        rows = np.flatnonzero(node >= 0)
        nodes, feature, bin_, gain = best_splits(*level_counts(b, node, rows, signals, columns), columns, s, step)
        if not len(nodes):
            break
        tree.split(nodes, feature, bin_, gain)
        node = moved(b, node, tree)
    rows = np.flatnonzero(mask)
    inside = Block(b.x[rows], b.y[rows], b.h[rows], b.test[rows])
    leaf, residual = tree.leaves(inside.x), inside.y - f[rows]
    if s.squared:
        n, t = np.bincount(leaf, minlength=len(tree.value)), np.zeros(len(tree.value), np.int64)
        np.add.at(t, leaf, signals[rows])
        tree.value = t * step / (n + s.reg_lambda)
        tree.covered(n)
    elif len(rows):
        low, high = float(residual.min()), float(residual.max())
        set_quantiles(tree, lambda lows, widths: count_pairs(leaf, residual_bins(residual, lows[leaf], widths[leaf])),
                      lambda lows, widths, picked: _inside(leaf, residual, lows, widths, picked), low, high, s)
    return tree


def _inside(leaf: np.ndarray, residual: np.ndarray, lows: np.ndarray, widths: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, in finer bins, of the rows that lie in the picked bin of their leaf."""
    here = residual_bins(residual, lows[leaf], widths[leaf]) == picked[leaf]
    low, width = (lows + picked * widths)[leaf[here]], (widths / RANGES)[leaf[here]]
    return count_pairs(leaf[here], residual_bins(residual[here], low, width))


def set_quantiles(tree: Tree, counts, counts_inside, low: float, high: float, s: Settings) -> None:
    """Leaf values: the middle of the finer bin that holds the quantile of the leaf's residuals."""
    size = len(tree.value)
    lows, widths = np.full(size, low), np.full(size, (high - low) / RANGES)
    leaf, bin_, n = counts(lows, widths)
    totals = np.bincount(leaf, weights=n, minlength=size).astype(int)
    tree.covered(totals)
    rank = {int(k): quantile_rank(int(totals[k]), s.alpha) for k in np.unique(leaf)}
    first = quantile_bins(leaf, bin_, n, rank)
    picked = np.full(size, -1)
    for k, (at, _) in first.items():
        picked[k] = at
    second = quantile_bins(*counts_inside(lows, widths, picked), {k: rank[k] - below for k, (_, below) in first.items()})
    for k, (at, _) in second.items():
        tree.value[k] = lows[k] + (picked[k] + (at + 0.5) / RANGES) * widths[k]


def start(b: Block, s: Settings) -> tuple[float, float]:
    """(first prediction, size of a step) of the training rows."""
    y = b.y[~b.test]
    if not len(y):
        return 0.0, 1.0
    step = max(float(y.max() - y.min()), 1e-12) / STEPS
    if s.squared:
        return float(sum(np.rint(y / step).astype(np.int64).tolist())) / len(y) * step, step
    return float(np.partition(y, quantile_rank(len(y), s.alpha))[quantile_rank(len(y), s.alpha)]), step


def advance(b: Block, s: Settings, state: State | None = None, upto: int | None = None) -> State:
    """Boosts a model to ``upto`` rounds, or to its end; going on later gives the same model."""
    base, step = start(b, s)
    state = state or State(base)
    share = s.learning_rate / s.parallel_trees
    f = np.full(len(b.y), base)
    for t in state.trees:
        f += share * t.value[t.leaves(b.x)]
    upto = min(s.n_estimators, s.n_estimators if upto is None else upto)
    held = int(b.test.sum())
    if held == len(b.y):
        state.done = True
    while not state.done and len(state.errors) < upto:
        grown = [grow(b, f, s, len(state.errors), k, step) for k in range(s.parallel_trees)]
        for t in grown:
            f += share * t.value[t.leaves(b.x)]
        state.trees += grown
        state.errors.append(error_of(error_steps(b.y[b.test], f[b.test], s, step), held, s, step))
        state.done = stopped(state.errors, s)
    return state
