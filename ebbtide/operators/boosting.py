"""Gradient-boosted trees over binned features.

Features are cut into at most ``BINS`` ranges once and stored as one byte each, with a bin
of its own for NULL. A tree grows level by level: per open node, feature and bin the sums
of gradients, Hessians and rows make a histogram, and the best split of a node is read off
its cumulated histogram, NULL going to the side with the larger gain. L1 and L2 penalties
shape gains and leaf values. Each round's rows and features are drawn by a hash of the row's
values, the round and the seed (equal rows are drawn together), so a longer fit repeats the
trees of a shorter one whatever the partitions: boosting goes on where it stopped, and the
best round is a prefix of the trees.

Rows stay in their partitions. Of a table larger than ``TOGETHER`` bytes, every task makes
the histograms of its rows, they are added up on the way, and only sums (open nodes x
features x bins) reach the driver, where the trees are kept. The tasks' rows stay in Spark's
cache as arrays; row margins are written anew every ``EVERY`` rounds. Of a smaller table one task holds all rows and grows
``EVERY`` rounds a job. Both ways run the same code and differ in the order of sums alone.
Only the smaller child of a split is counted, over the round's own features; its sibling's
histogram is what the parent's leaves.

The settings of a search are fitted on all rows too, one task each. Of a table larger than
``TOGETHER`` such a task keeps its rows in files and works on ``PART`` of them at once.

With a run folder, trees and losses are written after every job of rounds, and a restarted
driver goes on from there.
"""

from __future__ import annotations

import json
import math
import tempfile
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import settle

FORMAT = 3  # raised when the same data would give other trees
BINS = 64  # the last one is NULL's
NULL = BINS - 1
EVERY = 25  # rounds between two settled states
TOGETHER = 64 << 20  # bytes of binned rows that one task may hold
STEP = 4096  # binned rows per stored row of a table
PART = 1 << 18  # rows in files that a task works on at once
CELLS = 1 << 14  # sums of one kind that a bundle of features may have over the counted nodes
_EPS = 1e-12
_TIE = 1e-9  # gains that differ by less, as sums taken in another order do, are equal


# ---- trees -------------------------------------------------------------------------------------
@dataclass
class Tree:
    """Arrays by node; node 0 is the root, a leaf has feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])  # bins up to this one go left
    null_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])  # sum of Hessians

    def add(self) -> int:
        for name, empty in (("feature", -1), ("bin", 0), ("null_left", False), ("left", -1), ("right", -1), ("value", 0.0), ("gain", 0.0), ("cover", 0.0)):
            getattr(self, name).append(empty)
        return len(self.feature) - 1

    def passes_left(self, n: int) -> np.ndarray:
        """Flags of the bins that go left at a node."""
        out = np.arange(BINS) <= self.bin[n]
        out[NULL] = self.null_left[n]
        return out

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node that each row of bins reaches."""
        feature, cut, null_left = np.array(self.feature), np.array(self.bin), np.array(self.null_left)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(codes), np.int64)
        going = np.flatnonzero(feature[at] >= 0)
        while len(going):
            n = at[going]
            c = codes[going, feature[n]]
            at[going] = np.where(np.where(c == NULL, null_left[n], c <= cut[n]), left[n], right[n])
            going = going[feature[at[going]] >= 0]
        return at

    def margins(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(codes)]

    def add_margins(self, codes: np.ndarray, margin: np.ndarray) -> None:
        """The same for many rows, whose codes lie by feature, added to ``margin``."""
        at = {0: np.arange(len(codes))}
        divide(self, codes, at)
        for n, rows in at.items():
            margin[rows] += self.value[n]


# --- fixed values: boosting defaults --------------------------------------------------------------
DEFAULTS = {
    "leaves": 32, "max_depth": 5, "step_size": 0.05, "min_rows": 50, "subsample": 0.8, "subsample_every": 1, "feature_share": 0.8,
    "reg_alpha": 0.0, "reg_lambda": 0.0, "rounds": 1000, "patience": 50, "seed": 42,
}


def uniform(number: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on row numbers and salts alone."""
    x = number.astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in salt:
            x = (x ^ np.uint64(s & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(27)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def drawn_rows(number: np.ndarray, p: Mapping[str, float], rounds: int) -> np.ndarray:
    return uniform(number, int(p["seed"]), rounds // int(p["subsample_every"]) + 1) < p["subsample"]


def drawn_features(n: int, p: Mapping[str, float], rounds: int) -> np.ndarray:
    """Flags of the features of a round, one at least."""
    place = uniform(np.arange(n), int(p["seed"]) + 7919, rounds + 1)
    wanted = max(1, round(n * p["feature_share"]))
    return place <= np.sort(place)[wanted - 1]


def histogram(codes: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, rows: np.ndarray | None = None, features: Sequence[int] | None = None) -> np.ndarray:
    """Sums (node, feature, bin, kind) of gradients, Hessians and rows; of these ``rows`` and ``features`` of ``codes`` only, if given."""
    which = range(codes.shape[1]) if features is None else features
    out, first = np.zeros((nodes, len(which), BINS, 3)), node.astype(np.int64) * BINS
    for i, f in enumerate(which):
        cell = first + (codes[:, f] if rows is None else codes[:, f].take(rows))
        for k, w in enumerate((g, h, None)):
            out[:, i, :, k] = np.bincount(cell, w, nodes * BINS).reshape(nodes, BINS)
    return out


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def worth(sums: np.ndarray, p: Mapping[str, float]) -> np.ndarray:
    """Reduction of the penalised loss that a leaf with these sums brings, times two."""
    return _shrunk(sums[..., 0], p["reg_alpha"]) ** 2 / (sums[..., 1] + p["reg_lambda"] + _EPS)


def best_splits(hist: np.ndarray, features: np.ndarray, p: Mapping[str, float]):
    """Per node: gain, feature, bin, whether NULL goes left, and the sums left and right; gain 0 without a split."""
    total = hist.sum(axis=2)  # the same for every feature
    low = np.cumsum(hist[:, :, :NULL], axis=2)
    nodes, rows = np.arange(len(hist)), hist[..., 2].any(axis=0)
    sides = []
    for null_left in (False, True):
        # Bins without rows cut as the bin before them does, and NULL's side matters only where there are some.
        held = rows[:, :NULL] & features[:, None] & (rows[:, NULL:] if null_left else True)
        f, b = np.nonzero(held)
        left = low[:, f, b] + hist[:, f, NULL] if null_left else low[:, f, b]
        right = total[:, f] - left
        gain = worth(left, p) + worth(right, p) - worth(total, p)[:, f]
        sides.append((f, b, np.full(len(f), null_left), np.where((left[..., 2] >= p["min_rows"]) & (right[..., 2] >= p["min_rows"]), gain, 0.0)))
    feature, cut, side = (np.concatenate([s[k] for s in sides]) for k in range(3))
    if not len(feature):
        none = np.zeros(len(hist), int)
        return np.zeros(len(hist)), none, none, none == 1, np.zeros_like(total[:, 0]), total[:, 0]
    both = np.concatenate([s[3] for s in sides], axis=1)  # node, (side, feature, bin); ties to NULL right, then to the first feature and bin
    pick = (both >= both.max(axis=1, keepdims=True) * (1 - _TIE)).argmax(axis=1)
    f, b, null_left = feature[pick], cut[pick], side[pick]
    left = low[nodes, f, b] + np.where(null_left[:, None], hist[nodes, f, NULL], 0.0)
    return both[nodes, pick], f, b, null_left, left, total[nodes, f] - left


def leaf_value(sums: np.ndarray, p: Mapping[str, float]) -> float:
    return float(-p["step_size"] * _shrunk(sums[..., 0], p["reg_alpha"]) / (sums[..., 1] + p["reg_lambda"] + _EPS))


class Growing:
    """A tree while it grows: which nodes are open, which of them are counted, and how far its leaf budget goes."""

    def __init__(self, p: Mapping[str, float], width: int, rounds: int):
        self.p, self.tree, self.open, self.leaves, self.depth = p, Tree(), [0], 1, 0
        self.which = np.flatnonzero(drawn_features(width, p, rounds))
        self.counted: list[int] = [0]  # open nodes whose histograms are made from rows
        self.hist: np.ndarray | None = None  # of the level above
        self.pairs: list[tuple[int, bool]] = []  # per two open siblings their parent's place in ``hist``, and whether the left one is counted

    def done(self) -> bool:
        return not self.open or self.depth >= self.p["max_depth"] or self.leaves >= self.p["leaves"]

    def _whole(self, sums: np.ndarray) -> np.ndarray:
        """Histograms of all open nodes from those of the counted ones."""
        if self.hist is None:
            return sums
        out = np.empty((2 * len(self.pairs), *sums.shape[1:]))
        for i, (k, left) in enumerate(self.pairs):
            rest = self.hist[k] - sums[i]
            rest[rest[..., 2] == 0] = 0.0  # no rows, so cuts beside such bins stay equal and the first one counts
            out[2 * i + (not left)], out[2 * i + left] = sums[i], rest
        return out

    def split(self, sums: np.ndarray) -> None:
        """Split open nodes by gain, largest first, until the budget is spent; ``sums`` are the counted nodes' histograms."""
        hist = self._whole(sums)
        gain, feature, cut, null_left, left, right = best_splits(hist, np.ones(len(self.which), bool), self.p)
        tree, opened = self.tree, []
        self.counted, self.pairs, self.hist = [], [], hist
        if self.depth == 0:
            whole = hist[0, 0].sum(axis=0)
            tree.cover[0], tree.value[0] = float(whole[1]), leaf_value(whole, self.p)
        for k in np.argsort(-gain, kind="stable").tolist():
            if gain[k] <= _EPS or self.leaves >= self.p["leaves"]:
                break
            n = self.open[k]
            tree.feature[n], tree.bin[n], tree.null_left[n], tree.gain[n] = int(self.which[feature[k]]), int(cut[k]), bool(null_left[k]), float(gain[k])
            for side, sums_ in (("left", left[k]), ("right", right[k])):
                child = tree.add()
                getattr(tree, side)[n] = child
                tree.value[child], tree.cover[child] = leaf_value(sums_, self.p), float(sums_[1])
                opened.append(child)
            fewer_left = bool(left[k, 2] <= right[k, 2])
            self.pairs.append((k, fewer_left))
            self.counted.append(tree.left[n] if fewer_left else tree.right[n])
            self.leaves += 1
        self.open, self.depth = opened, self.depth + 1


def divide(tree: Tree, codes: np.ndarray, at: dict[int, np.ndarray]) -> None:
    """Move the rows that nodes hold on to their children, down to the leaves."""
    todo = [n for n in at if tree.feature[n] >= 0]
    while todo:
        n = todo.pop()
        rows = at.pop(n)
        left = tree.passes_left(n).take(codes[:, tree.feature[n]].take(rows))
        for child, own in ((tree.left[n], rows.compress(left)), (tree.right[n], rows.compress(~left))):
            at[child] = own
            if tree.feature[child] >= 0:
                todo.append(child)


def slopes(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * p * (1 - p)


def loss_sums(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of weighted log-losses, and of weights."""
    return np.array([(w * np.logaddexp(0.0, np.where(y == 1, -margin, margin))).sum(), w.sum()])


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the lowest loss, and whether ``patience`` rounds without gain have followed it."""
    best = min(range(len(losses)), key=lambda i: (losses[i], i))
    return best + 1, len(losses) - best - 1 >= patience


# ---- one task ------------------------------------------------------------------------------------
@dataclass
class Rows:
    """Binned rows: number, bins, label, weight, margin, and whether they are fitted on or held for the loss."""

    number: np.ndarray
    codes: np.ndarray
    y: np.ndarray
    w: np.ndarray
    margin: np.ndarray
    held: np.ndarray


@dataclass
class State:
    """Trees so far and the loss after each (on the held rows, else on all)."""

    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    ended: bool = False

    def best(self, patience: int, watched: bool) -> int:
        return best_round(self.losses, patience)[0] if watched and self.losses else len(self.trees)


def grow_rounds(rows: Rows, p: Mapping[str, float], state: State, rounds: int, watched: bool) -> State:
    """Add up to ``rounds`` trees to a state whose margins ``rows`` hold; updates the margins."""
    fit = np.flatnonzero(~rows.held)
    part = np.flatnonzero(rows.held) if watched else fit
    codes, y, w, number = np.asfortranarray(rows.codes), rows.y[fit], rows.w[fit], rows.number[fit]
    g, h = np.zeros(len(rows.y)), np.zeros(len(rows.y))
    for _ in range(rounds):
        if state.ended or len(state.trees) >= p["rounds"]:
            state.ended = True
            break
        r = len(state.trees)
        g[fit], h[fit] = slopes(rows.margin[fit], y, w)
        use = np.zeros(len(rows.y), bool)
        use[fit[drawn_rows(number, p, r)]] = True
        grown = Growing(p, codes.shape[1], r)
        at, others = {0: np.flatnonzero(use)}, {0: np.flatnonzero(~use)}
        while not grown.done():
            held = [at[n] for n in grown.counted]
            own, node = np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held])
            grown.split(histogram(codes, node, len(held), g[own], h[own], own, grown.which))
            divide(grown.tree, codes, at)
        divide(grown.tree, codes, others)
        for leaves in (at, others):
            for n, own in leaves.items():
                rows.margin[own] += grown.tree.value[n]
        state.trees.append(grown.tree)
        total = loss_sums(rows.margin[part], rows.y[part], rows.w[part])
        state.losses.append(float(total[0] / max(total[1], _EPS)))
        state.ended = watched and best_round(state.losses, int(p["patience"]))[1]
    return state


_BLOCK = {"number": np.int64, "codes": np.uint8, "y": np.float64, "w": np.float64, "margin": np.float64, "held": np.uint8}


# ---- one task, rows in files -----------------------------------------------------------------------
def _mapped(file, kind, shape) -> np.ndarray:
    return np.asarray(np.memmap(file, kind, "r+", shape=shape)) if shape[0] else np.zeros(shape, kind)


class Filed:
    """Binned rows in files of the task that end with it, so that a table of any size needs little memory.

    They are read and written in parts of PART rows; ``parts`` maps them as ``Rows``.
    """

    def __init__(self, width: int):
        self.width, self.n, self.waiting, self.short = width, 0, [], 0
        self.files = {c: tempfile.TemporaryFile() for c in ("number", "codes", "y", "w", "margin")}

    def add(self, rows: Rows) -> None:
        if len(rows.y):
            self.waiting.append(rows)
            self.short += len(rows.y)
        while self.short >= PART:
            self._write(PART)

    def end(self) -> None:
        if self.short:
            self._write(self.short)
        for file in self.files.values():
            file.flush()

    def _write(self, n: int) -> None:
        rows = together(iter(self.waiting))
        for c, file in self.files.items():
            own = getattr(rows, c)[:n]
            file.write((own.T if c == "codes" else own).tobytes())  # codes by feature within a part
        self.n += n
        rest = Rows(*[getattr(rows, c)[n:] for c in _BLOCK])
        self.waiting, self.short = [rest] if len(rest.y) else [], len(rest.y)

    def column(self) -> list[np.ndarray]:
        """A new column of numbers, all 0, by part."""
        file = tempfile.TemporaryFile()
        file.truncate(8 * self.n)
        whole = _mapped(file, np.float64, (self.n,))
        return [whole[a : a + PART] for a in range(0, self.n, PART)]

    def parts(self) -> list[Rows]:
        flat = {c: _mapped(f, _BLOCK[c], (self.n * (self.width if c == "codes" else 1),)) for c, f in self.files.items()}
        out = []
        for a in range(0, self.n, PART):
            b = min(a + PART, self.n)
            codes = flat["codes"][a * self.width : b * self.width].reshape(self.width, b - a).T
            out.append(Rows(flat["number"][a:b], codes, flat["y"][a:b], flat["w"][a:b], flat["margin"][a:b], np.zeros(0, bool)))
        return out


def filed(blocks: Iterator[Rows]) -> tuple[Filed, Filed, np.ndarray]:
    """Rows to fit on, held rows, and each feature's largest bin but NULL."""
    fit = held = top = None
    for rows in blocks:
        if fit is None:
            width = rows.codes.shape[1]
            fit, held, top = Filed(width), Filed(width), np.zeros(width, np.uint8)
        top = np.maximum(top, np.where(rows.codes == NULL, 0, rows.codes).max(axis=0, initial=0))
        for to, at in ((fit, np.flatnonzero(~rows.held)), (held, np.flatnonzero(rows.held))):
            to.add(Rows(*[getattr(rows, c)[at] for c in _BLOCK]))
    if fit is None:
        fit, held, top = Filed(0), Filed(0), np.zeros(0, np.uint8)
    fit.end()
    held.end()
    return fit, held, top


def bundles(sizes: Sequence[int], most: int) -> list[list[int]]:
    """Places of features by size, put together while the product of their sizes is not above ``most``."""
    out, cells = [], most + 1
    for i in np.argsort(sizes, kind="stable").tolist():
        if cells * sizes[i] > most:
            out.append([])
            cells = 1
        out[-1].append(i)
        cells *= sizes[i]
    return out


def bundled_histogram(parts: Sequence[Rows], at: Sequence[dict[int, np.ndarray]], counted: Sequence[int], slope: Sequence[tuple[np.ndarray, np.ndarray]], which: Sequence[int], top: np.ndarray) -> np.ndarray:
    """``histogram`` of the rows that the counted nodes hold in all parts; ``top`` is the largest bin of each feature but NULL.

    Features are counted together, as one feature with a bin per combination of theirs, and
    the sums of each are read off the joint ones, which are few: nodes x bins within CELLS.
    """
    nodes, sizes = len(counted), [int(top[f]) + 2 for f in which]
    groups = bundles(sizes, max(BINS, CELLS // nodes))
    wide = [math.prod(sizes[i] for i in g) for g in groups]
    sums = [np.zeros((3, nodes * c)) for c in wide]
    for rows, mine, (g, h) in zip(parts, at, slope, strict=True):
        held = [mine[n] for n in counted]
        own, node = np.concatenate(held).astype(np.int64), np.repeat(np.arange(nodes), [len(x) for x in held])
        if not len(own):
            continue
        weights = (g[own], h[own], None)
        for group, cells, total in zip(groups, wide, sums, strict=True):
            code = None
            for i in group:
                c = np.minimum(rows.codes[:, which[i]].take(own), sizes[i] - 1)  # NULL is the last one
                code = c if code is None else code.astype(np.uint32) * np.uint32(sizes[i]) + c
            cell = node * cells
            cell += code
            for k, w in enumerate(weights):
                total[k] += np.bincount(cell, w, nodes * cells)
    out = np.zeros((nodes, len(which), BINS, 3))
    for group, total in zip(groups, sums, strict=True):
        joint = total.reshape(3, nodes, *[sizes[i] for i in group])
        for j, i in enumerate(group):
            own = np.moveaxis(joint.sum(axis=tuple(k for k in range(2, joint.ndim) if k != j + 2)), 0, 2)
            out[:, i, : sizes[i] - 1], out[:, i, NULL] = own[:, :-1], own[:, -1]
    return out


def grow_filed(fit: Filed, held: Filed, top: np.ndarray, p: Mapping[str, float]) -> tuple[State, float]:
    """All rounds on rows in files, stopped by the loss of the held ones, and the average precision of these at the best round.

    The trees are those of ``grow_rounds`` but for the order of sums.
    """
    state, parts, judged = State(), fit.parts(), held.parts()
    slope, best = list(zip(fit.column(), fit.column(), strict=True)), held.column()
    drawn: list[np.ndarray] = []
    while not state.ended and len(state.trees) < p["rounds"]:
        r = len(state.trees)
        if r % int(p["subsample_every"]) == 0:
            drawn = [drawn_rows(rows.number, p, r) for rows in parts]
        for rows, (g, h) in zip(parts, slope, strict=True):
            g[:], h[:] = slopes(rows.margin, rows.y, rows.w)
        grown = Growing(p, fit.width, r)
        at = [{0: np.flatnonzero(use).astype(np.int32)} for use in drawn]
        while not grown.done():
            grown.split(bundled_histogram(parts, at, grown.counted, slope, grown.which, top))
            for rows, mine in zip(parts, at, strict=True):
                divide(grown.tree, rows.codes, mine)
        for rows, mine, use in zip(parts, at, drawn, strict=True):
            others = {0: np.flatnonzero(~use).astype(np.int32)}
            divide(grown.tree, rows.codes, others)
            for leaves in (mine, others):
                for n, own in leaves.items():
                    rows.margin[own] += grown.tree.value[n]
        state.trees.append(grown.tree)
        total = np.zeros(2)
        for rows in judged:
            grown.tree.add_margins(rows.codes, rows.margin)
            total += loss_sums(rows.margin, rows.y, rows.w)
        state.losses.append(float(total[0] / max(total[1], _EPS)))
        at_best, state.ended = best_round(state.losses, int(p["patience"]))
        if at_best == len(state.losses):
            for rows, kept in zip(judged, best, strict=True):
                kept[:] = rows.margin
    return state, precision_of_parts([rows.y for rows in judged], best)


def precision_of_parts(y: Sequence[np.ndarray], score: Sequence[np.ndarray]) -> float:
    """``average_precision`` of parts, which are sorted in place and read range by range, best scores first."""
    edges = [-math.inf]
    for labels, s in zip(y, score, strict=True):
        order = np.argsort(s, kind="stable")
        s[:], labels[:] = s[order], labels[order]
        edges.extend(s[PART // 16 :: PART // 16].tolist())
    edges = [*sorted(set(edges))[::16], math.inf]  # ranges of about PART rows, if no score is common
    seen, hits, out = 0, 0, 0.0
    for low, high in zip(edges[-2::-1], edges[:0:-1], strict=True) if y else ():
        cut = [slice(*np.searchsorted(s, (low, high), side="left").tolist()) for s in score]
        own, s = np.concatenate([a[c] for a, c in zip(y, cut, strict=True)]), np.concatenate([a[c] for a, c in zip(score, cut, strict=True)])
        order = np.argsort(-s, kind="stable")
        own, s = own[order], s[order]
        last = np.flatnonzero(np.append(s[1:] != s[:-1], True)) if len(s) else np.zeros(0, int)
        gained = np.cumsum(own == 1)[last]
        out += float((np.diff(gained, prepend=0) * (hits + gained) / (seen + last + 1)).sum())
        seen, hits = seen + len(s), hits + int((own == 1).sum())
    return out / hits if hits else 0.0


# ---- tables --------------------------------------------------------------------------------------
def cut_points(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """At most BINS - 2 cuts per feature, at quantiles; a value goes to the first bin whose cut is not below it."""
    shares = [k / (BINS - 1) for k in range(1, BINS - 1)]
    cells = [F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), shares, 10000).alias(f"q{i}") for i, c in enumerate(features)]
    row = df.agg(*cells).first()
    return [sorted(set(q or [])) for q in row]


def binned(df: DataFrame, features: Sequence[str], cuts: list[list[float]], target: str, weight: str, held: str) -> DataFrame:
    """Table of blocks of STEP rows (number, codes, y, w, held and margin as binary) over all rows of ``df``, settled."""
    have = set(df.columns)
    x = [(F.col(c).cast("double") if c in have else F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(features)]
    base = df.select(*x, F.col(target).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), F.col(held).cast("boolean").alias("held"))
    base = base.withColumn("number", F.xxhash64("y", *[f"x{i}" for i in range(len(features))]))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                codes = np.empty((part.num_rows, len(features)), np.uint8)
                for i, own in enumerate(cuts):
                    v = part.column(i).to_numpy(zero_copy_only=False).astype(float)
                    codes[:, i] = np.where(np.isnan(v), NULL, np.searchsorted(own, v, side="left"))
                n = part.column("number").to_numpy(zero_copy_only=False).astype(np.int64)
                y, w = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("y", "w"))
                out = part.column("held").to_numpy(zero_copy_only=False).astype(np.uint8)
                blobs = [x.tobytes() for x in (n, codes.T, y, w, np.zeros(len(n)), out)]  # codes by feature
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], names=list(_BLOCK))

    # Small groups of rows, as a reader holds one at a time and a search has a reader on every core.
    return settle(base.mapInArrow(run, ", ".join(f"{c} binary" for c in _BLOCK)), **{"parquet.block.size": 8 << 20})


def unpack(batch) -> Iterator[Rows]:
    """Rows of every block."""
    for row in batch.to_pylist():
        yield _rows(row)


def _rows(row: Mapping[str, bytes]) -> Rows:
    a = {c: np.frombuffer(row[c], kind) for c, kind in _BLOCK.items()}
    n = len(a["number"])
    return Rows(a["number"], a["codes"].reshape(-1, n).T, a["y"], a["w"], a["margin"].copy(), a["held"].astype(bool))


def together(blocks: Iterator[Rows]) -> Rows | None:
    parts = list(blocks)
    if not parts:
        return None
    number, y, w, margin, held = (np.concatenate([getattr(b, c) for b in parts]) for c in ("number", "y", "w", "margin", "held"))
    return Rows(number, np.concatenate([b.codes.T for b in parts], axis=1).T, y, w, margin, held)


def _task_rounds(table: DataFrame, p: Mapping[str, float], trees: list[Tree], losses: list[float], rounds: int, watched: bool) -> State:
    """Rounds of a table that one task may hold: one job."""

    def run(batches):
        rows = together(r for b in batches for r in unpack(b))
        if rows is None:
            return
        order = np.argsort(rows.number, kind="stable")
        rows = Rows(*[getattr(rows, c)[order] for c in ("number", "codes", "y", "w", "margin", "held")])
        rows.codes = np.asfortranarray(rows.codes)
        for t in trees:
            t.add_margins(rows.codes, rows.margin)
        state = grow_rounds(rows, p, State(list(trees), list(losses)), rounds, watched)
        new = json.dumps([asdict(t) for t in state.trees[len(trees) :]])
        yield pa.RecordBatch.from_pydict({"trees": [new], "losses": [state.losses], "ended": [state.ended]})

    out = table.coalesce(1).mapInArrow(run, "trees string, losses array<double>, ended boolean").collect()
    if not out:
        return State(list(trees), list(losses), True)
    return State([*trees, *[Tree(**t) for t in json.loads(out[0]["trees"])]], list(out[0]["losses"]), out[0]["ended"])


def added(df: DataFrame, size: int) -> np.ndarray:
    """Sum of the float arrays that tasks return, one each; many of them are added in rows of tasks first."""

    def add(batches):
        total = None
        for batch in batches:
            for blob in batch.column("sums"):
                part = np.frombuffer(blob.as_py(), np.float64)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    n = df.rdd.getNumPartitions()
    if n > 16:
        df = df.repartition(math.isqrt(n)).mapInArrow(add, "sums binary")
    parts = [np.frombuffer(r["sums"], np.float64) for r in df.collect()]
    return np.sum(parts, axis=0) if parts else np.zeros(size)


def in_partitions(table: DataFrame, size: int) -> tuple[RDD, RDD]:
    """Arrays of the rows to fit on and of the held ones, dealt to even partitions in Spark's cache.

    A level's job reads them without planning or decoding anything; only a tree's first level needs the held ones.
    """
    wide = max(table.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TOGETHER))
    blocks = table.select(*_BLOCK).repartition(wide).rdd.map(_rows)

    def pack(want: bool):
        def run(blocks):
            rows = together(b for b in blocks if (b.held == want).any())
            if rows is not None:
                at = np.flatnonzero(rows.held == want)
                yield Rows(rows.number[at], np.asfortranarray(rows.codes[at]), rows.y[at], rows.w[at], rows.margin[at], rows.held[at])

        return run

    return tuple(blocks.mapPartitions(pack(want)).persist(StorageLevel.MEMORY_AND_DISK) for want in (False, True))


def _spread_rounds(blocks: tuple[RDD, RDD], p: Mapping[str, float], trees: list[Tree], losses: list[float], rounds: int, watched: bool, width: int) -> State:
    """Rounds of a table of any size: one job per level. Margins in ``blocks`` hold ``trees``.

    The first level of a tree reads rows to whose margins the tree before it is added, and
    keeps them in the cache, so a tree is followed by every row once.
    """
    state, now = State(list(trees), list(losses)), blocks
    sc = blocks[0].context

    def level(grown: Growing | None) -> np.ndarray:
        """Loss sums of the trees so far, by the first level of a tree only, and the counted nodes' histograms."""
        tree, counted, which = (grown.tree, grown.counted, grown.which) if grown else (Tree(), [], [])
        r, nodes, judge = len(state.trees), len(counted), grown is None or grown.depth == 0
        size = nodes * len(which) * BINS * 3 + 2

        def run(parts):
            total = np.zeros(size)
            for rows in parts:
                if judge:
                    own = np.flatnonzero(rows.held == watched)
                    total[:2] += loss_sums(rows.margin[own], rows.y[own], rows.w[own])
                use = np.flatnonzero(~rows.held & drawn_rows(rows.number, p, r)) if nodes and not rows.held.all() else []
                if len(use):
                    at = {0: use}
                    divide(tree, rows.codes, at)
                    mine = [at[n] for n in counted]
                    own, node = np.concatenate(mine), np.repeat(np.arange(nodes), [len(x) for x in mine])
                    g, h = slopes(rows.margin[own], rows.y[own], rows.w[own])
                    total[2:] += histogram(rows.codes, node, nodes, g, h, own, which).ravel()
            yield total

        use = sc.union(list(now)) if judge and watched else now[0]
        sums = use.mapPartitions(run)
        parts = sums.collect() if use.getNumPartitions() <= 32 else [sums.treeReduce(np.add)]
        return np.sum(parts, axis=0) if parts else np.zeros(size)

    def note(sums) -> None:
        """The loss of the trees so far comes with the first level of the next one."""
        if len(state.losses) < len(state.trees):
            state.losses.append(float(sums[0] / max(sums[1], _EPS)))
            state.ended = watched and best_round(state.losses, int(p["patience"]))[1]

    before: tuple[RDD, ...] = ()
    for _ in range(rounds):
        if len(state.trees) >= p["rounds"]:
            state.ended = True
            break
        grown = Growing(p, width, len(state.trees))
        while not grown.done():
            sums = level(grown)
            for b in before:  # their successors are in the cache now
                b.unpersist()
            before = ()
            note(sums)
            if state.ended:
                break
            grown.split(sums[2:].reshape(len(grown.counted), len(grown.which), BINS, 3))
        if state.ended:
            break
        state.trees.append(grown.tree)
        before, now = (*before, *now), tuple(b.map(_followed(grown.tree)).persist(StorageLevel.MEMORY_AND_DISK) for b in now)
    if not state.ended or len(state.losses) < len(state.trees):
        note(level(None))
    for b in (*before, *now):
        b.unpersist()
    return state


def _followed(tree: Tree):
    """Adds a tree to the margins of a block."""

    def run(rows: Rows) -> Rows:
        margin = rows.margin.copy()
        tree.add_margins(rows.codes, margin)
        return replace(rows, margin=margin)

    return run


def boost(table: DataFrame, width: int, p: Mapping[str, float], watched: bool, run_path: str | None = None, spread: bool | None = None) -> State:
    """Fit trees on a binned table, and go on from what ``run_path`` holds; ``spread`` overrides the choice by size."""
    size = table.agg(F.sum(F.length("codes") + 33 * F.length("held"))).first()[0] or 0
    spread = size > TOGETHER if spread is None else spread
    spark, state, since = table.sparkSession, State(), 0
    if run_path:
        state = load_state(spark, run_path) or state
    while not state.ended and len(state.trees) < p["rounds"]:
        if spread:
            if len(state.trees) > since:
                table, since = _moved(table, state.trees[since:]), len(state.trees)
            state = _spread_rounds(in_partitions(table, size), p, state.trees, state.losses, EVERY, watched, width)
        else:
            state = _task_rounds(table, p, state.trees, state.losses, EVERY, watched)
        if run_path:
            save_state(spark, run_path, state)
    return state


def _moved(table: DataFrame, trees: list[Tree]) -> DataFrame:
    """The table with margins that hold ``trees`` too, settled."""
    shared = table.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            margins = []
            for rows in unpack(batch):
                for t in shared.value:
                    t.add_margins(rows.codes, rows.margin)
                margins.append(rows.margin.tobytes())
            at = batch.schema.get_field_index("margin")
            yield pa.RecordBatch.from_arrays([pa.array(margins, pa.binary()) if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return settle(table.mapInArrow(run, ", ".join(f"{c} binary" for c in _BLOCK)))


def save_state(spark: SparkSession, path: str, state: State) -> None:
    """A folder per state, named by its number of trees; the latest complete one counts."""
    rows = [(json.dumps([asdict(t) for t in state.trees]), state.losses, state.ended)]
    spark.createDataFrame(rows, "trees string, losses array<double>, ended boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/state/rounds={len(state.trees)}")


def load_state(spark: SparkSession, path: str) -> State | None:
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.parquet(f"{path}/state").orderBy(F.desc("rounds")).first()
    except AnalysisException:  # no state yet
        return None
    return State([Tree(**t) for t in json.loads(row["trees"])], list(row["losses"]), row["ended"]) if row else None


# ---- search --------------------------------------------------------------------------------------
def average_precision(y: np.ndarray, score: np.ndarray) -> float:
    """Area under the precision-recall steps; rows of one score count together."""
    if not (y == 1).any():
        return 0.0
    order = np.argsort(-score, kind="stable")
    y, score = y[order], score[order]
    last = np.flatnonzero(np.append(score[1:] != score[:-1], True))
    hits = np.cumsum(y == 1)[last]
    return float((np.diff(hits, prepend=0) / hits[-1] * hits / (last + 1)).sum())


def search(table: DataFrame, trials: Sequence[Mapping[str, float]], path: str) -> DataFrame:
    """(trial, rounds, loss, auc_pr) of every setting, fitted with full rounds and patience.

    All rows of the table take part. Each setting is a job of one task and a folder in ``path``
    as soon as it ends: no core waits for the longest of a group, and a search that starts again
    there only runs what is missing. Of a table within ``TOGETHER`` bytes all tasks share one
    copy in memory; of a larger one every task writes its rows to files of its own.
    """
    from pyspark.errors import AnalysisException

    spark = table.sparkSession

    def found() -> DataFrame:
        return spark.read.schema("rounds int, loss double, auc_pr double, trial int").parquet(f"{path}/trials")

    done: set[int] = set()
    try:
        done = {r["trial"] for r in found().select("trial").collect()}
    except AnalysisException:  # a new search
        pass
    missing = [(i, json.dumps(dict(p))) for i, p in enumerate(trials) if i not in done]
    if missing:
        size = table.agg(F.sum(F.length("codes") + 33 * F.length("held"))).first()[0] or 0
        shared = None if size > TOGETHER else spark.sparkContext.broadcast([r.asDict() for r in table.collect()])

        def result(i: int, p: Mapping[str, float], state: State, ap: float) -> pa.RecordBatch:
            best = state.best(int(p["patience"]), True)
            return pa.RecordBatch.from_pydict({"trial": pa.array([i], pa.int32()), "rounds": pa.array([best], pa.int32()), "loss": pa.array([state.losses[best - 1] if best else None], pa.float64()), "auc_pr": pa.array([ap], pa.float64())})

        def run(batches):
            for batch in batches:
                for i, setting in zip(batch.column("trial").to_pylist(), batch.column("setting").to_pylist(), strict=True):
                    p = json.loads(setting)
                    rows = together(unpack(pa.RecordBatch.from_pylist(shared.value))) if shared.value else None
                    state, ap = State(), 0.0
                    if rows is not None:
                        start = rows.margin.copy()
                        state = grow_rounds(rows, p, state, int(p["rounds"]), True)
                        margin = start[rows.held]
                        codes = rows.codes[rows.held]
                        for t in state.trees[: state.best(int(p["patience"]), True)]:
                            margin = margin + t.margins(codes)
                        ap = average_precision(rows.y[rows.held], margin)
                    yield result(i, p, state, ap)

        def run_filed(trial: tuple[int, str]):
            def run(batches):
                p = json.loads(trial[1])
                yield result(trial[0], p, *grow_filed(*filed(r for b in batches for r in unpack(b)), p))

            return run

        def fitted(trial: tuple[int, str]) -> None:
            if shared is None:
                rows, job = table.coalesce(1), run_filed(trial)
            else:
                rows, job = spark.createDataFrame([trial], "trial int, setting string").coalesce(1), run
            rows.mapInArrow(job, "trial int, rounds int, loss double, auc_pr double").drop("trial").write.mode("overwrite").parquet(f"{path}/trials/trial={trial[0]}")

        # As many at a time as there are cores; small steps and deep trees first, so that no long one is left to the end.
        order = sorted(missing, key=lambda m: (trials[m[0]]["step_size"] / trials[m[0]]["max_depth"], m[0]))
        pool = ThreadPoolExecutor(min(len(order), spark.sparkContext.defaultParallelism))
        try:
            for job in [pool.submit(inheritable_thread_target(spark)(fitted), m) for m in order]:
                job.result()
        finally:
            pool.shutdown(cancel_futures=True)
        if shared is not None:
            shared.unpersist()
    return found().select("trial", "rounds", "loss", "auc_pr")


# ---- models --------------------------------------------------------------------------------------
@dataclass
class BoostedTrees:
    """Fitted trees with the cuts that turn values into bins; NULL and NaN are one bin."""

    cuts: list[list[float]]
    trees: list[Tree]
    losses: list[float]

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.where(np.isnan(x[:, i]), NULL, np.searchsorted(own, x[:, i], side="left")) for i, own in enumerate(self.cuts)], axis=1).astype(np.uint8) if len(self.cuts) else np.zeros((len(x), 0), np.uint8)

    def margins(self, x: np.ndarray) -> np.ndarray:
        codes, out = np.asfortranarray(self.codes(x)), np.zeros(len(x))
        for t in self.trees:
            t.add_margins(codes, out)
        return out

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - as Spark's ensembles name it
        return len(self.trees)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(json.dumps(self.cuts), json.dumps([asdict(t) for t in self.trees]), self.losses)]
        spark.createDataFrame(rows, "cuts string, trees string, losses array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        row = spark.read.parquet(path).first()
        return BoostedTrees(json.loads(row["cuts"]), [Tree(**t) for t in json.loads(row["trees"])], list(row["losses"]))
