"""Regression trees with exact splits, grown inside tasks on a bounded sample.

A forest is spread over tasks by its trees: a task has all sampled rows, whose number the
caller caps, and grows some trees of one fit. Fits of a cross-validation are further tasks
on the same rows. Nothing here knows Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = -1


@dataclass(frozen=True)
class Tree:
    """Nodes in the order of their levels; children of a node are ``left`` and ``left + 1``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gains: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """One value per column of ``x`` (inputs by rows); what is missing goes right."""
        at = np.zeros(x.shape[1], np.int64)
        moving = np.arange(x.shape[1])
        while True:
            moving = moving[self.feature[at[moving]] != LEAF]
            if not len(moving):
                return self.value[at]
            node = at[moving]
            goes_left = x[self.feature[node], moving] <= self.cut[node]
            at[moving] = self.left[node] + np.where(goes_left, 0, 1)


def _between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The middle, or ``low`` where no number lies between."""
    middle = low / 2 + high / 2
    return np.where((middle < high) & (middle >= low), middle, low)


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int) -> Tree:
    """Tree of least squared error on ``x`` (inputs by rows); ``weight`` counts each row.

    Every input is sorted once. A level looks at all cuts of all its nodes by running sums,
    then parts the sorted rows of each node stably, so that no level sorts again. A node is
    split while it holds different targets and a cut exists, down to ``depth``.
    """
    used = np.flatnonzero(weight)
    x, y, weight = x[:, used], y[used], weight[used].astype(np.float64)
    inputs, rows = x.shape
    shift = np.average(y, weights=weight) if rows else 0.0
    y = y - shift
    mass = weight * y
    gains = np.zeros(inputs)
    levels: list[tuple[np.ndarray, ...]] = []
    order = np.argsort(x, axis=1, kind="stable").astype(np.int32)
    sizes = np.array([rows])
    nodes = 0
    for level in range(depth + 1):
        count = len(sizes)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        first = order[0]
        total_w = np.add.reduceat(weight[first], starts) if rows else np.zeros(1)
        total_y = np.add.reduceat(mass[first], starts) if rows else np.zeros(1)
        value = total_y / np.maximum(total_w, 1) + shift
        feature, cut = np.full(count, LEAF, np.int16), np.zeros(count)
        left = np.zeros(count, np.int32)
        levels.append((feature, cut, left, value))
        nodes += count
        if level == depth or not rows:
            break
        mixed = np.minimum.reduceat(y[first], starts) < np.maximum.reduceat(y[first], starts)
        # Rows of finished nodes leave all orders at once: nodes own the same places in each.
        stay = np.repeat(mixed, sizes)
        open_nodes = np.flatnonzero(mixed)
        order, sizes = order[:, stay], sizes[mixed]
        if not len(open_nodes):
            break
        best, which, place, low, high = _best_cuts(x, weight, mass, order, sizes, total_w[mixed], total_y[mixed])
        can = np.isfinite(best)
        keep = np.repeat(can, sizes)
        ends = np.cumsum(sizes)
        counts_left = (place + 1 - (ends - sizes))[can]
        open_nodes, order, sizes, which = open_nodes[can], order[:, keep], sizes[can], which[can]
        if not len(open_nodes):
            break
        feature[open_nodes] = which
        cut[open_nodes] = _between(low[can], high[can])
        left[open_nodes] = nodes + 2 * np.arange(len(open_nodes))
        plain = total_y[mixed][can] ** 2 / total_w[mixed][can]
        np.add.at(gains, which, np.maximum(best[can] - plain, 0))
        order, sizes = _parted(x, order, sizes, which, cut[open_nodes], counts_left)
        rows = order.shape[1]
    feature, cut, left, value = (np.concatenate(part) for part in zip(*levels, strict=True))
    return Tree(feature, cut, left, value, gains)


def _best_cuts(x, weight, mass, order, sizes, total_w, total_y) -> tuple[np.ndarray, ...]:
    """Score, input, place, and the values on both sides of the best cut of each node."""
    rows = order.shape[1]
    node = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    scores = np.full(order.shape, -np.inf)
    same_node = node[:-1] == node[1:]
    all_w, all_y = total_w[node], total_y[node]
    for i, places in enumerate(order):
        values = x[i, places]
        allowed = np.flatnonzero(same_node & (values[:-1] < values[1:]))
        if not len(allowed):
            continue
        run_w, run_y = np.cumsum(weight[places]), np.cumsum(mass[places])
        before_w = np.where(starts > 0, run_w[starts - 1], 0.0)
        before_y = np.where(starts > 0, run_y[starts - 1], 0.0)
        own = node[allowed]
        left_w, left_y = run_w[allowed] - before_w[own], run_y[allowed] - before_y[own]
        right_w, right_y = all_w[allowed] - left_w, all_y[allowed] - left_y
        scores[i, allowed] = left_y**2 / left_w + right_y**2 / right_w
    per_input = np.maximum.reduceat(scores, starts, axis=1)
    which = per_input.argmax(axis=0)
    best = per_input[which, np.arange(len(sizes))]
    hits = np.flatnonzero((scores[which[node], np.arange(rows)] == best[node]) & np.isfinite(best[node]))
    place = starts.copy()
    owners, firsts = np.unique(node[hits], return_index=True)
    place[owners] = hits[firsts]
    after = np.minimum(place + 1, rows - 1)
    return best, which, place, x[which, order[which, place]], x[which, order[which, after]]


def _parted(x, order, sizes, which, cut, counts_left) -> tuple[np.ndarray, np.ndarray]:
    """Orders with the left rows of each node before its right ones, and the sizes of both."""
    node = np.repeat(np.arange(len(sizes)), sizes)
    goes_left = np.zeros(x.shape[1], bool)
    goes_left[order[0]] = x[which[node], order[0]] <= cut[node]
    halves = np.column_stack([counts_left, sizes - counts_left]).reshape(-1)
    is_left = np.repeat(np.arange(len(halves)) % 2 == 0, halves)
    out = np.empty_like(order)
    for i, places in enumerate(order):
        left = goes_left[places]
        out[i, is_left] = places[left]
        out[i, ~is_left] = places[~left]
    return out, halves


def bootstrap(rows: int, chosen: np.ndarray, seed: tuple[int, ...]) -> np.ndarray:
    """How often each row is drawn, with replacement, from the ``chosen`` ones."""
    draws = np.random.default_rng(seed).integers(0, len(chosen), len(chosen)) if len(chosen) else chosen
    return np.bincount(chosen[draws], minlength=rows)
