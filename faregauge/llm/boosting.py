"""Gradient-boosted trees on tables of counted vectors, for candidates that a rule proposes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Slopes are added up as integers in steps of this fraction: sums don't depend on their order.
UNIT = float(1 << 24)
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def quantiles(values: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Linear quantiles of sorted ``values`` that occur ``counts`` times."""
    ends = np.cumsum(counts)
    place = shares * (ends[-1] - 1)
    low = values[np.searchsorted(ends, np.floor(place), "right")]
    high = values[np.searchsorted(ends, np.ceil(place), "right")]
    return low + (high - low) * (place - np.floor(place))


@dataclass
class BoostedTrees:
    """Logistic loss, trees of fixed depth, one split per node.

    Trees are stored as arrays (feature, threshold per inner node; value per leaf), so that
    scoring a matrix takes ``depth`` array steps per tree. Growing takes a job per level: tasks
    add up slopes per node, feature and bin, and the driver gets these sums from each.
    """

    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 16
    start: float = 0.0
    grown: list[Tree] = field(default_factory=list)

    def fit(self, rows: DataFrame) -> BoostedTrees:
        """Grow from all stored ``rows``: (x array<int>, n, hits), hits of the n rows being positive."""
        total, hits = (int(v or 0) for v in rows.agg(F.sum("n"), F.sum("hits")).first())
        share = np.clip(hits / total if total else 0.5, 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        if not 0 < hits < total:
            return self
        cuts = self._cuts(rows)
        for _ in range(self.trees):
            self.grown.append(self._grow(rows, cuts))
        return self

    def _cuts(self, rows: DataFrame) -> list[np.ndarray]:
        """Quantiles of each feature, from the counts of its different values."""
        values = rows.select(F.posexplode("x").alias("j", "value"), "n").groupBy("j", "value").agg(F.sum("n").alias("n"))
        found = defaultdict(list)
        for r in values.collect():
            found[r["j"]].append((r["value"], r["n"]))
        shares = np.linspace(0, 1, self.bins + 1)
        return [np.unique(quantiles(*np.array(sorted(found[j])).T, shares))[:-1] for j in sorted(found)]

    def _grow(self, rows: DataFrame, cuts: list[np.ndarray]) -> Tree:
        inner = 2**self.depth - 1
        tree = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(inner + 1)
        for level in range(self.depth):
            first = 2**level - 1
            sums = self._sums(rows, cuts, tree, level)
            for node in range(first + 1):
                tree[0][first + node], tree[1][first + node], sides = self._split(cuts, *sums[:, node])
                if level == self.depth - 1:
                    tree[2][2 * node : 2 * node + 2] = [self.rate * slope / (curve + 1.0) for slope, curve in sides]
        return tree

    def _sums(self, rows: DataFrame, cuts: list[np.ndarray], tree: Tree, level: int) -> np.ndarray:
        """Slopes and curves over all rows, per node of the level, feature and bin."""
        shape = (2, 2**level, len(cuts), self.bins + 1)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, int(np.prod(shape[1:]))), np.int64)
            for batch in batches:
                x, n, hits = matrix(batch.column("x")), batch.column("n").to_numpy(), batch.column("hits").to_numpy()
                p = self.score(x)
                parts = [np.rint(v * UNIT).astype(np.int64) for v in (hits - n * p, n * p * (1 - p))]
                node = self._reached(x, tree, level) - (2**level - 1)
                for j, points in enumerate(cuts):
                    cell = (node * len(cuts) + j) * shape[3] + np.searchsorted(points, x[:, j])
                    for total, part in zip(sums, parts, strict=True):
                        np.add.at(total, cell, part)
            yield pa.RecordBatch.from_pydict({"sums": [sums.reshape(-1)]})

        found = rows.select("x", "n", "hits").mapInArrow(added, "sums array<long>").toArrow()
        return matrix(found.column("sums").combine_chunks()).sum(0).reshape(shape) / UNIT

    def _split(self, cuts, slopes, curves):
        """Feature, threshold, and (slope, curve) of both sides; all rows go left if no split gains."""
        total, weight = slopes[0].sum(), curves[0].sum()
        best, found = 1e-6, (0, np.inf, ((total, weight), (0.0, 0.0)))
        for j, points in enumerate(cuts):
            left, held = (np.cumsum(v[j])[: len(points)] for v in (slopes, curves))
            gain = left**2 / (held + 1) + (total - left) ** 2 / (weight - held + 1) - total**2 / (weight + 1)
            if len(gain) and gain.max() > best:
                at = int(gain.argmax())
                sides = (left[at], held[at]), (total - left[at], weight - held[at])
                best, found = gain[at], (j, points[at], sides)
        return found

    def _reached(self, x: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
        feature, threshold, _ = tree
        node = np.zeros(len(x), int)
        for _ in range(depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        return node

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.start)
        for tree in self.grown:
            raw += tree[2][self._reached(x, tree, self.depth) - len(tree[0])]
        return 1 / (1 + np.exp(-raw))
