"""Small gradient-boosted trees, fitted on all rows of a Spark table.

Logistic loss, features cut at exact quantiles, second-order gains.  The rows stay on Spark: every level of a tree
is one job, in which each partition sums its gradients by (node, feature, bin) in numpy and Spark adds the
sums up, so the driver sees one histogram of fixed size a level.  Gradients are summed as whole numbers
(``UNIT`` of them make one), so the trees do not depend on partitions or order.  The fitted model is a few kilobytes
and goes to the executors in the closure of the scoring function.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common
from riskhouse.operators.ordered import running

#: Whole numbers that stand for a gradient of 1, rows of a partition about, rounds after which the rows' margins are
#: kept, and histograms that are added up at once.
UNIT, PART, KEPT, MOST = 1 << 30, 50_000, 10, 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BoostedTrees:
    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, cuts: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.cuts, self.ridge = rounds, depth, rate, cuts, ridge
        self.base, self.trees = 0.0, []

    def fit(self, rows: DataFrame, width: int) -> BoostedTrees:
        """rows: x (array of ``width`` numbers), label (0 or 1) and n, the number of rows it stands for; both labels occur."""
        rows = rows.select("x", "label", "n")
        self.edges = self._quantiles(rows, width)
        total = rows.agg(F.sum("n"), F.sum(F.col("label") * F.col("n"))).first()
        share = np.clip(total[1] / total[0], 0.001, 0.999)
        self.base = float(np.log(share / (1 - share)))
        rows = _spread(rows.withColumn("raw", F.lit(self.base)))
        self.parts = rows.rdd.getNumPartitions()
        for k in range(self.rounds):
            if k and k % KEPT == 0:
                rows = common.shared_checkpoint(self._with_raw(rows, self.trees[k - KEPT :]))
            self.trees.append(self._grow(rows, self.trees[k - k % KEPT :]))
        return self

    def _quantiles(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        """Distinct ``cuts`` - 1 inner quantiles of each feature, between the two rows around each, over all rows."""
        values = rows.select(F.posexplode("x").alias("j", "v"), "n").groupBy("j", F.col("v").cast("double").alias("v")).agg(F.sum("n").alias("n"))
        n = rows.agg(F.sum("n")).first()[0]
        at = np.linspace(0, 1, self.cuts)[1:-1] * (n - 1)
        low = np.floor(at).astype(np.int64)
        wanted = F.array(*[F.lit(int(r)) for r in sorted({*low, *np.minimum(low + 1, n - 1)})])
        held = running(values, ["j"], ["v"], F.col("n"), "before")
        held = held.where(F.exists(wanted, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))))
        found = held.select("j", "v", "before").orderBy("j", "v").toPandas()  # two rows a quantile and feature at most
        edges = []
        for j in range(width):
            own = found[found["j"] == j]
            v, before = own["v"].to_numpy(), own["before"].to_numpy()
            a, b = (v[np.searchsorted(before, r, "right") - 1] for r in (low, np.minimum(low + 1, n - 1)))
            edges.append(np.unique(a + (b - a) * (at - low)))
        return edges

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def _with_raw(self, rows: DataFrame, trees: list) -> DataFrame:
        """rows with the outputs of ``trees`` added to their margin ``raw``."""
        width = len(self.edges)

        def run(batches):
            for batch in batches:
                b = self._binned(_matrix(batch.column("x"), width))
                raw = batch.column("raw").to_numpy() + sum((self._walk(t, b) for t in trees), np.zeros(len(b)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(raw)], names=["x", "label", "n", "raw"])

        return common.map_arrow(rows, run, rows.schema)

    def _grow(self, rows: DataFrame, since: list) -> list[tuple[int, int, float]]:
        """A full binary tree as a heap of (feature, cut, value); feature -1 is a leaf.  ``since``: trees that ``raw`` does not hold yet."""
        tree = [(-1, 0, 0.0)] * (2 ** (self.depth + 1) - 1)
        sums: dict[int, tuple[float, float]] = {}
        for level in range(self.depth):
            nodes = [k for k in range(2**level - 1, 2 ** (level + 1) - 1) if level == 0 or k in sums]
            if not nodes:
                break
            hist = self._histogram(rows, since, tree, level, nodes)
            for k, own in zip(nodes, hist, strict=True):
                gs, hs = own[:, 0].sum(axis=1) / UNIT  # every feature's bins hold all rows of the node
                best = (1e-6, -1, 0)
                for j, edges in enumerate(self.edges):
                    if len(edges):
                        g, h = np.cumsum(own[:, j, : len(edges)], axis=1) / UNIT
                        gain = g**2 / (h + self.ridge) + (gs - g) ** 2 / (hs - h + self.ridge) - gs**2 / (hs + self.ridge)
                        at = int(gain.argmax())
                        if gain[at] > best[0]:
                            best, left = (float(gain[at]), j, at), (float(g[at]), float(h[at]))
                tree[k] = (best[1], best[2], self._value(gs, hs))
                if best[1] >= 0:
                    for child, (g, h) in ((2 * k + 1, left), (2 * k + 2, (gs - left[0], hs - left[1]))):
                        sums[child], tree[child] = (g, h), (-1, 0, self._value(g, h))
        return tree

    def _value(self, g: float, h: float) -> float:
        return float(-self.rate * g / (h + self.ridge))

    def _histogram(self, rows: DataFrame, since: list, tree: list, level: int, nodes: list[int]) -> np.ndarray:
        """(node, gradient or second derivative, feature, bin): sums over all rows, in UNITs."""
        width, bins = len(self.edges), self.cuts
        place = np.full(len(tree), -1)
        place[nodes] = np.arange(len(nodes))

        def run(batches):
            total = np.zeros((2, len(nodes) * width * bins), np.int64)
            for batch in batches:
                b = self._binned(_matrix(batch.column("x"), width))
                raw = batch.column("raw").to_numpy() + sum((self._walk(t, b) for t in since), np.zeros(len(b)))
                n, p = batch.column("n").to_numpy(), sigmoid(raw)
                at = place[self._reach(tree, b, level)]
                own = at >= 0
                slot = ((at[:, None] * width + np.arange(width)) * bins + b)[own].ravel()
                for k, v in enumerate((p - batch.column("label").to_numpy(), np.maximum(p * (1 - p), 1e-6))):
                    whole = np.rint(v * UNIT).astype(np.int64) * n
                    np.add.at(total[k], slot, np.repeat(whole[own], width))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        def add(batches):
            yield pa.RecordBatch.from_arrays([pa.array([_added(batches).tobytes()], pa.binary())], names=["sums"])

        parts, most = common.map_arrow(rows, run, "sums binary"), self.parts
        while most > MOST:  # one row a partition, added up on Spark until a few are left
            most = -(-most // MOST)
            parts = common.map_arrow(parts.repartition(most), add, "sums binary")
        out = _added(parts.toArrow().to_batches())
        return out.reshape(2, len(nodes), width, bins).swapaxes(0, 1)

    def _reach(self, tree: list[tuple[int, int, float]], b: np.ndarray, steps: int) -> np.ndarray:
        """The node of each row after so many steps; rows stay in a leaf."""
        at, feature, cut = np.zeros(len(b), np.int64), np.array([t[0] for t in tree]), np.array([t[1] for t in tree])
        for _ in range(steps):
            f = feature[at]
            right = b[np.arange(len(b)), np.maximum(f, 0)] > cut[at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return at

    def _walk(self, tree: list[tuple[int, int, float]], b: np.ndarray) -> np.ndarray:
        return np.array([t[2] for t in tree])[self._reach(tree, b, self.depth)]

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        return sigmoid(self.base + sum((self._walk(t, b) for t in self.trees), np.zeros(len(b))))


def _added(batches) -> np.ndarray:
    """Sum of the histograms in the batches (0 without any)."""
    return sum((np.frombuffer(v, np.int64) for batch in batches for v in batch.column("sums").to_pylist()), np.zeros(1, np.int64))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def _spread(rows: DataFrame) -> DataFrame:
    """rows, kept, in partitions of about PART rows whatever the session's number of shuffle partitions is."""
    parts = -(-rows.count() // PART)
    return common.shared_checkpoint(rows.repartition(max(1, parts)))
