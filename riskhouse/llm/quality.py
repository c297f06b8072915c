"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 13).

Each text is described by the statistics of ``NAMES``: shares of kinds of bytes, lengths, repetition of words, word
triples and lines, and how words begin and end; none of them depends on a language.  The trees are
fitted on a bounded sample of labelled rows: about SAMPLE of them, chosen by a hash of the id below a threshold (all of them if
there are no more), so no task sends more than its share.  Values are cut into BINS quantile bins, a leaf's gradients are
summed in one histogram over all statistics, the larger child's is the difference of its parent's and its sibling's, and the leaf of
the greatest gain is split next.  A fifth of the sample takes no part in the fit and sets the number of rounds.  The
fitted trees are flattened into arrays (statistic, cut, children, value), through which numpy walks all trees for all rows of a block
at once; a leaf is its own child.

Edge cases: null and empty texts have all statistics 0 and get the trees' score for that; with no usable labels (none, or of
one class) every score is the share of label 1, 0.0 without any; labels other than 0 and 1 and null ids teach nothing;
several documents of one id and label teach as one; repeated rows are scored alike; an empty table gives an empty result; texts of
any length are read in whole; a column quality_score of the input is replaced, other columns take no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common
from riskhouse.llm.trees import sigmoid

#: Labelled rows that the trees are fitted on, about; bins of a statistic.
SAMPLE, BINS = 20_000, 64
ROUNDS, LEAVES, RATE, RIDGE, LEAST = 200, 12, 0.1, 1.0, 10
#: Rows whose way through all trees is followed at once.
WALK = 2_048

#: Kinds of bytes, in the order of ``_KIND``.
KINDS = ["control", "blank", "newline", "lower", "upper", "digit", "stop", "pause", "quote", "symbol", "high"]
NAMES = [
    *(f"{k}_share" for k in KINDS),
    "log_bytes", "log_words", "log_lines", "word_bytes", "line_words", "upper_of_letters", "kind_entropy",
    "capital_words", "stopped_words", "symbol_words", "upper_pairs", "short_words",
    "distinct_words", "top_word", "repeated_next", "distinct_triples", "distinct_lines", "top_line",
]

_KIND = np.full(256, KINDS.index("symbol"), np.uint8)
for _kind, _bytes in {
    "control": [*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F],
    "blank": [0x20, 0x09, 0x0B, 0x0C, 0x0D],
    "newline": [0x0A],
    "lower": range(0x61, 0x7B),
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "stop": b".!?",
    "pause": b",;:-",
    "quote": b"'\"()",
    "high": range(0x80, 0x100),
}.items():
    _KIND[list(_bytes)] = KINDS.index(_kind)
_K = {k: i for i, k in enumerate(KINDS)}


def _sums(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Sum of each row's values."""
    out = np.zeros(len(of) - 1, np.int64)
    some = np.flatnonzero(np.diff(of))
    if len(some):
        out[some] = np.add.reduceat(values, of[some], dtype=np.int64)
    return out


def _repeats(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's hashes, the share of distinct ones and the share of the most frequent one."""
    n, rows = np.diff(of), len(of) - 1
    row = np.repeat(np.arange(rows), n)
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, r[first], np.diff(np.append(first, len(x))))
    whole = np.maximum(n, 1)
    return np.bincount(r[first], minlength=rows) / whole, most / whole


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of NAMES per text; all 0 for an empty one."""
    lo, hi = int(off[0]), int(off[-1])
    of, text = off - lo, data[lo:hi]
    kind = _KIND[text]
    size = np.maximum(np.diff(of), 1)
    counts = np.stack([_sums(kind == k, of) for k in range(len(KINDS))], axis=1)
    share = counts / size[:, None]
    h, wo = common.word_hashes(text, of)
    words, some = np.diff(wo), np.maximum(np.diff(wo), 1)
    # where words begin and end: a word's neighbours are separators or the row's ends
    gap = (kind == _K["blank"]) | (kind == _K["newline"])
    edge = np.zeros(len(text) + 1, bool)
    edge[of] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= gap[:-1]
    after[:-1] |= gap[1:]
    starts, ends = ~gap & before, ~gap & after
    pairs = np.zeros(len(text), bool)
    pairs[1:] = (kind[1:] == _K["upper"]) & (kind[:-1] == _K["upper"]) & ~edge[1:-1]
    next_same = np.zeros(len(h), bool)
    next_same[1:] = h[1:] == h[:-1]
    next_same[wo[:-1][words > 0]] = False
    triples, to = common.shingle_hashes(h, wo, 3)
    # lines as rows of their own; a line's hash follows its words and their places
    breaks = np.unique(np.concatenate([of, np.flatnonzero(kind == _K["newline"]) + 1]))
    line_words = np.searchsorted(wo_starts := np.flatnonzero(starts), breaks)
    place = np.arange(len(wo_starts)) - np.repeat(line_words[:-1], np.diff(line_words))
    mixed = common.finish(h + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    full = np.flatnonzero(np.diff(line_words))  # lines with a word
    lines = np.add.reduceat(mixed, line_words[full]) if len(full) else np.zeros(0, np.uint64)
    lo_ = np.searchsorted(breaks[full], of)
    n_lines = np.diff(lo_)
    distinct_words, top_word = _repeats(h, wo)
    distinct_triples, _ = _repeats(triples, to)
    distinct_lines, top_line = _repeats(lines, lo_)
    letters = np.maximum(counts[:, _K["lower"]] + counts[:, _K["upper"]], 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.where(share > 0, share * np.log(share), 0.0).sum(axis=1)
    solid = np.diff(of) - counts[:, _K["blank"]] - counts[:, _K["newline"]]
    alone = starts & ends
    out = np.column_stack([
        share, np.log1p(np.diff(of)), np.log1p(words), np.log1p(n_lines), solid / some, words / np.maximum(n_lines, 1), counts[:, _K["upper"]] / letters, entropy,
        _sums(starts & (kind == _K["upper"]), of) / some, _sums(ends & (kind == _K["stop"]), of) / some, _sums(ends & (kind == _K["symbol"]), of) / some,
        _sums(pairs, of) / size, _sums(alone, of) / some,
        distinct_words, top_word, _sums(next_same, wo) / some, distinct_triples, distinct_lines, top_line,
    ])
    return out


# --- trees ------------------------------------------------------------------------


class HistogramTrees:
    """Boosted trees for a 0/1 label; after ``fit`` all trees lie in five flat arrays."""

    def __init__(self, rounds: int = ROUNDS, leaves: int = LEAVES, rate: float = RATE):
        self.rounds, self.leaves, self.rate = rounds, leaves, rate

    def fit(self, x: np.ndarray, y: np.ndarray, held: np.ndarray | None = None) -> HistogramTrees:
        """``held``: rows that only choose the number of rounds (lowest log-loss)."""
        held = np.zeros(len(y), bool) if held is None else held
        own = ~held
        self.edges = [np.unique(np.quantile(x[own, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        code = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)])  # x <= e[k] iff code <= k
        # all statistics share one histogram: bin b of statistic j is slot j * BINS + b
        slot = code[own] + np.arange(x.shape[1]) * BINS
        share = np.clip(y[own].mean(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        raw, target = np.full(len(y), self.base), y[own]
        trees, losses = [], []
        for _ in range(self.rounds):
            p = sigmoid(raw[own])
            trees.append(self._grow(slot, p - target, np.maximum(p * (1 - p), 1e-9)))
            raw += self._follow(trees[-1], x)
            if held.any():
                q = np.clip(sigmoid(raw[held]), 1e-12, 1 - 1e-12)
                losses.append(-np.mean(np.where(y[held] == 1, np.log(q), np.log(1 - q))))
        if losses:
            trees = trees[: int(np.argmin(losses)) + 1]
        sizes = [len(t[0]) for t in trees]
        self.roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int32)
        self.feature, self.cut, self.value = (np.concatenate([t[i] for t in trees]) for i in (0, 1, 4))
        self.left, self.right = (np.concatenate([t[i] + r for t, r in zip(trees, self.roots, strict=True)]).astype(np.int32) for i in (2, 3))
        self.depth = max(t[5] for t in trees)
        return self

    def _histogram(self, slot: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Gradients, second derivatives and rows by slot."""
        flat, n = slot.ravel(), slot.shape[1] * BINS
        wide = slot.shape[1]
        return np.stack([np.bincount(flat, np.repeat(g, wide), n), np.bincount(flat, np.repeat(h, wide), n), np.bincount(flat, minlength=n)])

    def _best(self, hist: np.ndarray) -> tuple[float, int, int]:
        """Gain, statistic and bin of the best cut; rows up to and with the bin go left."""
        g, h, n = np.cumsum(hist.reshape(3, -1, BINS), axis=2)
        gs, hs, ns = g[:, -1:], h[:, -1:], n[:, -1:]
        gain = g**2 / (h + RIDGE) + (gs - g) ** 2 / (hs - h + RIDGE) - gs**2 / (hs + RIDGE)
        gain[(n < LEAST) | (ns - n < LEAST)] = 0
        at = int(gain.argmax())
        return float(gain.flat[at]), at // BINS, at % BINS

    def _grow(self, slot: np.ndarray, g: np.ndarray, h: np.ndarray):
        """Best-first growth: (statistic, cut, left, right, value) by node, and the depth."""
        feature, cut, left, right, value, level = [0], [0.0], [0], [0], [0.0], [0]

        def leaf(k: int, hist: np.ndarray, rows: np.ndarray) -> None:
            value[k] = -self.rate * g[rows].sum() / (h[rows].sum() + RIDGE)
            gain, j, b = self._best(hist)
            if gain > 1e-6:
                heapq.heappush(waiting, (-gain, k, j, b, hist, rows))

        waiting: list = []
        leaf(0, self._histogram(slot, g, h), np.arange(len(g)))
        for _ in range(self.leaves - 1):
            if not waiting:
                break
            _, k, j, b, hist, rows = heapq.heappop(waiting)
            goes = slot[rows, j] - j * BINS <= b
            parts = [rows[goes], rows[~goes]]
            small = int(len(parts[1]) < len(parts[0]))
            own = self._histogram(slot[parts[small]], g[parts[small]], h[parts[small]])
            hists = [own, hist - own] if small == 0 else [hist - own, own]
            feature[k], cut[k], left[k], right[k] = j, float(self.edges[j][b]), len(feature), len(feature) + 1
            for side in (0, 1):
                n = len(feature)
                feature.append(0), cut.append(0.0), left.append(n), right.append(n), value.append(0.0), level.append(level[k] + 1)
                leaf(n, hists[side], parts[side])
        return np.array(feature, np.int32), np.array(cut), np.array(left), np.array(right), np.array(value), max(level)

    @staticmethod
    def _follow(tree, x: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value, depth = tree
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            at = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
        return value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for lo in range(0, len(x), WALK):
            part = x[lo : lo + WALK]
            at, rows = np.broadcast_to(self.roots, (len(part), len(self.roots))), np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = np.where(part[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            out[lo : lo + WALK] = self.base + self.value[at].sum(axis=1)
        return sigmoid(out)


class Constant:
    def __init__(self, share: float):
        self.share = share

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


# --- Spark ------------------------------------------------------------------------


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """docs with ``text`` replaced by its statistics (array<double>, in the order of NAMES)."""
    at, rest = docs.columns.index(text), docs.drop(text)

    def run(batches):
        for batch in batches:
            data, off = common.utf8(batch.column(at))
            others = batch.drop_columns([text])
            for lo, hi in common.row_blocks(off):
                x = statistics(data, off[lo : hi + 1])
                made = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * len(NAMES), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*others.slice(lo, hi - lo).columns, made], names=[*others.schema.names, name])

    return common.map_arrow(docs, run, rest.withColumn(name, F.array(F.lit(0.0))).schema)


def sample(docs: DataFrame, labels: DataFrame, learned, label: str, most: int) -> DataFrame:
    """doc_id, label and statistics of about ``most`` labelled documents, chosen by a hash of the id below a threshold."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learned)
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    n = usable.count()
    if n > most:
        usable = usable.where(F.xxhash64("doc_id") < int(-(2**63) + 2**64 * most / n))
    # about ``most`` rows of two numbers; a document of a repeated id teaches once
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(usable), "doc_id")
    return with_statistics(rows).groupBy("doc_id", "label").agg(F.min("statistics").alias("statistics"))


def fit(docs: DataFrame, labels: DataFrame, learned, label: str = "quality", most: int = SAMPLE):
    rows = sample(docs, labels, learned, label, most).toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    y = rows.column("label").to_numpy().astype(np.float64)
    if len(set(y)) < 2:
        return Constant(float(y.mean()) if len(y) else 0.0)
    x = rows.column("statistics").combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES))
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        return HistogramTrees(rounds=50).fit(x, y)
    return HistogramTrees().fit(x, y, held)


def score(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """docs without ``text``, with quality_score (0 to 1)."""
    docs = docs.drop("quality_score")
    at, rest = docs.columns.index(text), docs.drop(text)

    def run(batches):
        for batch in batches:
            data, off = common.utf8(batch.column(at))
            others = batch.drop_columns([text])
            for lo, hi in common.row_blocks(off):
                p = model.predict(statistics(data, off[lo : hi + 1]))
                yield pa.RecordBatch.from_arrays([*others.slice(lo, hi - lo).columns, pa.array(p, pa.float64())], names=[*others.schema.names, "quality_score"])

    return common.map_arrow(docs, run, rest.withColumn("quality_score", F.lit(0.0)).schema)


def op13_quality(spark, sf_dir: str) -> DataFrame:
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~out)
    return score(docs, model).select(
        "doc_id", out.alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted")
    )
