"""Toxicity by a counterfactually regularised linear classifier (operator 6).

Features are the distinct words of a text (A-Z lower-cased, ASCII punctuation taken as space).  The
classifier is fitted on a bounded sample of labelled rows, SAMPLE of them by the order of a hash of
the id: words are chosen by how unevenly they lie in the two classes, and a logistic model is fitted
by gradient descent on  log-loss + RIDGE |w|^2 + SWAP mean (s(x) - s(x'))^2,  where x' is a labelled text
whose identity terms are swapped for another term of the same group.  Texts without such a term take part
with the group's terms put in and swapped, so the penalty holds for every group, however rarely
the corpus names it.  Neutral mentions of a group then hardly move the score.  A fifth of the sample takes no part in
the fit: on it, the intercept is moved so that a score of 1/2 is the lowest cut at which PRECISION of the rows above are toxic.

Edge cases: null and empty texts have no words and get the score of the intercept; with no usable labels
(none, or of one class) every score is the share of toxic rows, 0.0 without any; repeated rows are scored alike;
an empty table gives an empty result; texts of any length are read in whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common
from riskhouse.llm.trees import sigmoid

#: Labelled rows that the classifier is fitted on at most, and words that it weighs at most.
SAMPLE, WORDS = 16_000, 4_096
#: Standard deviations by which a word has to lie unevenly in the classes.
UNEVEN = 2.0
RIDGE, SWAP, ROUNDS, PRECISION = 3e-5, 25.0, 400, 0.99
#: Identity terms by group, each swapped for the others of its group.
IDENTITIES = [
    ["man", "woman", "men", "women", "male", "female", "boy", "girl"],
    ["homme", "femme", "garçon", "fille", "mann", "frau", "junge", "mädchen", "hombre", "mujer", "chico", "chica"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"],
    ["black", "white", "asian", "african", "european", "latino", "arab", "indigenous"],
    ["american", "mexican", "chinese", "indian", "russian", "german", "french", "spanish", "turkish", "polish"],
    ["gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "transgender", "queer"],
    ["old", "young", "elderly", "teenage"],
    ["blind", "deaf", "disabled", "paralysed", "autistic"],
    ["immigrant", "refugee", "migrant", "citizen", "foreigner"],
]

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = int(off[0]), int(off[-1])
    return common.word_hashes(_PLAIN[data[lo:hi]], off - lo)


def _term_hashes(terms: list[str]) -> np.ndarray:
    data, off = common.utf8(pa.array(terms, pa.string()))
    return words(data, off)[0]


def _sample(docs: DataFrame, labels: DataFrame, learned) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct word hashes and label of each sampled row; SAMPLE rows at most reach the driver."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learned).select("doc_id", "toxic").distinct()
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    def run(batches):
        for batch in batches:
            data, off = common.utf8(batch.column(0))
            for lo, hi in common.row_blocks(off):
                h, wo = words(data, off[lo : hi + 1])
                own = [np.unique(h[a:b]).tobytes() for a, b in zip(wo[:-1], wo[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), batch.column(1).slice(lo, hi - lo).cast(pa.int32())], names=["words", "toxic"])

    # ids may repeat in docs, so the bound is set once more; equal rows count once
    found = common.map_arrow(rows, run, "words binary, toxic int").distinct().orderBy(F.xxhash64("words"), "words", "toxic").limit(SAMPLE).collect()
    return [np.frombuffer(r["words"], np.uint64) for r in found], np.array([r["toxic"] for r in found], np.float64)


class Classifier:
    """Weights of known words (sorted hashes) and an intercept."""

    def __init__(self, known: np.ndarray, weight: np.ndarray, intercept: float):
        self.known, self.weight, self.intercept = known, weight, intercept

    def raw(self, h: np.ndarray, wo: np.ndarray) -> np.ndarray:
        n = len(wo) - 1
        if not len(self.known) or not len(h):
            return np.full(n, self.intercept)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        hit = np.flatnonzero(self.known[at] == h)
        pair = np.unique((np.searchsorted(wo, hit, "right") - 1) * len(self.known) + at[hit])
        return self.intercept + np.bincount(pair // len(self.known), self.weight[pair % len(self.known)], n)


def _choose(texts: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    every = np.concatenate(texts)
    known, code = np.unique(every, return_inverse=True)
    label = np.repeat(y, [len(t) for t in texts])
    n, toxic = np.bincount(code, minlength=len(known)), np.bincount(code, label, len(known))
    share = y.mean()
    uneven = np.abs(toxic - n * share) / np.sqrt(n * share * (1 - share) + 1)
    uneven[n < 5] = 0
    best = np.argsort(-uneven, kind="stable")[:WORDS]
    return np.unique(np.concatenate([known[best[uneven[best] > UNEVEN]], *(_term_hashes(g) for g in IDENTITIES)]))


def _codes(texts: list[np.ndarray], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of the known words in each text."""
    row, h = np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = known[at] == h
    return row[hit], at[hit]


def _swaps(row: np.ndarray, word: np.ndarray, n: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counterfactual pairs: text, term in it (or put in), term instead."""
    rng = np.random.Generator(np.random.PCG64(7))
    texts, olds, news = [], [], []
    for group in IDENTITIES:
        terms = np.searchsorted(known, _term_hashes(group))
        has = np.isin(word, terms)
        own, old = row[has], word[has]
        extra = rng.choice(n, min(n, 400), replace=False)
        own, old = np.concatenate([own, extra]), np.concatenate([old, rng.choice(terms, len(extra))])
        new = rng.choice(terms, len(own))
        texts.append(own), olds.append(old), news.append(new)
    return np.concatenate(texts), np.concatenate(olds), np.concatenate(news)


def fit(docs: DataFrame, labels: DataFrame, learned) -> Classifier:
    texts, y = _sample(docs, labels, learned)
    if not len(y) or len(set(y)) < 2:
        share = float(np.clip(y.mean(), 1e-12, 1 - 1e-12)) if len(y) else 1e-12
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held])) == 2 and len(set(y[held])) == 2:
        fitted = _fit([t for t, h in zip(texts, held, strict=True) if not h], y[~held])
        return _calibrated(fitted, [t for t, h in zip(texts, held, strict=True) if h], y[held])
    return _fit(texts, y)


def _calibrated(model: Classifier, texts: list[np.ndarray], y: np.ndarray) -> Classifier:
    raw = model.raw(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    order = np.argsort(-raw, kind="stable")
    right = np.cumsum(y[order])
    good = np.flatnonzero(right >= PRECISION * np.arange(1, len(y) + 1))
    if not len(good):
        return model
    k = int(good[-1])
    # halfway between the last row above the cut and the first below it
    below = raw[order[k + 1]] if k + 1 < len(y) else raw[order[k]] - 1
    return Classifier(model.known, model.weight, model.intercept - float(raw[order[k]] + below) / 2)


def _fit(texts: list[np.ndarray], y: np.ndarray) -> Classifier:
    known = _choose(texts, y)
    row, word = _codes(texts, known)
    who, old, new = _swaps(row, word, len(y), known)
    w, b, m, v = np.zeros(len(known)), float(np.log(y.mean() / (1 - y.mean()))), np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    there = np.zeros(len(who), bool)
    order = np.argsort(row * len(known) + word)
    keys = (row * len(known) + word)[order]
    at = np.minimum(np.searchsorted(keys, who * len(known) + old), len(keys) - 1) if len(keys) else np.zeros(len(who), int)
    there = keys[at] == who * len(known) + old if len(keys) else there
    for step in range(1, ROUNDS + 1):
        raw = b + np.bincount(row, w[word], len(y))
        p = sigmoid(raw)
        error = (p - y) / len(y)
        grad = np.bincount(word, error[row], len(known)) + 2 * RIDGE * w
        # s(x): the text with the old term; s(x'): with the new one instead
        with_old = sigmoid(raw[who] + np.where(there, 0.0, w[old]))
        with_new = sigmoid(raw[who] - np.where(there, w[old], 0.0) + w[new])
        change = 2 * SWAP * (with_old - with_new) / len(who)
        slope_old, slope_new = with_old * (1 - with_old), with_new * (1 - with_new)
        # both scores share the text's other words; their part of the gradient and the terms' own
        both = np.bincount(who, change * (slope_old - slope_new), len(y))
        grad += np.bincount(word, both[row], len(known))
        grad += np.bincount(old, change * (slope_old * ~there + slope_new * there), len(known))
        grad -= np.bincount(new, change * slope_new, len(known))
        full = np.append(grad, error.sum() + both.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Classifier(known, w, float(b))


def score(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """docs without ``text``, with toxic_score (0 to 1)."""
    docs = docs.drop("toxic_score")
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            data, off = common.utf8(batch.column(at))
            rest = batch.drop_columns([text])
            for lo, hi in common.row_blocks(off):
                p = sigmoid(model.raw(*words(data, off[lo : hi + 1])))
                yield pa.RecordBatch.from_arrays([*rest.slice(lo, hi - lo).columns, pa.array(p, pa.float64())], names=[*rest.schema.names, "toxic_score"])

    return common.map_arrow(docs, run, docs.drop(text).withColumn("toxic_score", F.lit(0.0)).schema)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, out = common.documents(spark, sf_dir).select("doc_id", "text"), common.held_out(F.col("doc_id"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, ~out)
    return score(docs, model).select(
        "doc_id", out.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted")
    )
