"""Language identification by interpolated Kneser-Ney character models (operator 3).

Texts are lower-cased; each run of non-letters is one space.  Every language has
a model of order ORDER: raw counts of the longest n-grams, and for each shorter
one the number of different characters seen before it (its continuation count).
Each order takes a discount n1/(n1 + 2 n2) from its counts and gives what is freed
to the next shorter order; the shortest falls back on a uniform share.  N-grams, continuation
counts and discounts are counted by Spark over all learning rows, and every n-gram counts.  A model is a set of sorted
arrays of 64-bit hashes.  A text gets the language of the lowest cross-entropy per character; ties go to the smaller name.

The longest n-grams are dealt into blocks of about MODEL_ROWS by their two middle characters, which also settle their
contexts and the next shorter order; pairs and single characters (bounded by the alphabets) belong to every block.  One block is
broadcast and the texts are scored in one pass; with more n-grams, each block scores the texts in a pass of its own, and a text's costs
are the sum over the blocks: the same scores, and neither the driver nor a worker ever holds more than a block.

Rejection is calibrated on the learning rows: a text of n characters is rejected
if its cross-entropy lies over the mean of its language by more than
max(MARGIN, SIGMAS * s / sqrt(n)), where s is the measured spread of one character.
A text without a letter is ``und`` and rejected.

Edge cases: null and empty texts are ``und`` with score 0.0; with nothing to learn
from, every text is; repeated rows are judged alike; a very long text is a
block of its own; an empty table gives an empty result; columns named like the four that ``score`` adds are replaced there, the
pipeline's stage passes all columns through.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common
from riskhouse.session import scratch_path

ORDER = 4
#: Longest n-grams of all languages that the driver and each worker hold at a time, about.
MODEL_ROWS = 2_000_000
MARGIN, SIGMAS = 0.6, 8.0
#: Characters that are handled together; their arrays take some 80 bytes each.
BLOCK = 1 << 20
_BITS = np.int64(21)
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_letters: list[np.ndarray] = []


def _alphabet() -> np.ndarray:
    """Code point -> itself if a letter, else space."""
    if not _letters:
        _letters.append(np.array([c if chr(c).isalpha() else 32 for c in range(sys.maxunicode + 1)], np.int64))
    return _letters[0]


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as code points, each with ORDER - 1 spaces before and one after, and their offsets."""
    lowered = [t.lower() for t in texts]
    raw = _alphabet()[np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)]
    sizes = np.array([len(t) for t in lowered], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    keep[begin[begin < len(raw)]] &= raw[begin[begin < len(raw)]] != 32
    ends = begin + sizes
    keep[ends[ends < len(raw)]] = False  # the joints
    total = np.concatenate([[0], np.cumsum(keep)])
    n = total[np.minimum(ends, len(raw))] - total[begin]
    off = np.concatenate([[0], np.cumsum(n + ORDER)])
    out = np.full(off[-1], 32, np.int64)
    at = np.arange(int(n.sum())) + np.repeat(off[:-1] + ORDER - 1 - (np.cumsum(n) - n), n)
    out[at] = raw[keep]
    return out, off


def grams(chars: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each n-gram begins, and the offsets of the rows' n-grams."""
    n = np.maximum(np.diff(off) - ORDER + 1, 0)
    go = np.concatenate([[0], np.cumsum(n)])
    return np.arange(go[-1]) - np.repeat(go[:-1], n) + np.repeat(off[:-1], n), go


def key(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of n-grams, given as arrays of their characters in order."""
    acc = np.full(len(columns[0]), len(columns), np.uint64)
    for c, m in zip(columns, _MULT, strict=False):
        acc = common.finish(acc * m + c.astype(np.uint64))
    return acc


def _blocks(values: list[str | None], most: int = BLOCK):
    off = np.concatenate([[0], np.cumsum([len(v or "") for v in values])]).astype(np.int64)
    for lo, hi in common.row_blocks(off, most):
        yield lo, hi


def count_ngrams(df: DataFrame) -> DataFrame:
    """(lang, a, b, n): counts of the longest n-grams, whose characters are a>>21, a, b>>21, b (21 bits each)."""
    i, j = df.columns.index("text"), df.columns.index("lang")

    def run(batches):
        held: list[pd.DataFrame] = []

        def summed():
            return pd.concat(held).groupby(["lang", "a", "b"], sort=False, as_index=False)["n"].sum()

        for batch in batches:
            texts, langs = batch.column(i).to_pylist(), np.array(batch.column(j).to_pylist(), object)
            for lo, hi in _blocks(texts):
                own = langs[lo:hi]
                for lang in sorted(set(own)):
                    chars, off = characters([t or "" for t, x in zip(texts[lo:hi], own, strict=True) if x == lang])
                    at, _ = grams(chars, off)
                    a, b = (chars[at] << _BITS) | chars[at + 1], (chars[at + 2] << _BITS) | chars[at + 3]
                    codes, _u = pd.factorize(key([a, b]))
                    if len(codes):
                        n = np.bincount(codes)
                        first = np.zeros(len(n), np.int64)
                        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
                        held.append(pd.DataFrame({"lang": lang, "a": a[first], "b": b[first], "n": n}))
            if sum(map(len, held)) > 1_000_000:
                held[:] = [summed()]
        if held:
            yield pa.RecordBatch.from_pandas(summed(), preserve_index=False)

    counts = common.map_arrow(df, run, "lang string, a long, b long, n long")
    return counts.groupBy("lang", "a", "b").agg(F.sum("n").alias("n"))


_MASK = (1 << 21) - 1


class Statistics:
    """What all blocks share: languages, discounts by (language, order), continuation counts of pairs and single characters."""

    def __init__(self, counts: DataFrame):
        low = lambda c: F.col(c).bitwiseAND(F.lit(_MASK))
        n = F.count(F.lit(1)).alias("n")  # a longer n-gram counts once
        triples = common.shared_checkpoint(counts.groupBy("lang", low("a").alias("a"), "b").agg(n))
        pairs = triples.groupBy("lang", "b").agg(n)
        singles = pairs.groupBy("lang", low("b").alias("b")).agg(n)
        self.pairs, self.singles = pairs.toPandas(), singles.toPandas()
        once, twice = F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")
        self.discounts = {}
        for order, rows in ((4, counts), (3, triples), (2, pairs), (1, singles)):
            for lang, n1, n2 in rows.groupBy("lang").agg(once, twice).collect():  # a row a language
                self.discounts[lang, order] = float(np.clip(n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5, 0.1, 0.95))
        self.langs = sorted({lang for lang, _ in self.discounts})
        letters = max((int(x) for x in self.singles.groupby("lang").size()), default=0)
        self.uniform = 1.0 / (letters + 1000)


def block_of(second, third, blocks: int):
    """The block of n-grams with these middle characters; the same for numpy arrays and Spark columns."""
    return (second * 1_000_003 + third) % blocks


class Model:
    """Kneser-Ney models of all languages over the n-grams of one block: for each, and each order, sorted hashes with counts."""

    def __init__(self, counts: pd.DataFrame, shared: Statistics, block: int = 0, blocks: int = 1):
        self.langs, self.uniform, self.block, self.blocks = shared.langs, shared.uniform, block, blocks
        self.tables = []
        for lang in self.langs:
            a, b, n = (counts[counts["lang"] == lang][c].to_numpy(np.int64) for c in ("a", "b", "n"))
            longest = [a >> 21, a & _MASK, b >> 21, b & _MASK]
            triples, first, n3 = np.unique(key(longest[1:]), return_index=True, return_counts=True)
            pairs, singles = (t[t["lang"] == lang] for t in (shared.pairs, shared.singles))
            b2, b1 = pairs["b"].to_numpy(np.int64), singles["b"].to_numpy(np.int64)
            levels = [(longest, n), ([c[first] for c in longest[1:]], n3), ([b2 >> 21, b2 & _MASK], pairs["n"].to_numpy()), ([b1], singles["n"].to_numpy())]
            orders = []
            for order, (columns, count) in zip(range(ORDER, 0, -1), levels, strict=True):
                if not len(count):  # no n-gram of the language in this block
                    columns, count = [np.zeros(1, np.int64)] * order, np.zeros(1, np.int64)
                discount = shared.discounts[lang, order]
                hashes = key(columns)
                before = key(columns[:-1]) if order > 1 else np.zeros(len(count), np.uint64)
                contexts, inverse = np.unique(before, return_inverse=True)
                total, types = np.maximum(np.bincount(inverse, count), 1e-9), np.bincount(inverse, count > 0)
                by = np.argsort(hashes, kind="stable")
                orders.append((hashes[by], count[by].astype(float), contexts, total, discount * types / total, discount))
            self.tables.append(orders)
        mixed = counts.drop_duplicates(["a", "b"])
        a, b = mixed["a"].to_numpy(np.int64), mixed["b"].to_numpy(np.int64)
        columns = [a >> 21, a & _MASK, b >> 21, b & _MASK]
        self.known = key(columns) if len(mixed) else np.zeros(0, np.uint64)
        by = np.argsort(self.known, kind="stable")
        self.known = self.known[by]
        self.cost = self.work_out([c[by] for c in columns])

    def work_out(self, columns: list[np.ndarray]) -> np.ndarray:
        """-log of each n-gram's probability after its first characters, a column for each language."""
        out = np.zeros((len(columns[0]), len(self.langs)), np.float32)
        for j, orders in enumerate(self.tables):
            p = np.full(len(columns[0]), self.uniform)
            for order in range(1, ORDER + 1):
                hashes, n, contexts, total, left, discount = orders[ORDER - order]
                own = columns[ORDER - order :]
                c = np.minimum(np.searchsorted(contexts, before := key(own[:-1]) if order > 1 else np.zeros(len(p), np.uint64)), len(contexts) - 1)
                seen = contexts[c] == before
                g = np.minimum(np.searchsorted(hashes, wanted := key(own)), len(hashes) - 1)
                count = np.where(hashes[g] == wanted, n[g], 0.0)
                p = np.where(seen, np.maximum(count - discount, 0) / total[c] + left[c] * p, p)
            out[:, j] = -np.log(p)
        return out

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cost of the block's n-grams by text and language, and the number of all n-grams of a text."""
        chars, off = characters(texts)
        at, go = grams(chars, off)
        codes, unique = pd.factorize(key([(chars[at] << _BITS) | chars[at + 1], (chars[at + 2] << _BITS) | chars[at + 3]]))
        first = np.zeros(len(unique), np.int64)
        first[codes[::-1]] = at[::-1]
        columns = [chars[first + k] for k in range(ORDER)]
        own = block_of(columns[1], columns[2], self.blocks) == self.block
        cost, wanted = np.zeros((len(unique), len(self.langs)), np.float32), key([c[own] for c in columns])
        if len(wanted):
            where = np.minimum(np.searchsorted(self.known, wanted), max(len(self.known) - 1, 0))
            new = self.known[where] != wanted if len(self.known) else np.ones(len(wanted), bool)
            found = self.cost[where] if len(self.known) else np.zeros((len(wanted), len(self.langs)), np.float32)
            found[new] = self.work_out([c[own][new] for c in columns])
            cost[own] = found
        out = np.zeros((len(texts), len(self.langs)))
        for j in range(len(self.langs)):
            total = np.concatenate([[0.0], np.cumsum(cost[:, j][codes], dtype=np.float64)])
            out[:, j] = total[go[1:]] - total[go[:-1]]
        return out, np.diff(go)


class Fitted:
    """The models of a set of learning rows, block by block."""

    def __init__(self, counts: DataFrame, blocks: int):
        self.counts, self.blocks, self.shared = counts, blocks, Statistics(counts)
        self.langs = self.shared.langs

    def model(self, block: int) -> Model:
        own = self.counts
        if self.blocks > 1:
            second, third = F.col("a").bitwiseAND(F.lit(_MASK)), F.shiftright("b", 21)
            own = own.where(block_of(second, third, self.blocks) == block)
        return Model(own.toPandas(), self.shared, block, self.blocks)


def fit(learning: DataFrame) -> Fitted | None:
    """Models of the rows' text by their non-null lang; counts cover every row and n-gram."""
    counts = common.shared_checkpoint(count_ngrams(learning.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")))
    size = counts.count()
    return Fitted(counts, -(-size // MODEL_ROWS)) if size else None


NAMES = ["lang_pred", "lang_score", "lang_entropy", "lang_chars"]


def _costs(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """df with _costs, the block's costs by language, and _grams, the number of n-grams of the text."""
    at = df.columns.index(text)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in _blocks(texts):
                part = [t or "" for t in texts[lo:hi]]
                sums, n = own.costs(part) if own is not None else (np.zeros((len(part), 0)), np.zeros(len(part), np.int64))
                width = sums.shape[1]
                costs = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(sums.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, costs, pa.array(n, pa.int64())], names=[*batch.schema.names, "_costs", "_grams"])

    schema = df.withColumns({"_costs": F.array(F.lit(0.0)), "_grams": F.lit(0).cast("long")}).schema
    return common.map_arrow(df, run, schema)


def score(df: DataFrame, fitted: Fitted | None, text: str = "text") -> DataFrame:
    """Adds lang_pred, lang_score, lang_entropy (of the best) and lang_chars to df; columns of these names are replaced."""
    df = df.drop(*NAMES)
    if fitted is None:
        nothing = [F.lit("und"), F.lit(0.0), F.lit(0.0), F.lit(0).cast("long")]
        return df.withColumns(dict(zip(NAMES, nothing, strict=True)))
    if fitted.blocks == 1:
        costed = _costs(df, fitted.model(0), text)
    else:
        # a row number joins the blocks' parts again, so the rows are written once; each part is written before the next model is made
        path = scratch_path(df.sparkSession, "language-rows")
        df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
        rows, parts = df.sparkSession.read.parquet(path), []
        for k in range(fitted.blocks):
            parts.append(scratch_path(df.sparkSession, f"language-costs-{k}"))
            _costs(rows.select("_row", text), fitted.model(k), text).drop(text).write.parquet(parts[-1])
        sums = F.array(*[F.sum(F.get("_costs", F.lit(j))) for j in range(len(fitted.langs))])
        total = df.sparkSession.read.parquet(*parts).groupBy("_row").agg(sums.alias("_costs"), F.max("_grams").alias("_grams"))
        costed = rows.join(total, "_row").drop("_row")
    chars = F.greatest(F.col("_grams") - 1, F.lit(0))
    entropies = F.transform("_costs", lambda c: c / F.greatest(F.col("_grams"), F.lit(1)))
    out = costed.withColumn("_costs", entropies).withColumn("_least", F.array_min("_costs")).withColumn("lang_chars", chars)
    # confidence: posterior over the languages as if of at most 40 independent characters
    most = F.least(F.greatest("lang_chars", F.lit(1)), F.lit(40))
    weight = F.aggregate("_costs", F.lit(0.0), lambda s, c: s + F.exp(-(c - F.col("_least")) * most))
    some = F.col("lang_chars") > 0
    name = F.get(F.array(*[F.lit(x) for x in fitted.langs]), (F.array_position("_costs", F.col("_least")) - 1).cast("int"))
    made = [F.when(some, name).otherwise("und"), F.when(some, 1 / weight).otherwise(0.0), F.when(some, F.col("_least")).otherwise(0.0), F.col("lang_chars")]
    return out.withColumns(dict(zip(NAMES, made, strict=True))).drop("_costs", "_grams", "_least").select(*df.columns, *NAMES)


def rejected(scored: DataFrame, learned) -> DataFrame:
    """Adds lang_rejected; ``learned``: the condition for the rows on which the limits are calibrated.

    ``scored`` should be materialised, since it is read twice.
    """
    base = scored.where(learned & (F.col("lang") == F.col("lang_pred")))
    mean = base.groupBy("lang_pred").agg((F.sum(F.col("lang_entropy") * F.col("lang_chars")) / F.sum("lang_chars")).alias("m"), F.avg("lang_entropy").alias("e"), F.avg("lang_chars").alias("c"),
        F.avg(F.col("lang_entropy") * F.col("lang_entropy") * F.col("lang_chars")).alias("ee"), F.avg(F.col("lang_entropy") * F.col("lang_chars")).alias("ec"))
    limits = {}
    for r in mean.collect():  # one row for each learned language
        limits[r["lang_pred"]] = (r["m"], max(r["ee"] - 2 * r["m"] * r["ec"] + r["m"] ** 2 * r["c"], 0.0) ** 0.5)
    over = F.lit(False)
    for lang, (m, s) in limits.items():
        room = F.greatest(F.lit(MARGIN), F.lit(SIGMAS * s) / F.sqrt(F.greatest(F.col("lang_chars"), F.lit(1))))
        over = over | ((F.col("lang_pred") == lang) & (F.col("lang_entropy") > F.lit(m) + room))
    return scored.withColumn("lang_rejected", (F.col("lang_pred") == "und") | over)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "lang")
    learned = F.col("doc_id").isNotNull() & ~common.held_out(F.col("doc_id"))
    model = fit(docs.where(learned))
    # the text itself is not kept with the scores
    scored = common.shared_checkpoint(score(docs, model).drop("text"))
    return rejected(scored, learned).select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def keep_identified(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pipeline stage: the documents whose language is one of the learned ones, columns as they are."""
    learned = F.col(key).isNotNull() & ~common.held_out(F.col(key))
    own = common.packed(docs, [key, "text", "lang"])
    scored = common.shared_checkpoint(score(own, fit(own.where(learned))))
    return common.unpacked(rejected(scored, learned).where(~F.col("lang_rejected")), docs)
