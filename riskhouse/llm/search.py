"""Ranked lexical search by scanning the documents with an automaton of the items' terms (operator 12).

Terms are the maximal runs of digits, letters and all other characters outside ASCII, A-Z lower-cased.  There is no
index: the distinct terms of the items go to the executors as one Aho-Corasick automaton whose patterns are
guarded by a blank on either side, so only whole terms match, and its outputs are term numbers that lead to the
items holding the term.  Two scans follow: the first counts documents, terms and the documents of each item term;
the second counts tf again, adds up the integer scores and keeps each item's best TOP documents of a task, of
which a window keeps the best of all.  Nothing is shuffled but counts by term and those best rows.

An automaton holds TERMS (item, term) rows at most: more items than that are searched in several blocks, each with
scans of its own, so what is broadcast does not grow with the items (a single item's terms are never split).  Long texts are scanned in
pieces cut between terms.

Edge cases: null and empty texts, and those without a term, are no documents of the corpus; items without a term
get no rows; rows of one item_id form one item, whose terms are those of all its rows; every row of documents is a
document of its own, so a repeated doc_id may take several ranks; ties go to the smaller doc_id, a null id comes last;
empty tables give an empty result; further columns of either table take no part, whatever their names.
"""

from __future__ import annotations

import itertools

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskhouse.llm import common

#: (item, term) rows that one automaton and its postings hold at most.
TERMS = 200_000
TOP = 20
#: Cells of one step's (document, item) table of scores.
CELLS = 1 << 19
#: The form of a term, and the constants of the score (b = 25 and k1 = 12 in 100ths and 10ths).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UNIT, SATURATION, LENGTH_SHARE = 1_000_000_000, 12, 25

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = 0x20
#: Bytes of terms as they are (A-Z lower-cased), all others as blanks.
_PLAIN = np.full(256, _BLANK, np.uint8)
_PLAIN[0x80:] = np.arange(0x80, 0x100)
for _c in (*range(0x30, 0x3A), *range(0x61, 0x7B)):
    _PLAIN[_c] = _c
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term, times) for each distinct term of each item."""
    found = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    rows = items.select(F.col(item).cast("long").alias("item"), F.explode(found).alias("term"))
    return rows.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


class Scanner:
    """Counts known terms in whole texts with a boundary-guarded automaton."""

    def __init__(self, terms: list[str]):
        self.n = len(terms)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, term in enumerate(terms):
            # bytes as Latin-1 characters: UTF-8 hits cannot begin inside a character
            self.automaton.add_word(b" %s ".replace(b"%s", term.encode()).decode("latin-1"), k)
        self.automaton.make_automaton()

    def count(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each row; and (row, term number, tf) of the known ones, by row."""
        rows = len(off) - 1
        lo, hi = int(off[0]), int(off[-1])
        starts = off[:-1] - lo + np.arange(1, rows + 1)  # a guard before each row, one at the end
        text = np.full(hi - lo + rows + 1, _BLANK, np.uint8)
        own = np.ones(len(text), bool)
        own[starts - 1], own[-1] = False, False
        text[own] = _PLAIN[data[lo:hi]]
        begins = np.flatnonzero((text[1:] != _BLANK) & (text[:-1] == _BLANK)) + 1
        n = np.diff(np.append(np.searchsorted(begins, starts), len(begins)))
        keys, at = [np.zeros(0, np.int64)], 0
        while self.n and at < len(text) - 1:
            cut = min(len(text), at + common.PIECE)
            if cut < len(text):  # just behind a guard, which the next piece begins with
                blanks = np.flatnonzero(text[at + 1 : cut] == _BLANK)
                cut = at + 2 + int(blanks[-1]) if len(blanks) else cut + 1 + int((text[cut:] == _BLANK).argmax())
            hits = self.automaton.iter(text[at:cut].tobytes().decode("latin-1"))
            flat = np.fromiter(itertools.chain.from_iterable(hits), np.int64)
            row = np.searchsorted(starts, flat[::2] + at, "right") - 1
            keys.append(row * self.n + flat[1::2])
            at = cut - 1
        key, tf = np.unique(np.concatenate(keys), return_counts=True)
        return n, key // max(self.n, 1), key % max(self.n, 1), tf


_scanners: dict[int, Scanner] = {}


def _scanner(number: int, terms: list[str]) -> Scanner:
    """The automaton of a broadcast, built once in each Python worker."""
    if number not in _scanners:
        _scanners.clear()
        _scanners[number] = Scanner(terms)
    return _scanners[number]


def _statistics(texts: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """Documents and terms of the corpus, and the documents that hold each known term."""

    def run(batches):
        number, terms = shared.value[:2]
        scanner = _scanner(number, terms)
        df, docs, total = np.zeros(len(terms) + 1, np.int64), 0, 0
        for batch in batches:
            data, off = common.utf8(batch.column(0))
            for lo, hi in common.row_blocks(off):
                n, _, term, _ = scanner.count(data, off[lo : hi + 1])
                docs, total = docs + int((n > 0).sum()), total + int(n.sum())
                df += np.bincount(term, minlength=len(df))
        some = np.flatnonzero(df)
        # two rows beside the terms': -2 the documents, -1 all their terms
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some]), pa.array([docs, total, *df[some]])], names=["term", "n"])

    sums = common.map_arrow(texts.select("text"), run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    found = {r[0]: r[1] for r in sums}  # at most one row per term of the automaton
    df = np.array([found.get(k, 0) for k in range(len(shared.value[1]))], np.int64)
    return found.get(-2, 0), found.get(-1, 0), df


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n + 2) / (2 * df + 1))).astype(np.int64)


def length_norm(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """100 - 25 + (25 * n * docs) div total, exactly."""
    if len(n) and int(n.max()) * docs * LENGTH_SHARE >= 1 << 63:
        return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * docs // total for x in n], np.int64)
    return 100 - LENGTH_SHARE + LENGTH_SHARE * n * docs // total


class Best:
    """The best TOP (score, id) of each item so far; ids with a flag for null."""

    def __init__(self, items: int):
        self.item, self.score, self.null, self.id = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        self.bar = np.ones(items, np.int64)  # a score has to be above 0

    def add(self, item, score, null, ids) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        null, ids = np.concatenate([self.null, null]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, null, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[rank < TOP]
        last = order[rank == TOP - 1]
        self.item, self.score, self.null, self.id = item[rank < TOP], score[keep], null[keep], ids[keep]
        self.bar[item[rank == TOP - 1]] = score[last]


def _scored(texts: DataFrame, shared, docs: int, total: int) -> DataFrame:
    """(item, doc_id, score): the best rows of each task for each item."""

    def run(batches):
        number, terms, names, first, posting, weight, exact = shared.value
        scanner, best = _scanner(number, terms), Best(len(names))
        fan = np.diff(first)
        for batch in batches:
            data, off = common.utf8(batch.column(1))
            ids = batch.column(0)
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for lo, hi in common.row_blocks(off):
                n, row, term, tf = scanner.count(data, off[lo : hi + 1])
                value = UNIT * tf // (1000 * tf + SATURATION * length_norm(n, docs, total)[row])
                # steps of whole rows, bounded in (row, item) cells and in postings
                spread = np.concatenate([[0], np.cumsum(fan[term])])
                at = 0
                while at < len(row):
                    most = int(row[at]) + max(1, CELLS // len(names))
                    end = min(int(np.searchsorted(row, most)), int(np.searchsorted(spread, spread[at] + 8 * CELLS, "right")) - 1)
                    end = max(int(np.searchsorted(row, row[end], "left")) if end < len(row) else end, int(np.searchsorted(row, row[at], "right")))
                    own, size = slice(at, end), fan[term[at:end]]
                    where = np.arange(spread[end] - spread[at]) + np.repeat(first[term[own]] - (spread[own] - spread[at]), size)
                    base = int(row[at])
                    cell = np.repeat(row[own] - base, size) * len(names) + posting[where]
                    part = np.repeat(value[own], size) * weight[where]
                    score = np.zeros((int(row[end - 1]) - base + 1) * len(names), np.int64)
                    if exact:  # every sum is below 2^53, so doubles hold it
                        score = np.bincount(cell, part, len(score)).astype(np.int64)
                    else:
                        np.add.at(score, cell, part)
                    hit = np.flatnonzero(score.reshape(-1, len(names)) >= best.bar)
                    if len(hit):
                        who = hit // len(names) + base + lo
                        best.add(hit % len(names), score[hit], null[who], ids[who])
                    at = end
        found = [
            pa.array([names[k] for k in best.item], pa.int64()),
            pa.array(best.id, pa.int64(), mask=best.null),
            pa.array(best.score, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(found, names=["item", "doc_id", "score"])

    return common.map_arrow(texts.select("doc_id", "text"), run, "item long, doc_id long, score long")


_blocks_made = itertools.count()


def _block(texts: DataFrame, rows: list) -> DataFrame | None:
    """Candidates for the items whose (item, term, times) rows these are."""
    spark = texts.sparkSession
    terms = sorted({r["term"] for r in rows})
    names = sorted({r["item"] for r in rows}, key=lambda x: (x is None, x))
    number = next(_blocks_made)
    stats = spark.sparkContext.broadcast((number, terms))
    docs, total, df = _statistics(texts, stats)
    if not total:
        return None
    term_of, item_of = {t: k for k, t in enumerate(terms)}, {x: k for k, x in enumerate(names)}
    term = np.array([term_of[r["term"]] for r in rows])
    order = np.argsort(term, kind="stable")
    posting = np.array([item_of[r["item"]] for r in rows])[order]
    weight = (np.array([r["times"] for r in rows], np.int64) * term_weights(docs, df)[term])[order]
    first = np.searchsorted(term[order], np.arange(len(terms) + 1))
    exact = bool(np.bincount(posting, weight).max() * (UNIT // 1000) < 2**53)
    shared = spark.sparkContext.broadcast((number, terms, names, first, posting, weight, exact))
    return _scored(texts, shared, docs, total)


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the TOP best documents of every item."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = common.shared_checkpoint(item_terms(items))
    blocks = -(-rows.count() // TERMS)
    found = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        own = part.collect()  # about TERMS rows: the bound of one automaton
        best = _block(texts, own) if own else None
        found = found if best is None else found.unionByName(best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS_SQL = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')"
ORACLE_OP12 = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL} AS terms FROM documents
), corpus AS (
  SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM doc WHERE len(terms) > 0
), item AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL
), tf AS (
  SELECT r, term, count(*) AS tf
  FROM (SELECT r, unnest(terms) AS term FROM doc) WHERE term IN (SELECT term FROM item) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, n_docs
), value AS (
  SELECT r, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(terms) * n_docs) // n_terms)) AS v
  FROM tf JOIN doc USING (r), corpus
), score AS (
  SELECT item_id, r, sum(times * w * v) AS score
  FROM item JOIN weight USING (term) JOIN value USING (term) GROUP BY item_id, r
), ranked AS (
  SELECT item_id, doc_id, CAST(score AS BIGINT) AS score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM score JOIN doc USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
