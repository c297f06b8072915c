"""Benchmark decontamination by spaced seeds (operator 4), DataFrame functions only.

A spaced seed hashes the words under the 1s of a mask at each position of a text and ignores those under the 0s, so a
hit survives substituted words.  Hits of the texts' seeds on the benchmark's give an alignment (item, shift); around it
the words are compared one by one, and a document is contaminated if some WINDOW aligned words (the whole item if it
is shorter) have SHARE of them equal.  MASKS hit every such window of MIN_WORDS words or more, whichever words are replaced; TEN
is added for items of ten words, which it takes for one pattern.  Items of fewer than MIN_WORDS words are found where all their words stand
in order: the mask of their length has no 0.  Only masks that some item needs are tried on the texts.

Seeds carry their item's number and place, not its words, which the hits fetch afterwards; they are broadcast only while there are at most
BROADCAST_SEEDS of them (their number is counted first, some 30 bytes each); beyond that they are joined by a shuffle.  The texts are read
in one pass without a shuffle.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Edge cases: null and empty texts hit nothing; an item without a word
contaminates nothing; repeated items and documents are judged alike; a document with several
alignments to an item counts once with its best; an empty benchmark contaminates nothing, and an empty table of documents gives an empty result; a null id is
kept as null; other columns pass through the stage, and take no part otherwise, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm.common import documents, packed, unpacked

#: The masks; 1 is compared, 0 ignored.
MASKS = ["111011", "1101011", "11001101"]
TEN = "11111"
WINDOW, SHARE, MIN_WORDS = 13, 0.8, 8
BROADCAST_SEEDS = 2_000_000


def masks_of(size: int) -> list[str]:
    """The masks that find an item of ``size`` words."""
    if size < MIN_WORDS:
        return ["1" * size]
    return [*MASKS, TEN] if size == 10 else MASKS


def needed(size):
    """Equal words that a window of an item of ``size`` words must have."""
    return F.when(size < MIN_WORDS, size).otherwise(F.ceil(F.least(F.lit(WINDOW), size) * SHARE))


def words(text):
    """Array of the words of a text column."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.regexp_replace(lower, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+")


def _seed(mask: str, w, i):
    """Hash of the words under a mask at position i (from 0); null where the mask does not fit."""
    picked = [F.get(w, i + j) for j, c in enumerate(mask) if c == "1"]
    return F.when(i + len(mask) <= F.size(w), F.xxhash64(F.lit(mask), *picked))


def _exploded(rows: DataFrame, columns: list[str], keep: list[str], masks: list[str], fits=None) -> DataFrame:
    """A row for each position and mask that fits: the columns (of w only if it is to be kept), i and seed.
    ``fits``: a mask's condition on the row."""
    at = rows.select(*columns, F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)))).alias("i"))
    kept = [c for c in columns if c != "w" or "w" in keep]
    seeds = [_seed(m, F.col("w"), F.col("i")) if fits is None else F.when(fits(m), _seed(m, F.col("w"), F.col("i"))) for m in masks]
    return at.select(*kept, "i", F.explode(F.array(*seeds)).alias("seed")).where("seed is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, _t, item_id, start_word, n_equal): the best verified alignment of each contaminated document with each item.

    _t is the text's hash, to tell documents of one id apart; start_word is where the item's first word falls (it may be
    negative); n_equal the number of equal words of the item there.
    """
    items = benchmark.where("text is not null").select("item_id", words(F.col("text")).alias("w")).where("w[0] <> ''").distinct()
    items = items.withColumn("item_no", F.xxhash64("item_id", "w"))  # repeated ids may have different texts
    sizes = {r[0] for r in items.select(F.least(F.size("w"), F.lit(WINDOW))).distinct().collect()}  # at most WINDOW numbers
    masks = sorted({m for n in sizes for m in masks_of(n)})
    if not masks:
        return docs.select(key, F.xxhash64(text).alias("_t")).limit(0).join(benchmark.select("item_id").limit(0)).withColumns({"start_word": F.lit(0), "n_equal": F.lit(0)})
    size = F.least(F.size("w"), F.lit(WINDOW))
    fits = lambda m: size.isin([n for n in sizes if m in masks_of(n)])
    seeds = _exploded(items, ["item_no", "w"], [], masks, fits).select("seed", "item_no", F.col("i").alias("item_at")).distinct()
    rows = docs.select(key, F.xxhash64(text).alias("_t"), words(F.col(text)).alias("w"))
    at = (F.col("i") - F.col("item_at")).alias("shift")
    few = seeds.count() <= BROADCAST_SEEDS
    if few:
        hits = _exploded(rows, [key, "_t", "w"], ["w"], masks).join(F.broadcast(seeds), "seed").select(key, "_t", "w", "item_no", at)
    else:
        # only positions travel; the hits fetch their texts afterwards
        hits = _exploded(rows, [key, "_t", "w"], [], masks).join(seeds.hint("merge"), "seed").select(F.col(key).alias("k"), F.col("_t").alias("x"), "item_no", at).distinct()
        hits = hits.join(rows.dropDuplicates([key, "_t"]).hint("merge"), F.col(key).eqNullSafe(F.col("k")) & F.col("_t").eqNullSafe(F.col("x")))
    hits = hits.join(items.select("item_no", "item_id", F.col("w").alias("item")), "item_no")
    # the words that the text has beside the item; one row for an alignment.  The comparison stands behind this grouping, so
    # that the join before it stays one generated loop, which does not copy a text for each of its positions.
    beside = F.slice("w", F.greatest("shift", F.lit(0)) + 1, F.size("item") + F.least("shift", F.lit(0)))
    hits = hits.select(key, "_t", "item_no", "item_id", "shift", beside.alias("beside"), "item")
    hits = hits.groupBy(key, "_t", "item_no", "item_id", "shift").agg(F.first("beside").alias("beside"), F.first("item").alias("item"))
    # 1 for each word of the item that the text has beside it
    at = lambda j: j + F.least("shift", F.lit(0))
    equal = F.transform("item", lambda x, j: F.when((at(j) >= 0) & F.get("beside", at(j)).eqNullSafe(x), F.lit(1)).otherwise(F.lit(0)))

    def step(s, x):
        bits = (s["bits"] * 2 + x).bitwiseAND(F.lit(2**WINDOW - 1))
        return F.struct(bits.alias("bits"), F.greatest(s["most"], F.bit_count(bits)).alias("most"), (s["n"] + x).alias("n"))

    # the last WINDOW words as bits, the most of them that were equal so far, and all equal words
    seen = F.aggregate(equal, F.struct(F.lit(0).alias("bits"), F.lit(0).alias("most"), F.lit(0).alias("n")), step)
    good = hits.select(key, "_t", "item_id", "shift", F.size("item").alias("size"), seen.alias("seen"))
    good = good.where(F.col("seen.most") >= needed(F.col("size")))
    good = good.select(key, "_t", "item_id", F.struct(F.col("seen.n").alias("n"), (-F.col("shift")).alias("s")).alias("best"))
    good = good.groupBy(key, "_t", "item_id").agg(F.max("best").alias("best"))
    return good.select(key, "_t", "item_id", (-F.col("best.s")).alias("start_word"), F.col("best.n").alias("n_equal"))


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the items found in them."""
    found = overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("_t")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: the documents that no item contaminates."""
    own = packed(docs, ["doc_id", "text"])
    bad = overlaps(own, benchmark).select(F.col("doc_id").alias("_d"), F.col("_t").alias("_x")).distinct()
    kept = own.join(bad, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_x")), "left_anti")
    return unpacked(kept, docs)


def _oracle() -> str:
    """The definition, without seeds: alignments with enough equal words at all, then their windows."""
    lower = "string_split_regex(regexp_replace(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '[\\x20\\x09-\\x0D]+')"
    need = f"CASE WHEN len(w) < {MIN_WORDS} THEN len(w) ELSE CAST(ceil(least({WINDOW}, len(w)) * {SHARE}) AS BIGINT) END"
    return f"""
WITH d AS (SELECT doc_id, {lower.format(t="coalesce(text, '')")} AS w FROM documents
), b AS (SELECT DISTINCT item_id, w, {need} AS need FROM (SELECT item_id, {lower.format(t="text")} AS w FROM benchmark WHERE text IS NOT NULL) WHERE w[1] <> ''
), dw AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d
), bw AS (SELECT item_id, w, need, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM b
), alike AS (
  SELECT doc_id, item_id, bw.w AS item, dw.i - bw.i AS shift FROM dw JOIN bw USING (x) GROUP BY ALL HAVING count(*) >= any_value(need)
), compared AS (
  SELECT doc_id, item_id, shift,
    list_transform(generate_series(1, len(item)), lambda j: CASE WHEN shift + j >= 1 AND d.w[shift + j] = item[j] THEN 1 ELSE 0 END) AS equal
  FROM alike JOIN d USING (doc_id)
), verified AS (
  SELECT doc_id, item_id, shift, list_sum(equal) AS n,
    list_max(list_transform(generate_series(1, len(equal) - least({WINDOW}, len(equal)) + 1), lambda a: list_sum(equal[a : a + least({WINDOW}, len(equal)) - 1]))) AS most,
    CASE WHEN len(equal) < {MIN_WORDS} THEN len(equal) ELSE ceil(least({WINDOW}, len(equal)) * {SHARE}) END AS needed FROM compared
)
SELECT doc_id, item_id, CAST(-max_best.s AS INTEGER) AS start_word, CAST(max_best.n AS INTEGER) AS n_equal
FROM (SELECT doc_id, item_id, max(struct_pack(n := n, s := -shift)) AS max_best FROM verified WHERE most >= needed GROUP BY doc_id, item_id)
"""


ORACLE_OP4 = _oracle()
