"""Line dedup by prefix doubling over line-id sequences (operator 5).

A document is the sequence of its lines that are not blank.  Round k of the prefix doubling gives every position
the class of the 2^k lines that begin there: round 0 by the line's hash, round k+1 by the pair of the classes at the position and 2^k
lines on.  A class is named by its first position in the corpus (by doc_id, then line), which is the suffix array's
group of suffixes whose longest common prefix is at least 2^k lines; positions whose class has one member leave, since they begin
no repeated run of that length.  A run of any length L from 2^k to 2^(k+1) is named by two classes of round k, of its first and its last
2^k lines, which overlap.

A run of lines that stands earlier in the corpus too is a later copy, and all its lines are deleted if it has MIN_CHARS characters or more (a
lone short line repeats by chance); the first copy of every run stays.  Every part of a later copy is one, so the lines to delete are
those in later copies that cannot lose their first or their last line without falling below MIN_CHARS: at most two such
runs end or begin at a line, none is longer than MIN_CHARS lines, and the rounds end there.

Edge cases: a null text has no lines and stays null; blank lines take no part and stay; rows equal in doc_id and text are the
same document and keep the same lines; a null doc_id comes after all others; equal ids with different texts are told apart by the
text's hash; an empty table gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm.common import documents, packed, shared_checkpoint, unpacked

MIN_CHARS = 20
_AT = ["_d", "_t", "i"]


_SOLID = r"[^\x20\x09-\x0D]"


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.withColumns({"_d": F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)), "_t": F.xxhash64(text)})


def _classes(rows: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """The rows of classes with two members or more, with the class's first position as fd, ft, fi, and the columns ``keep``.

    Map tasks combine first, so a common line costs a row per task; the join back deals out a hot class as any skewed join.
    """
    first = rows.groupBy(*by).agg(F.min(F.struct(*_AT)).alias("f"), F.count("*").alias("n_rows")).where("n_rows > 1")
    first = first.select(*by, F.col("f._d").alias("nd"), F.col("f._t").alias("nt"), F.col("f.i").alias("ni"))
    return rows.join(first, by).select(*_AT, *keep, F.col("nd").alias("fd"), F.col("nt").alias("ft"), F.col("ni").alias("fi"))


def _least(sizes, begin, end, step: int):
    """Number of lines from ``begin`` on (backwards: step -1) to ``end`` that make up MIN_CHARS characters; null if they do not."""
    part = F.slice(sizes, begin, end - begin + 1)
    part = F.reverse(part) if step < 0 else part
    grown = F.aggregate(
        part,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
        lambda a, x: F.when(a["sum"] >= MIN_CHARS, a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["sum"] + x).alias("sum"))),
    )
    return F.when(grown["sum"] >= MIN_CHARS, grown["n"])


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """A row a line: _d, _t, i (among lines that are not blank), line, h, g; ``ahead``, ``back``: lengths of
    the least runs of MIN_CHARS characters that begin and end there (null: none)."""
    solid = F.filter(F.transform(F.split(text, "\n", -1), lambda s, n: F.struct(n.alias("line"), s.alias("s"))), lambda x: x["s"].rlike(_SOLID))
    rows = _keyed(docs, text, key).select("_d", "_t", solid.alias("x")).withColumn("c", F.transform("x", lambda x: F.length(x["s"])))
    rows = rows.select("_d", "_t", "c", F.posexplode("x").alias("i", "x"))
    i, size = F.col("i"), F.length("x.s")
    ahead = _least(F.col("c"), i + 1, F.least(i + MIN_CHARS, F.size("c")), 1)
    back = _least(F.col("c"), F.greatest(i + 2 - MIN_CHARS, F.lit(1)), i + 1, -1)
    one = size >= MIN_CHARS  # nearly all lines
    return rows.select(
        *_AT, F.col("x.line").alias("line"), F.xxhash64("x.s").alias("h"), F.hash("x.s").alias("g"),
        F.when(one, 1).otherwise(ahead).alias("ahead"), F.when(one, 1).otherwise(back).alias("back"),
    )


def later_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, list[DataFrame]]:
    """The lines that repeat (_d, _t, i, line, ahead, back), and for each round k the least runs (_d, _t, i, n) of
    2^k to 2^(k+1) - 1 lines that are later copies."""
    window = shared_checkpoint(_classes(_lines(docs, text, key), ["h", "g"], ["line", "ahead", "back"]).dropDuplicates(_AT))
    base = window.drop("fd", "ft", "fi")
    runs = base.where("ahead > 1").select(*_AT, F.col("ahead").alias("n"))
    runs = runs.union(base.where("back > 1").select("_d", "_t", (F.col("i") - F.col("back") + 1).alias("i"), F.col("back").alias("n"))).distinct()
    later = F.struct(*_AT) > F.struct(F.col("fd"), F.col("ft"), F.col("fi"))
    found = [window.where((F.col("ahead") == 1) & later).select(*_AT, F.lit(1).alias("n"))]
    lines, classes = 1, ["fd", "ft", "fi"]
    while lines <= MIN_CHARS:
        then = window.select("_d", "_t", F.col("i").alias("_j"), *[F.col(c).alias("g" + c) for c in classes])
        if lines > 1:  # runs of lines + 1 to 2 lines - 1; of exactly ``lines`` too
            own = runs.where(F.col("n").between(lines, 2 * lines - 1))
            own = own.join(window.select(*_AT, *classes), _AT).withColumn("_j", F.col("i") + F.col("n") - lines)
            named = _classes(own.join(then, ["_d", "_t", "_j"]), ["n", *classes, *["g" + c for c in classes]], ["n"])
            found.append(named.where(later).select(*_AT, "n"))
        if 2 * lines > MIN_CHARS:
            break
        pairs = window.select(*_AT, *classes).withColumn("_j", F.col("i") + lines).join(then, ["_d", "_t", "_j"])
        window, lines = shared_checkpoint(_classes(pairs, [*classes, *["g" + c for c in classes]], [])), 2 * lines
        if window.isEmpty():
            break
    return base, found


def removed_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_d, _t, removed): line numbers from 0, in order, that later copies of runs cover, by document."""
    base, found = later_runs(docs, text, key)
    hit = found[0]
    for more in found[1:]:
        hit = hit.unionByName(more)
    covered = hit.select("_d", "_t", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("n") - 1)).alias("i")).distinct()
    covered = covered.join(base.select(*_AT, "line"), _AT)
    return covered.groupBy("_d", "_t").agg(F.array_sort(F.collect_list("line")).alias("removed"))


def kept_text(text, removed):
    """The text without the lines numbered in ``removed`` (in order; null: none)."""
    lines = F.split(text, "\n", -1)
    begin = lambda j: F.when(j == 0, 0).otherwise(F.get(removed, j - 1) + 1)
    end = lambda j: F.coalesce(F.get(removed, j), F.size(lines))
    between = F.transform(F.sequence(F.lit(0), F.size(removed)), lambda j: F.slice(lines, begin(j) + 1, end(j) - begin(j)))
    return F.when(removed.isNull(), text).otherwise(F.array_join(F.flatten(between), "\n"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with later copies of runs taken out of ``text``, and removed_lines (array of int, null if none)."""
    docs = docs.drop("removed_lines")
    own = packed(docs, [key, text])
    removed = removed_lines(own, text, key)
    out = _keyed(own, text, key).join(removed, ["_d", "_t"], "left").withColumn(text, kept_text(F.col(text), F.col("removed")))
    return out.transform(lambda x: unpacked(x, docs, F.col("removed").alias("removed_lines")))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_removed, the numbers of the removed lines, and the digest of the kept text (null text: null)."""
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.coalesce(F.size("removed_lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed_lines").cast("array<string>"), ","), F.lit("")).alias("removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def keep_deduplicated(docs: DataFrame) -> DataFrame:
    """Pipeline stage: texts without later copies; a document of which nothing but blanks is left goes."""
    own = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    out = dedup_lines(packed(docs, own))
    emptied = F.col("removed_lines").isNotNull() & ~F.col("text").rlike(_SOLID)
    out = out.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in own:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("removed_lines").isNotNull(), size).otherwise(F.col("n_chars")))
    return unpacked(out, docs)


def _oracle() -> str:
    """Runs of every length by their texts in DuckDB's SQL (a line has a character, so longer ones add nothing); ids are unique there."""
    windows = " UNION ALL ".join(
        f"SELECT doc_id, i, {n} AS n, array_to_string(own[i : i + {n - 1}], chr(10)) AS w FROM (SELECT doc_id, own, unnest(generate_series(1, len(own) - {n - 1})) AS i FROM seq)"
        for n in range(1, MIN_CHARS + 5)
    )
    return f"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS every FROM documents
), seq AS (
  SELECT doc_id, text, every, list_filter(generate_series(1, len(every)), lambda j: regexp_matches(every[j], '[^\x20\x09-\x0D]')) AS at,
         list_filter(every, lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS own FROM split
), windows AS ({windows}
), later AS (
  SELECT doc_id, i, n FROM (SELECT doc_id, i, n, w, min(struct_pack(d := doc_id, i := i)) OVER (PARTITION BY n, w) AS f FROM windows)
  WHERE (doc_id > f.d OR (doc_id = f.d AND i > f.i)) AND length(w) - (n - 1) >= {MIN_CHARS}
), covered AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS i FROM later
), gone AS (
  SELECT c.doc_id, list_sort(list(s.at[c.i] - 1)) AS removed FROM covered c JOIN seq s ON c.doc_id = s.doc_id GROUP BY c.doc_id
)
SELECT s.doc_id, CAST(coalesce(len(g.removed), 0) AS BIGINT) AS n_removed, coalesce(array_to_string(g.removed, ','), '') AS removed,
  sha256(CASE WHEN g.removed IS NULL THEN s.text ELSE array_to_string(list_filter(list_transform(generate_series(1, len(s.every)),
    lambda j: CASE WHEN list_contains(g.removed, j - 1) THEN NULL ELSE s.every[j] END), lambda x: x IS NOT NULL), chr(10)) END) AS kept_sha256
FROM seq s LEFT JOIN gone g ON s.doc_id = g.doc_id
"""


ORACLE_OP5 = _oracle()
