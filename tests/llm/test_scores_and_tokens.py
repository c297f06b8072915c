"""Operators 11 to 13 against brute force on small tables, with nulls, empties, ties, repeats and clashing columns."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskhouse.llm import common, crosstok, quality, search
from tests.llm.test_llm import DOCS, prose, saved, table

MIXED = [
    "the cat sat", "The CAT, the cat; the dog", None, "", "...", "naïve café 123abc", "x" * 5000, "a\nb\tc  d", "the cat sat",
    "zero\x00byte", "don't 'stop' it's", "日本語のテキスト and English", "emoji 👩‍👩‍👧 flag 🇫🇷", "tab\t\tspace   three", "ﬁ ligature № x²", " leading and trailing ",
    "under▁bar", "<unk> <s> <|endoftext|> </s>", "é́ combining", "word " * 300 + "end",
]


# --- 11: cross-tokenizer alignment --------------------------------------------------


def libraries():
    """The two tokenizers, straight from their libraries: ids and token bytes."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letter = {}
    free = 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            letter[chr(b)] = b
        else:
            letter[chr(free)], free = b, free + 1
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def left(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(letter[c] for c in a.id_to_token(i)) for i in ids]

    def right(text):
        ids = b.encode(text)
        names = [b.id_to_piece(i) for i in ids]
        return ids, [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x..>", n) else n.replace("▁", " ").encode() for n in names]

    return left, right


def brute_alignment(texts):
    """The contract's numbers from the definition: all pairs of overlapping byte ranges."""
    left, right = libraries()
    counts, rows = collections.Counter(), []
    for text in texts:
        if not text:
            rows.append(None)
            continue
        (a, a_bytes), (b, b_bytes) = left(text), right(text)
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            rows.append(None)
            continue
        a_end, b_end = list(itertools.accumulate(map(len, a_bytes))), list(itertools.accumulate(map(len, b_bytes)))
        cuts = sorted(set(a_end) & set(b_end))
        groups, links = [], []
        for lo, hi in zip([0, *cuts], cuts, strict=False):
            own_a = [k for k, e in enumerate(a_end) if lo < e <= hi]
            own_b = [k for k, e in enumerate(b_end) if lo < e <= hi]
            groups.append((own_a, own_b))
            links += [(i, j) for i in own_a for j in own_b if a_end[i] - len(a_bytes[i]) < b_end[j] and b_end[j] - len(b_bytes[j]) < a_end[i]]
        text_form = ";".join(",".join(str(a[i]) for i in x) + "|" + ",".join(str(b[j]) for j in y) for x, y in groups)
        rows.append((len(a), len(b), len(groups), [(a[i], b[j]) for i, j in links], hashlib.sha256(text_form.encode()).hexdigest()))
        counts.update(rows[-1][3])
    top = collections.defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((*r[:3], len(r[3]), sum(counts[p] == top[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4]))
    return out


def test_alignment_equals_brute_force(spark):
    rng = random.Random(11)
    texts = MIXED + [prose(k, 60, 300) for k in range(10)]
    texts += ["".join(rng.choice("ab cé\n,.1 'st▁世") for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    wanted = brute_alignment(texts)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    pair = crosstok.public_pair(spark)
    docs = table(spark, texts).withColumn("row", F.lit("x")).withColumn("n_a", F.lit("x")).repartition(3)
    for most in (crosstok.PAIRS, 200):  # the counts of the pairs in one block, and in several
        got = {r["doc_id"]: tuple(r[c] for c in columns) for r in crosstok.alignment_statistics(docs, pair, most).collect()}
        assert got == dict(enumerate(wanted))


def test_alignment_groups_are_the_text(spark):
    pair = crosstok.public_pair(spark)
    left, right = pair.load()
    names = [[t.table[s : s + n].tobytes() for s, n in zip(t.starts, t.sizes, strict=True)] for t in (left.tokens, right.tokens)]
    rows = crosstok.align(table(spark, MIXED), pair).collect()
    assert len(rows) == len(MIXED) and sum(bool(r["a_ids"]) for r in rows) >= 14
    for r in rows:
        text, i, j = (" " + (MIXED[r["doc_id"]] or "")).encode(), 0, 0
        for x, y in zip(r["a_ends"], r["b_ends"], strict=True):
            part = b"".join(names[0][k] for k in r["a_ids"][i:x])
            assert part and part == b"".join(names[1][k] for k in r["b_ids"][j:y]) and text.startswith(part)
            text, i, j = text[len(part) :], x, y
        assert (text == b"" and (i, j) == (len(r["a_ids"]), len(r["b_ids"]))) or not r["a_ids"]


def test_runs_are_skipped_and_equal_the_common_ends():
    rng = np.random.default_rng(3)
    for density in (0.2, 0.9, 0.999):
        last = 20_000
        a, b = (np.append(np.flatnonzero(rng.random(last) < density), last) + 1 for _ in range(2))
        both = rng.random(last) < 0.9
        b = np.union1d(b[:-1][~both[b[:-1] - 1]], np.append(a[:-1][both[a[:-1] - 1]], last + 1))
        runs, links, closes = crosstok.skip_runs(a, b)
        ends = np.concatenate([np.repeat(a[runs[:, 0]], 1) if len(runs) else [], []])
        inside = np.concatenate([a[i : i + n] for i, _, n in runs]) if len(runs) else np.zeros(0, int)
        assert all((a[i : i + n] == b[j : j + n]).all() for i, j, n in runs) and len(ends) == len(runs)
        assert np.array_equal(np.sort(np.concatenate([inside, a[closes[:, 0] - 1]])), np.intersect1d(a, b))
        assert len(links) + len(inside) == len(np.union1d(a, b))  # one link for each stretch between ends
        # a run ends where the diagonal does: two runs never touch
        assert not any(p[0] + p[2] == q[0] and p[1] + p[2] == q[1] for p, q in itertools.pairwise(runs.tolist()))


def test_long_texts_in_pieces_are_tokenized_alike(spark):
    pair = crosstok.public_pair(spark)
    left, right = pair.load()
    rng = random.Random(4)
    long = " ".join("".join(rng.choice("abcé1,.'\n ") for _ in range(rng.randrange(1, 9))) for _ in range(3000))
    assert len(crosstok.pieces(long, 500)) > 10
    one, cut = crosstok.Block(left, right, [long, "a b"], 1 << 40), crosstok.Block(left, right, [long, "a b"], 500)
    for name in ("a", "b", "a_of", "b_of", "group_a", "group_b", "n_links"):
        assert np.array_equal(getattr(one, name), getattr(cut, name)), name
    assert one.group_digests() == cut.group_digests()
    assert crosstok.pieces("x" * 1000, 10) == ["x" * 1000]


def test_very_long_text_is_aligned(spark):
    text = prose(7, 400_000, 5000) + " " + "z" * 200_000
    row = crosstok.align(table(spark, [text]), crosstok.public_pair(spark)).select(F.size("a_ids"), F.size("a_ends")).first()
    assert row[0] > 400_000 and row[1] > 300_000


# --- 12: ranked lexical search ------------------------------------------------------


def terms(text):
    return re.findall(search.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items):
    """docs, items: (id, text) lists."""
    held = [(i, collections.Counter(t)) for i, x in docs if (t := terms(x))]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    wanted = collections.defaultdict(collections.Counter)
    for i, x in items:
        wanted[i].update(terms(x))
    out = []
    for item, need in wanted.items():
        scores = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in need.items() if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores)[:20], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    texts = MIXED + [prose(k, 40, 60) for k in range(60)] + [prose(1, 40, 60)] * 30
    docs = [(k, t) for k, t in enumerate(texts)] + [(3, prose(5, 30, 60)), (None, prose(6, 30, 60)), (None, prose(6, 30, 60))]
    items = [(k, prose(100 + k, 8, 60)) for k in range(6)] + [(7, "The cat, the CAFÉ café"), (8, None), (9, ""), (10, "absent"), (None, "w1 w2"), (1, "w3 w3")]
    df = spark.createDataFrame([(i, t, "x", "x") for i, t in docs], "doc_id long, text string, item string, score string").repartition(4)
    wanted = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    if small:  # several automatons, pieces of a few terms, tables of a few rows
        monkeypatch.setattr(search, "TERMS", 20)
        monkeypatch.setattr(search, "CELLS", 16)
        monkeypatch.setattr(common, "PIECE", 50)
        scanner = search.Scanner(["cat", "the", "café"])
        data, off = common.utf8(pa.array(MIXED))
        n, row, term, tf = scanner.count(data, off)
        assert n.tolist() == [len(terms(t)) for t in MIXED]
        own = [collections.Counter(terms(t)) for t in MIXED]
        assert {(r, k): c for r, k, c in zip(row.tolist(), term.tolist(), tf.tolist(), strict=True)} == {
            (r, k): c[w] for r, c in enumerate(own) for k, w in enumerate(["cat", "the", "café"]) if c[w]
        }
    assert found(search.search(df, wanted)) == brute_search(docs, items)


def test_search_empty_tables_and_many_repeats(spark):
    docs, items = table(spark, ["a b", "a"] * 100), spark.createDataFrame([(1, "a b"), (2, "b")], "item_id long, text string")
    got = found(search.search(docs, items))
    assert got == brute_search([(k, t) for k, t in enumerate(["a b", "a"] * 100)], [(1, "a b"), (2, "b")])
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(table(spark, [None, "", "--"]), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0


def test_search_of_a_very_long_text(spark):
    text = "needle " + prose(3, 600_000, 500) + " needle"
    rows = found(search.search(table(spark, [text, "needle", "other"]), spark.createDataFrame([(1, "needle")], "item_id long, text string")))
    assert rows == brute_search([(0, text), (1, "needle"), (2, "other")], [(1, "needle")])


def test_length_norm_does_not_overflow():
    n, docs, total = np.array([10**9, 7]), 10**12, 10**15
    assert search.length_norm(n, docs, total).tolist() == [75 + 25 * 10**9 * 10**12 // 10**15, 75]


# --- 13: quality --------------------------------------------------------------------


def plain_statistics(text):
    """Some of the statistics, from their names."""
    text = text or ""
    raw = text.encode()
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not raw:
        return dict.fromkeys(quality.NAMES, 0.0)
    lines = [" ".join(x) for x in (re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), y)) for y in text.split("\n")) if x]
    grams = [tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    n, share = max(len(w), 1), lambda p: len(re.findall(p, raw)) / len(raw)
    return {
        "upper_share": share(rb"[A-Z]"), "digit_share": share(rb"[0-9]"), "high_share": share(rb"[\x80-\xff]"), "newline_share": share(rb"\n"),
        "stop_share": share(rb"[.!?]"), "symbol_share": share(rb"[#$%&*+/<=>@\[\\\]^_`{|}~]"), "blank_share": share(rb"[ \t\x0b-\r]"),
        "log_words": math.log1p(len(w)), "log_lines": math.log1p(len(lines)), "distinct_words": len(set(w)) / n, "top_word": max(collections.Counter(w).values(), default=0) / n,
        "repeated_next": sum(x == y for x, y in itertools.pairwise(w)) / n, "distinct_triples": len(set(grams)) / max(len(grams), 1),
        "distinct_lines": len(set(lines)) / max(len(lines), 1), "top_line": max(collections.Counter(lines).values(), default=0) / max(len(lines), 1),
        "capital_words": len(re.findall(rb"(?<![^\x20\x09-\x0d])[A-Z]", raw)) / n, "stopped_words": len(re.findall(rb"[.!?](?![^\x20\x09-\x0d])", raw)) / n,
        "upper_pairs": len(re.findall(rb"(?<=[A-Z])[A-Z]", raw)) / len(raw), "short_words": len(re.findall(rb"(?<![^\x20\x09-\x0d])[^\x20\x09-\x0d](?![^\x20\x09-\x0d])", raw)) / n,
    }


def test_statistics_equal_plain_counts():
    rng = random.Random(13)
    texts = MIXED + ["a A a\nb b\na A a\n\n", "\n", " ", "A"] + ["".join(rng.choice("aB .#é\n1") for _ in range(rng.randrange(60))) for _ in range(200)]
    data, off = common.utf8(pa.array(texts))
    got = quality.statistics(data, off)
    assert got.shape == (len(texts), len(quality.NAMES)) and np.isfinite(got).all()
    for text, row in zip(texts, got, strict=True):
        for name, value in plain_statistics(text).items():
            assert row[quality.NAMES.index(name)] == pytest.approx(value), (name, text)
    one = np.concatenate([quality.statistics(data, off[k : k + 2]) for k in range(len(texts))])
    assert np.allclose(one, got)  # a text's statistics do not depend on its block


def test_trees_fit_and_flatten():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 6)).round(1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.HistogramTrees(rounds=60).fit(x, y)
    p = trees.predict(x)
    assert ((p >= 0.5) == y).mean() > 0.98
    # the flat walk of all trees at once, against a walk of one row and tree at a time
    for k in range(0, 3000, 137):
        raw = trees.base
        for root in trees.roots:
            at = root
            while trees.left[at] != at:
                at = trees.left[at] if x[k, trees.feature[at]] <= trees.cut[at] else trees.right[at]
            raw += trees.value[at]
        assert p[k] == pytest.approx(1 / (1 + math.exp(-raw)))


def test_child_histograms_are_differences():
    rng = np.random.default_rng(6)
    slot = rng.integers(0, quality.BINS, (500, 4)) + np.arange(4) * quality.BINS
    g, h, side = rng.normal(size=500), rng.random(500), rng.random(500) < 0.3
    trees = quality.HistogramTrees()
    whole, part, rest = (trees._histogram(slot[r], g[r], h[r]) for r in (slice(None), side, ~side))
    assert np.allclose(whole - part, rest)


def test_quality_held_out(spark):
    root = "/root/testdata/sf0.01"
    rows = quality.op13_quality(spark, root).join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    share = {q: [r["predicted"] == q for r in rows if r["quality"] == q] for q in (0, 1)}
    assert min(len(s) for s in share.values()) > 10 and all(sum(s) / len(s) >= 0.9 for s in share.values())


def test_quality_edges(spark, tmp_path):
    texts = MIXED + ["good text here"] * 5
    docs = table(spark, texts).withColumn("statistics", F.lit("x")).withColumn("label", F.lit("x"))
    root = saved(spark, tmp_path, docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))))
    labels = "doc_id long, quality int, toxic int"
    for rows, wanted in (([], 0.0), ([(0, 1, 0), (1, None, 0), (None, 0, 0)], 1.0), ([(0, 0, 0), (99, 1, 0)], 0.0)):
        saved(spark, tmp_path, spark.createDataFrame(rows, labels), "labels")
        got = quality.op13_quality(spark, root).collect()
        assert len(got) == len(texts) + 1 and {r["score"] for r in got} == {wanted}
    saved(spark, tmp_path, spark.createDataFrame([(k, k % 2, 0) for k in range(len(texts))] + [(0, 1, 1)], labels), "labels")
    got = quality.op13_quality(spark, root).collect()
    assert len(got) == len(texts) + 1 and all(0 <= r["score"] <= 1 for r in got)
    same = {r["score"] for r in got if r["doc_id"] is not None and r["doc_id"] >= len(MIXED)}
    assert len(same) == 1  # repeated rows
    saved(spark, tmp_path, docs.limit(0))
    assert quality.op13_quality(spark, root).count() == 0


def test_quality_sample_is_bounded(spark):
    docs = table(spark, [prose(k, 5) for k in range(2000)])
    labels = spark.range(2000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    n = quality.sample(docs.unionByName(docs), labels, F.lit(True), "quality", 300).count()
    assert 200 < n < 400


def test_empty_tables_and_nulls(spark, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    pair = crosstok.public_pair(spark)
    assert crosstok.alignment_statistics(empty, pair).count() == 0 and crosstok.align(empty, pair).count() == 0
    nothing = spark.createDataFrame([(None, None, None, None, None)] * 3, DOCS)
    rows = crosstok.alignment_statistics(nothing, pair).collect()
    assert [(r["doc_id"], r["n_a"], r["n_links"], r["groups_sha256"]) for r in rows] == [(None, 0, 0, "")] * 3
