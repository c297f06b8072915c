"""Personal data: high-recall candidates judged by boosted trees, beside exact base patterns (operator 9).

Base spans (email, ip, card, phone) come from fixed patterns and checks and always stay.
Generators of high recall propose further, overlapping spans: emails without a dot in the
domain or spelled out ("x at y dot com"), dotted and grouped digits of any length, and long
tokens of letters and digits after words such as ``password`` (kind ``secret``).  Boosted
trees score each candidate by its format (lengths, character shares, groups, checksum,
entropy) and context (hint words and characters around it).  They learn from all
candidates with weak labels: base spans and hinted secrets are
positive, other candidates without a hint negative, the rest unlabelled.  A quarter of
them, by hash, is held out, and each kind's threshold is the smallest score whose precision
on all of that part reaches PRECISION.  Fit and thresholds run on Spark (``trees``, ``ordered``);
equal candidates are one row with their number.  Accepted candidates that overlap no base span, the best of overlapping ones,
are added.

Positions are code points, the end exclusive.  Null and empty texts have no spans; repeated
rows are judged alike; the patterns take time in proportion to the text, so very long texts
and very long runs of one character class are no special case.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common
from riskhouse.llm.trees import BoostedTrees
from riskhouse.operators.ordered import running

KINDS = ["email", "ip", "card", "phone", "secret"]
#: Precision that a threshold has to reach, in percent.
PRECISION = 97
#: Words that announce personal data.
HINTS = {
    "email": ["mail", "e-mail", "email", "courriel", "correo", "contact"],
    "ip": ["ip", "host", "server", "address"],
    "card": ["card", "visa", "mastercard", "carte", "karte", "tarjeta"],
    "phone": ["phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "telefono"],
    "secret": ["password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "key"],
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a start inside a run of digits gives a match only if the run's start does
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64} (?:at|\(at\)|\[at\]) [A-Za-z0-9-]{1,64} (?:dot|\(dot\)|\[dot\]) [A-Za-z]{2,24}")
_DIGITS = re.compile(r"[0-9][0-9A-Za-z]{7,}")
_WORD_BEFORE = re.compile(r"([A-Za-z_-]+)[\s:=\"'(]*\Z")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str, domain: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        m = domain.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)  # no later match can reach back over this @
        at = text.find("@", max(last, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text, _DOMAIN)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _only_digits(m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_only_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = set(base)
    if "@" in text:
        found.update((0, a, b) for a, b in _emails(text, _LOOSE_DOMAIN))
    if any(x in text for x in (" dot ", "(dot)", "[dot]")):
        found.update((0, m.start(), m.end()) for m in _SPELLED.finditer(text))
    found.update((1, m.start(), m.end()) for m in _IP.finditer(text))
    for m in _CARD.finditer(text):
        n = m.end() - m.start()
        if n >= 7:
            found.add((2 if n >= 12 else 3, m.start(), m.end()))
    if "+" in text:
        found.update((3, m.start(), m.end()) for m in _PHONE.finditer(text))
    last = 0
    for m in _DIGITS.finditer(text):
        begin = m.start()
        while begin > last and text[begin - 1].isascii() and text[begin - 1].isalnum():
            begin -= 1
        last = m.end()
        if any(c.isalpha() for c in text[begin : m.end()]):
            found.add((4, begin, m.end()))
    return sorted(found)


def _features(text: str, kind: int, begin: int, end: int) -> list[float]:
    span = text[begin : min(end, begin + 256)]
    n, digits = len(span), _only_digits(span)
    shares = [sum(f(c) for c in span) / n for f in (str.isalpha, str.isupper, lambda c: c in " ().-", lambda c: c in "0123456789abcdefABCDEF")]
    entropy = -sum(v / n * math.log(v / n) for v in Counter(span).values())
    parts = span.split(".")
    octets = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    before = text[max(0, begin - 40) : begin]
    m = _WORD_BEFORE.search(before)
    word = m[1].lower() if m else ""
    hint = [float(word in HINTS[k]) for k in KINDS]
    edge = [float(bool(before) and before[-1] in s) for s in ("=\"':", "0123456789.-")]
    follow = text[end : end + 1]
    return [
        float(kind), float(end - begin), float(len(digits)), *shares, entropy, float(span.count(".")), float(span.count("@")), float(span.startswith("+")),
        float(octets), float(13 <= len(digits) <= 19 and _luhn(digits)), float(9 <= len(digits) <= 15), *hint, *edge, float(follow.isalnum()),
    ]


def _weak_label(kind: int, features: list[float], is_base: bool) -> int:
    """1, 0 or -1 (unlabelled): hints are the five values after the format features."""
    hints = features[14:19]
    if is_base or (kind == 4 and hints[4] and features[1] >= 12):
        return 1
    return -1 if any(hints) or kind == 4 else 0


def propose(df: DataFrame, text: str = "text") -> DataFrame:
    """Replaces ``text`` by base (spans as text), counts, and candidates with their features and weak labels."""
    df = df.drop("base_spans", "n_base", "candidates", "spans")
    at = df.columns.index(text)
    rest = [c for c in df.columns if c != text]
    item = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("label", pa.int32()), ("x", pa.list_(pa.float32()))])

    def run(batches):
        for batch in batches:
            values = batch.column(at).to_pylist()
            off = np.concatenate([[0], np.cumsum([len(v or "") for v in values])]).astype(np.int64)
            for lo, hi in common.row_blocks(off):
                spans, counts, cands = [], [], []
                for value in values[lo:hi]:
                    value = value or ""
                    base = base_spans(value)
                    spans.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base))
                    counts.append([sum(k == j for k, _, _ in base) for j in range(4)])
                    own, rows = set(base), []
                    for k, a, b in _candidates(value, base):
                        x = _features(value, k, a, b)
                        rows.append({"kind": k, "start": a, "stop": b, "label": _weak_label(k, x, (k, a, b) in own), "x": x})
                    cands.append(rows)
                part = batch.slice(lo, hi - lo).drop_columns([text])
                names = [*part.schema.names, "base_spans", "n_base", "candidates"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, pa.string()), pa.array(counts, pa.list_(pa.int64())), pa.array(cands, pa.list_(item))], names=names)

    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in rest)
    schema += "base_spans string, n_base array<long>, candidates array<struct<kind:int,start:int,stop:int,label:int,x:array<float>>>"
    return common.map_arrow(df, run, schema)


def fit(proposed: DataFrame) -> tuple[BoostedTrees | None, list[float]]:
    """Trees, and a threshold for each kind (2.0: nothing is accepted)."""
    c = proposed.select(F.explode("candidates").alias("c")).select("c.*").where("label >= 0")
    held = F.xxhash64("kind", "start", "stop", "x") % 4 == 0
    rows = common.shared_checkpoint(c.groupBy("kind", "label", "x", held.alias("held")).agg(F.count(F.lit(1)).alias("n")))
    limits = [2.0] * len(KINDS)
    if rows.where(~F.col("held")).agg(F.count_distinct("label")).first()[0] < 2:
        return None, limits
    model = BoostedTrees().fit(rows.where(~F.col("held")), rows.select(F.size("x")).first()[0])
    for kind, limit in thresholds(_predicted(rows.where("held"), model)).collect():  # a row a kind
        limits[kind] = max(0.5, limit)
    return model, limits


def _predicted(rows: DataFrame, model: BoostedTrees) -> DataFrame:
    """kind, label, n and the score p."""

    def run(batches):
        for batch in batches:
            x = batch.column("x").to_pylist()
            p = model.predict(np.array(x, np.float64)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("label"), batch.column("n"), pa.array(p, pa.float64())], names=["kind", "label", "n", "p"])

    return common.map_arrow(rows, run, "kind int, label int, n long, p double")


def thresholds(scored: DataFrame) -> DataFrame:
    """(kind, limit): the smallest score of a kind down to which, equal scores included, at least PRECISION percent are of label 1."""
    by_score = scored.groupBy("kind", (-F.col("p")).alias("order")).agg(F.sum(F.col("n") * (100 * F.col("label") - PRECISION)).alias("over"))
    reached = running(by_score, ["kind"], ["order"], F.col("over"), "before").where(F.col("before") + F.col("over") >= 0)
    return reached.groupBy("kind").agg(F.max("order").alias("order")).select("kind", (-F.col("order")).alias("limit"))


def redact_spans(proposed: DataFrame, model: BoostedTrees | None, limits: list[float]) -> DataFrame:
    """Adds ``spans``: base spans and accepted candidates, by kind and start."""
    i, j = proposed.columns.index("base_spans"), proposed.columns.index("candidates")

    def run(batches):
        for batch in batches:
            base, cands, out = batch.column(i).to_pylist(), batch.column(j).to_pylist(), []
            flat = [(r, c) for r, row in enumerate(cands) for c in row or []]
            p = model.predict(np.array([c["x"] for _, c in flat], np.float64)) if flat and model else np.zeros(len(flat))
            added: dict[int, list] = {}
            for (r, c), q in zip(flat, p, strict=True):
                if q >= limits[c["kind"]]:
                    added.setdefault(r, []).append((-float(q), c["kind"], c["start"], c["stop"]))
            for r, text in enumerate(base):
                own = [(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in (text or "").split(",") if s)]
                if r in added:
                    # intervals taken so far, which do not overlap, by start
                    taken = _merged([(a, b) for _, a, b in own])
                    for _, k, a, b in sorted(added[r]):
                        at = bisect_left(taken, (a, a))
                        if (at == len(taken) or taken[at][0] >= b) and (at == 0 or taken[at - 1][1] <= a):
                            taken.insert(at, (a, b))
                            own.append((k, a, b))
                out.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(own)))
            kept = batch.drop_columns(["candidates"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(out, pa.string())], names=[*kept.schema.names, "spans"])

    schema = proposed.drop("candidates").withColumn("spans", F.lit("")).schema
    return common.map_arrow(proposed, run, schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without ``text``, with base_spans, n_base (email, ip, card, phone) and spans."""
    proposed = common.shared_checkpoint(propose(docs, text))
    return redact_spans(proposed, *fit(proposed))


def op9_pii(spark, sf_dir: str) -> DataFrame:
    found = find_spans(common.documents(spark, sf_dir).select("doc_id", "text"))
    counts = [F.col("n_base")[k].alias(f"n_{KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")
