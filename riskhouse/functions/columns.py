"""Column expressions shared by the operators.  All built-in, JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskhouse import schemas as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_fraud(label: str | Column = S.LABEL) -> Column:
    return col(label) == F.lit(1.0)


def risk_label(label: str | Column = S.LABEL) -> Column:
    """FRAUD when the label is 1, else LEGIT (a null label counts as LEGIT)."""
    return F.when(is_fraud(label), F.lit(S.FRAUD)).otherwise(F.lit(S.LEGIT))


def row_hash(*cols: str) -> Column:
    """md5 of the fields' text joined by '_' (null fields are skipped)."""
    return F.md5(F.concat_ws("_", *[F.col(c).cast("string") for c in cols]))


def amount_tier(amount: str | Column = S.AMOUNT) -> Column:
    """Upper-inclusive spend tier; null / NaN / above the last bound -> last tier."""
    a = col(amount)
    branches = list(zip(S.TIER_BOUNDS, S.TIER_LABELS))
    first_bound, first_label = branches[0]
    expr = F.when(a <= first_bound, F.lit(first_label))
    for bound, label in branches[1:]:
        expr = expr.when(a <= bound, F.lit(label))
    return expr.otherwise(F.lit(S.TIER_LABELS[-1]))


def tier_rank(tier: str | Column = "amount_tier") -> Column:
    """Position of a tier label in the declared tier order (0-based)."""
    t = col(tier)
    expr = reduce(
        lambda acc, il: acc.when(t == il[1], F.lit(il[0])),
        list(enumerate(S.TIER_LABELS))[1:],
        F.when(t == S.TIER_LABELS[0], F.lit(0)),
    )
    return expr


def rate_pct(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """round(num / den * 100, scale); null instead of an error on den = 0."""
    return F.round(F.try_divide(numerator, denominator) * F.lit(100), scale)


def title(c: str | Column) -> Column:
    return F.initcap(col(c))


def seeded_order_key(id_col: str | Column = S.ID, seed: int = S.SPLIT_SEED) -> Column:
    """Engine-independent pseudo-random order: md5 of '<int id>-<seed>'."""
    return F.md5(F.concat(col(id_col).cast("int").cast("string"), F.lit(f"-{seed}")))
