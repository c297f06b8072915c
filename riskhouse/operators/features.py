"""Feature preparation: projection, imputation, split, weights (encoding: ``dictionary``).

The exact stratified split is distributed: rows are ordered inside each
class by a seeded md5 key, but instead of one window per class (a single
task per class) the key's leading hex digits cut each class into
``16**hex_digits`` buckets.  A small per-(class, bucket) histogram gives
every bucket its offset; the window then only ranks inside one bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.functions import columns as C
from riskhouse.operators import silver

NUMERIC_NULL = -999.0
CATEGORY_NULL = "nan"


def raw_features(deduped: DataFrame) -> DataFrame:
    """Id, those of the model features that the rows have, and label of deduplicated rows, before any fill."""
    good, _ = silver.split_quarantine(deduped)
    return good.select(S.ID, *[c for c in S.FEATURES if c in good.columns], S.LABEL)


def impute(df: DataFrame, categorical=S.CATEGORICAL) -> DataFrame:
    """Categories: text with 'nan' for missing; numbers: -999 for null / NaN."""
    cats = [c for c in categorical if c in df.columns]
    nums = [c for c in df.columns if c not in cats and c not in (S.ID, S.LABEL)]
    out = df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(CATEGORY_NULL)) for c in cats}
    )
    return out.fillna(NUMERIC_NULL, subset=nums)


def split_key(seed: int = S.SPLIT_SEED):
    return C.seeded_order_key(S.ID, seed)


def stratified_split(
    df: DataFrame,
    train_pct: int = int(S.TRAIN_FRACTION * 100),
    seed: int = S.SPLIT_SEED,
    hex_digits: int = 4,
    label: str = S.LABEL,
) -> DataFrame:
    """Adds ``split`` = train/test: per class, the first ceil(n_c * pct / 100)
    rows in seeded-key order are train.  Exact, and no task holds a class."""
    key = split_key(seed)
    # Non-null join keys: no filter gets inferred into one branch only, so
    # both uses of ``t`` keep the same plan and share its exchanges.
    t = df.withColumns(
        {
            "_key": key,
            "_c": F.coalesce(F.col(label).cast("double"), F.lit(-1.0)),
        }
    ).withColumn(
        "_b", F.coalesce(F.conv(F.substring("_key", 1, hex_digits), 16, 10).cast("int"), F.lit(0))
    )
    hist = t.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.select(
        "_c",
        "_b",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy("_c")).alias("_cls"),
    )
    ranked = t.join(hist, ["_c", "_b"]).withColumn(
        "_rank",
        F.col("_off")
        + F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_key", S.ID)),
    )
    n_train = F.floor((F.col("_cls") * train_pct + 99) / 100)
    return ranked.withColumn(
        "split", F.when(F.col("_rank") <= n_train, F.lit("train")).otherwise(F.lit("test"))
    ).drop("_key", "_c", "_b", "_off", "_cls", "_rank")


def stable_split(df: DataFrame, train_pct: int = int(S.TRAIN_FRACTION * 100), seed: int = S.SPLIT_SEED) -> DataFrame:
    """Adds ``split`` by a threshold on the seeded key: no shuffle, about ``train_pct`` percent of any class, and a
    row keeps its side when the table grows (the exact split moves rows near its cut)."""
    place = F.conv(F.substring(split_key(seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("split", F.when(place * 100 < (1 << 32) * train_pct, F.lit("train")).otherwise(F.lit("test")))


def split_counts(split_df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return split_df.groupBy(label, "split").agg(F.count(F.lit(1)).alias("cnt"))


def class_weights(train: DataFrame, label: str = S.LABEL) -> DataFrame:
    """neg, pos, neg/pos weight for positives, and 'balanced' n / (2 n_c)."""
    neg = F.count_if(F.col(label) == 0.0)
    pos = F.count_if(F.col(label) == 1.0)
    n = F.count(F.lit(1))
    return train.agg(
        neg.alias("neg"),
        pos.alias("pos"),
        F.round(F.try_divide(neg, pos), 6).alias("pos_weight"),
        F.round(F.try_divide(n, neg * 2), 6).alias("balanced_neg"),
        F.round(F.try_divide(n, pos * 2), 6).alias("balanced_pos"),
    )


def with_weights(df: DataFrame, scheme: str, label: str = S.LABEL) -> DataFrame:
    """Per-row training weight from the class counts of ``df`` itself.

    scheme 'ratio': positives get neg/pos, negatives 1; 'balanced':
    n / (2 n_c).  The class counts are one global aggregate; its single row
    (three numbers) becomes literals of the weight expression.
    """
    if scheme not in ("ratio", "balanced"):
        return df.withColumn("weight", F.lit(1.0))
    w = class_weights(df, label).first()
    if scheme == "ratio":
        pos_w, neg_w = w["pos_weight"], 1.0
    else:
        pos_w, neg_w = w["balanced_pos"], w["balanced_neg"]
    expr = F.when(F.col(label) == 1.0, F.lit(pos_w or 1.0)).otherwise(F.lit(neg_w or 1.0))
    return df.withColumn("weight", expr.cast("double"))


def label_rate(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return df.agg(F.round(F.avg(label), 6).alias("rate"))
