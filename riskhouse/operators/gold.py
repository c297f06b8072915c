"""Silver -> gold rollups.

Each rollup is one HashAggregate (partial per map task, final after one
exchange on the group key), so skewed keys are combined before the
shuffle.  ``all_rollups`` computes the four tables in a single scan with
GROUPING SETS, which is what the batch job uses at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.functions import columns as C


def _amt():
    return F.col(S.AMOUNT)


def _lbl():
    return F.col(S.LABEL)


def _total():
    return F.count(F.lit(1)).alias("total_transactions")


def _fraud():
    return F.sum(_lbl()).alias("fraud_count")


def _avg_amt():
    return F.round(F.avg(_amt()), 2).alias("avg_transaction_amt")


def _avg_fraud_amt():
    return F.round(F.avg(F.when(C.is_fraud(), _amt())), 2).alias("avg_fraud_amt")


def _rate():
    return C.rate_pct(F.sum(_lbl()), F.count(F.lit(1))).alias("fraud_rate_pct")


def by_card_network(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("card4")
        .agg(_total(), _fraud(), _avg_amt(), _avg_fraud_amt(), _rate())
        .select(*S.GOLD_CARD_SCHEMA.fieldNames())
    )


def by_email_domain(silver: DataFrame, top: int = S.TOP_EMAIL_DOMAINS) -> DataFrame:
    """Top ``top`` domains by fraud count (ties: domain ascending)."""
    return (
        silver.groupBy("P_emaildomain")
        .agg(_total(), _fraud(), _rate(), _avg_amt())
        .orderBy(F.col("fraud_count").desc(), F.col("P_emaildomain").asc())
        .limit(top)
        .select(*S.GOLD_EMAIL_SCHEMA.fieldNames())
    )


def with_amount_tier(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_tier", C.amount_tier())


def by_amount_tier(silver: DataFrame) -> DataFrame:
    return (
        with_amount_tier(silver)
        .groupBy("amount_tier")
        .agg(_total(), _fraud(), _rate(), _avg_amt())
        .select(*S.GOLD_TIER_SCHEMA.fieldNames())
    )


def overall_summary(silver: DataFrame) -> DataFrame:
    """One row, one pass; nulls (not errors) on an empty table."""
    fraud = F.count_if(C.is_fraud())
    total = F.count(F.lit(1))
    return silver.agg(
        total.alias("total_transactions"),
        fraud.alias("fraud_count"),
        (total - fraud).alias("legit_count"),
        C.rate_pct(fraud, total).alias("fraud_rate_pct"),
        _avg_amt(),
        _avg_fraud_amt(),
    ).select(*S.GOLD_SUMMARY_SCHEMA.fieldNames())


def all_rollups(silver: DataFrame) -> DataFrame:
    """All four rollups in one scan: one row per group of each grouping set.

    ``gset`` names the set: card / email / tier / overall.  The result has
    (#networks + #domains + #tiers + 1) rows, so it is cheap to persist and
    split into the four tables.
    """
    t = with_amount_tier(silver)
    fraud = F.count_if(C.is_fraud())
    g = (
        t.groupingSets(
            [["card4"], ["P_emaildomain"], ["amount_tier"], []],
            "card4",
            "P_emaildomain",
            "amount_tier",
        )
        .agg(
            F.grouping_id().alias("_gid"),
            _total(),
            _fraud(),
            fraud.alias("fraud_n"),
            _avg_amt(),
            _avg_fraud_amt(),
            _rate(),
        )
    )
    # grouping_id bits: card4=4, P_emaildomain=2, amount_tier=1 (1 = not grouped)
    gset = (
        F.when(F.col("_gid") == 3, F.lit("card"))
        .when(F.col("_gid") == 5, F.lit("email"))
        .when(F.col("_gid") == 6, F.lit("tier"))
        .otherwise(F.lit("overall"))
    )
    return g.withColumn("gset", gset).drop("_gid")


def top_domains_only(rollups: DataFrame) -> DataFrame:
    """Rollups with the e-mail rows ranked and cut to the table's top domains.

    The window runs over rollup rows (one per group), never over transactions.
    """
    rank = F.row_number().over(
        Window.partitionBy("gset").orderBy(F.col("fraud_count").desc(), F.col("P_emaildomain").asc())
    )
    ranked = rollups.withColumn("_rank", rank)
    return ranked.filter((F.col("gset") != "email") | (F.col("_rank") <= S.TOP_EMAIL_DOMAINS)).drop("_rank")


def segment() -> Column:
    """The group key of a rollup row; null for the overall row."""
    g = F.col("gset")
    return (
        F.when(g == "card", F.col("card4"))
        .when(g == "email", F.col("P_emaildomain"))
        .when(g == "tier", F.col("amount_tier"))
    )


def rollups_long(rollups: DataFrame) -> DataFrame:
    """The four gold tables as one long table, straight from ``all_rollups``."""
    overall = F.col("gset") == "overall"
    fraud = F.when(overall, F.col("fraud_n").cast("double")).otherwise(F.col("fraud_count"))
    return top_domains_only(rollups).select(
        "gset",
        segment().alias("segment"),
        "total_transactions",
        fraud.alias("fraud_count"),
        F.when(overall, C.rate_pct(F.col("fraud_n"), F.col("total_transactions")))
        .otherwise(F.col("fraud_rate_pct"))
        .alias("fraud_rate_pct"),
        "avg_transaction_amt",
    )


def split_rollups(rollups: DataFrame) -> dict[str, DataFrame]:
    """The four gold tables from ``all_rollups`` output."""
    r = rollups
    card = r.filter(F.col("gset") == "card").select(*S.GOLD_CARD_SCHEMA.fieldNames())
    email = (
        r.filter(F.col("gset") == "email")
        .orderBy(F.col("fraud_count").desc(), F.col("P_emaildomain").asc())
        .limit(S.TOP_EMAIL_DOMAINS)
        .select(*S.GOLD_EMAIL_SCHEMA.fieldNames())
    )
    tier = r.filter(F.col("gset") == "tier").select(*S.GOLD_TIER_SCHEMA.fieldNames())
    overall = r.filter(F.col("gset") == "overall").select(
        "total_transactions",
        F.col("fraud_n").alias("fraud_count"),
        (F.col("total_transactions") - F.col("fraud_n")).alias("legit_count"),
        C.rate_pct(F.col("fraud_n"), F.col("total_transactions")).alias("fraud_rate_pct"),
        "avg_transaction_amt",
        "avg_fraud_amt",
    )
    return {
        "gold_fraud_by_card_network": card,
        "gold_fraud_by_email_domain": email,
        "gold_fraud_by_amount_tier": tier,
        "gold_overall_summary": overall,
    }


# --- incremental gold ---------------------------------------------------------
# Every rollup measure is algebraic (counts and sums), so gold can be kept as
# per-group partial sums: each silver batch contributes one small partials
# frame, and the tables are finalised from the sum of all partials -- a scan
# of a few rows per batch instead of a scan of silver.
PARTIAL_KEYS = ["gset", "card4", "P_emaildomain", "amount_tier"]
PARTIAL_SUMS = ["n", "fraud_sum", "fraud_n", "amt_sum", "amt_n", "fraud_amt_sum", "fraud_amt_n"]


def partials(silver: DataFrame) -> DataFrame:
    """Per-group sums of one silver batch, for all four grouping sets."""
    amt = _amt()
    fraud_amt = F.when(C.is_fraud(), amt)
    g = with_amount_tier(silver).groupingSets(
        [["card4"], ["P_emaildomain"], ["amount_tier"], []], "card4", "P_emaildomain", "amount_tier"
    ).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("n"),
        F.sum(_lbl()).alias("fraud_sum"),
        F.count_if(C.is_fraud()).alias("fraud_n"),
        F.sum(amt).alias("amt_sum"),
        F.count(amt).alias("amt_n"),
        F.sum(fraud_amt).alias("fraud_amt_sum"),
        F.count(fraud_amt).alias("fraud_amt_n"),
    )
    gset = (
        F.when(F.col("_gid") == 3, F.lit("card"))
        .when(F.col("_gid") == 5, F.lit("email"))
        .when(F.col("_gid") == 6, F.lit("tier"))
        .otherwise(F.lit("overall"))
    )
    return g.withColumn("gset", gset).select(*PARTIAL_KEYS, *PARTIAL_SUMS)


def summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*PARTIAL_KEYS).agg(*[F.sum(c).alias(c) for c in PARTIAL_SUMS])


def finalize(parts: DataFrame) -> DataFrame:
    """Sum all partials per group and derive the rollup measures; the result
    has the shape of ``all_rollups`` so ``split_rollups`` applies.  A group whose
    last row a later copy has taken is gone."""
    return summed(parts).filter(F.col("n") > 0).select(
        *PARTIAL_KEYS,
        F.col("n").cast("long").alias("total_transactions"),
        F.col("fraud_sum").alias("fraud_count"),
        F.col("fraud_n").cast("long").alias("fraud_n"),
        F.round(F.try_divide(F.col("amt_sum"), F.col("amt_n")), 2).alias("avg_transaction_amt"),
        F.round(F.try_divide(F.col("fraud_amt_sum"), F.col("fraud_amt_n")), 2).alias("avg_fraud_amt"),
        C.rate_pct(F.col("fraud_sum"), F.col("n")).alias("fraud_rate_pct"),
    )
