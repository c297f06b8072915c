"""Analyst questions over silver and gold (the dashboard's data, not its UI).

Everything is an aggregate or a top-k: only small, bounded results reach
the driver (the heatmap's ``TOP_HEATMAP_DOMAINS`` column values, used as
pivot values).  Top-k orders always end with a key so results are sets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.functions import columns as C
from riskhouse.operators import gold


def fraud_only(silver: DataFrame) -> DataFrame:
    return silver.filter(C.is_fraud()).select(S.ID, S.AMOUNT)


def legit_only(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col(S.LABEL) == F.lit(0.0)).select(S.ID, S.AMOUNT)


def distinct_segments(silver: DataFrame) -> DataFrame:
    return silver.select("card4", "card6", "P_emaildomain").distinct()


def not_sentinel(c: str) -> Column:
    return F.col(c) != F.lit(S.SENTINEL)


def card_risk_ranked(gold_card: DataFrame) -> DataFrame:
    """Networks without the sentinel, title-cased, lowest rate first."""
    return (
        gold_card.filter(not_sentinel("card4"))
        .select(C.title("card4").alias("card_network"), "fraud_rate_pct")
        .orderBy("fraud_rate_pct", "card_network")
    )


def card_type_exposure(silver: DataFrame) -> DataFrame:
    """Per card type: labelled rows, fraud, legit; types with > 10 rows."""
    total = F.count(S.LABEL)
    fraud = F.sum(S.LABEL)
    return (
        silver.groupBy("card6")
        .agg(total.alias("total"), fraud.alias("fraud"), (total - fraud).alias("legit"))
        .filter(F.col("total") > S.MIN_CARD_TYPE_ROWS)
        .select(C.title("card6").alias("card_type"), "total", "fraud", "legit")
    )


def top_fraud_domains(silver: DataFrame, k: int = S.TOP_HEATMAP_DOMAINS) -> DataFrame:
    return (
        silver.filter(C.is_fraud())
        .groupBy("P_emaildomain")
        .agg(F.count(F.lit(1)).alias("fraud_count"))
        .orderBy(F.col("fraud_count").desc(), F.col("P_emaildomain"))
        .limit(k)
    )


def _q(name: str) -> Column:
    """Column by exact name (pivot columns hold dots, e.g. d1.com)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _heat_cells(silver: DataFrame, k: int) -> DataFrame:
    """(card4, P_emaildomain, fraud_sum, labelled) of the top-k domains' cells.

    One aggregate over silver; the top domains are ranked on its small result
    and semi-joined to it, without a job in between.
    """
    cells = silver.groupBy("card4", "P_emaildomain").agg(
        F.sum(S.LABEL).alias("fraud_sum"), F.count(S.LABEL).alias("labelled"), F.count_if(C.is_fraud()).alias("_fraud")
    )
    top = (
        cells.groupBy("P_emaildomain").agg(F.sum("_fraud").alias("_n")).filter("_n > 0")
        .orderBy(F.col("_n").desc(), F.col("P_emaildomain")).limit(k)
    )
    return cells.join(top, "P_emaildomain", "left_semi").filter(not_sentinel("card4")).drop("_fraud")


def risk_heatmap_wide(silver: DataFrame, k: int = S.TOP_HEATMAP_DOMAINS) -> DataFrame:
    """Network x top-k domain fraud rate, one column per domain, empty cell = 0."""
    long = risk_heatmap(silver, k, digits=None)
    domains = [r[0] for r in long.select("P_emaildomain").distinct().orderBy("P_emaildomain").collect()]  # <= k values
    wide = long.groupBy("card4").pivot("P_emaildomain", domains).agg(F.max("fraud_rate"))
    return wide.select("card4", *[F.coalesce(_q(d), F.lit(0.0)).alias(d) for d in domains])


def risk_heatmap(silver: DataFrame, k: int = S.TOP_HEATMAP_DOMAINS, digits: int | None = 6) -> DataFrame:
    """Dense long form of the heatmap: (card4, P_emaildomain, fraud_rate).

    The cells (at most k per network) get the list of all their domains from a
    window over themselves; its elements that a network lacks are 0.
    """
    cells = _heat_cells(silver, k)
    every = F.collect_set("P_emaildomain").over(Window.partitionBy(F.lit(1)))
    rate = F.map_from_entries(
        F.collect_list(F.struct("P_emaildomain", F.try_divide("fraud_sum", "labelled")))
    )
    by_card = cells.withColumn("_all", every).groupBy("card4").agg(rate.alias("_rate"), F.first("_all").alias("_all"))
    value = F.coalesce(F.try_element_at("_rate", F.col("P_emaildomain")), F.lit(0.0))
    return by_card.select("card4", "_rate", F.explode("_all").alias("P_emaildomain")).select(
        "card4", "P_emaildomain", (value if digits is None else F.round(value, digits)).alias("fraud_rate")
    )


def amount_histogram(silver: DataFrame) -> DataFrame:
    """Counts per label and width-10 bin of min(amount, 500); 500 joins the last bin."""
    capped = F.least(F.col(S.AMOUNT), F.lit(S.HISTOGRAM_CAP))
    last = int(S.HISTOGRAM_CAP // S.HISTOGRAM_WIDTH) - 1
    b = F.least(F.floor(capped / S.HISTOGRAM_WIDTH), F.lit(last))
    return (
        silver.select(
            C.risk_label().alias("label"),
            (b * S.HISTOGRAM_WIDTH).cast("double").alias("bin_start"),
        )
        .groupBy("label", "bin_start")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def legit_sample(silver: DataFrame, n: int = S.LEGIT_SAMPLE, seed: int = S.SPLIT_SEED) -> DataFrame:
    """Seeded sample of ``n`` legit rows: smallest md5('<id>-<seed>') first."""
    return (
        silver.filter(F.col(S.LABEL) == F.lit(0.0))
        .orderBy(C.seeded_order_key(S.ID, seed))
        .limit(n)
        .select(S.ID, F.least(F.col(S.AMOUNT), F.lit(S.HISTOGRAM_CAP)).alias("amount_capped"))
    )


def tier_status_long(gold_tier: DataFrame) -> DataFrame:
    """Per tier: fraud and legit counts as rows, with the tier's display rank."""
    wide = gold_tier.select(
        F.col("amount_tier").alias("spend_range"),
        C.tier_rank("amount_tier").alias("tier_rank"),
        F.col("fraud_count").cast("long").alias(S.STATUS_FRAUD),
        (F.col("total_transactions") - F.col("fraud_count")).cast("long").alias(S.STATUS_LEGIT),
    )
    return wide.unpivot(
        ["spend_range", "tier_rank"], [S.STATUS_FRAUD, S.STATUS_LEGIT], "status", "cnt"
    )


def email_hotspots(gold_email: DataFrame, k: int = S.TOP_HOTSPOTS) -> DataFrame:
    return (
        gold_email.filter(not_sentinel("P_emaildomain"))
        .orderBy(F.col("fraud_count").desc(), F.col("P_emaildomain"))
        .limit(k)
        .select("P_emaildomain", "fraud_count", "fraud_rate_pct")
    )


def _finding(df: DataFrame, name: str, seg: Column, value: str, highest: bool) -> DataFrame:
    """Arg-max (or arg-min) row of a small gold table as (finding, segment, value).

    min_by over (-value, segment) / (value, segment): ties resolve to the
    smallest segment, and the aggregate runs partial-then-final.
    """
    v = F.col(value)
    order = F.struct((-v) if highest else v, seg)
    return df.agg(
        F.lit(name).alias("finding"),
        F.min_by(seg, order).alias("segment"),
        F.min_by(v.cast("double"), order).alias("value"),
    )


def exposure(summary: DataFrame) -> DataFrame:
    """Estimated exposure = average fraud amount x fraud count."""
    return summary.select(
        "fraud_count",
        "avg_fraud_amt",
        F.round(F.col("avg_fraud_amt") * F.col("fraud_count"), 2).alias("exposure"),
    )


def key_findings(gold_card, gold_email, gold_tier, summary) -> DataFrame:
    card = gold_card.filter(not_sentinel("card4"))
    email = gold_email.filter(not_sentinel("P_emaildomain"))
    parts = [
        _finding(card, "riskiest_card_network", C.title("card4"), "fraud_rate_pct", True),
        _finding(card, "safest_card_network", C.title("card4"), "fraud_rate_pct", False),
        _finding(email, "riskiest_email_domain", F.col("P_emaildomain"), "fraud_rate_pct", True),
        _finding(email, "most_fraud_email_domain", F.col("P_emaildomain"), "fraud_count", True),
        _finding(gold_tier, "riskiest_spend_range", F.col("amount_tier"), "fraud_rate_pct", True),
        exposure(summary).select(
            F.lit("estimated_exposure").alias("finding"),
            F.lit(None).cast("string").alias("segment"),
            F.col("exposure").alias("value"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def findings_from_rollups(rollups: DataFrame) -> DataFrame:
    """The key findings from one ``all_rollups`` result: one more aggregate over
    its few rows, instead of one pass per finding."""
    r = gold.top_domains_only(rollups).withColumn("segment", gold.segment())
    card = (F.col("gset") == "card") & (F.col("segment") != S.SENTINEL)
    email = (F.col("gset") == "email") & (F.col("segment") != S.SENTINEL)
    tier, overall = F.col("gset") == "tier", F.col("gset") == "overall"
    picks = [
        ("riskiest_card_network", card, C.title("segment"), "fraud_rate_pct", True),
        ("safest_card_network", card, C.title("segment"), "fraud_rate_pct", False),
        ("riskiest_email_domain", email, F.col("segment"), "fraud_rate_pct", True),
        ("most_fraud_email_domain", email, F.col("segment"), "fraud_count", True),
        ("riskiest_spend_range", tier, F.col("segment"), "fraud_rate_pct", True),
    ]
    rows = []
    for name, cond, seg, value, highest in picks:
        v = F.col(value).cast("double")
        best = F.min_by(F.struct(seg.alias("segment"), v.alias("value")), F.when(cond, F.struct(-v if highest else v, seg)))
        rows.append(F.struct(F.lit(name).alias("finding"), best["segment"].alias("segment"), best["value"].alias("value")))
    estimated = F.max(F.when(overall, F.round(F.col("avg_fraud_amt") * F.col("fraud_n"), 2)))
    rows.append(F.struct(F.lit("estimated_exposure").alias("finding"), F.lit(None).cast("string").alias("segment"), estimated.alias("value")))
    return r.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def top_flagged(silver: DataFrame, k: int = S.TOP_FLAGGED) -> DataFrame:
    """Largest distinct fraud transactions, relabelled for display."""
    d = (
        silver.filter(C.is_fraud())
        .select(S.AMOUNT, "card4", "card6", "P_emaildomain")
        .distinct()
        .orderBy(
            F.col(S.AMOUNT).desc(), F.col("card4"), F.col("card6"), F.col("P_emaildomain")
        )
        .limit(k)
    )
    return d.select(
        F.col(S.AMOUNT).alias("amount"),
        C.title("card4").alias("card_network"),
        C.title("card6").alias("card_type"),
        F.when(not_sentinel("P_emaildomain"), F.col("P_emaildomain"))
        .otherwise(F.lit("Unknown"))
        .alias("email_domain"),
        F.lit("Fraud").alias("status"),
    )


def headline_metrics(summary: DataFrame) -> DataFrame:
    """The headline strip; zeros when the summary is empty or has no fraud."""
    z = lambda c, v: F.coalesce(F.col(c), F.lit(v))
    return summary.select(
        z("total_transactions", 0).alias("transactions_monitored"),
        z("fraud_count", 0).alias("fraud_alerts"),
        z("legit_count", 0).alias("cleared"),
        z("fraud_rate_pct", 0.0).alias("fraud_rate_pct"),
        z("avg_transaction_amt", 0.0).alias("avg_transaction_amt"),
        z("avg_fraud_amt", 0.0).alias("avg_fraud_amt"),
    )


def headline_with_detection(summary: DataFrame, model_metrics: DataFrame) -> DataFrame:
    """Headline strip plus the best model's AUC x 100 ("detection" figure).

    The two one-row inputs are stacked and collapsed with ``max`` per column,
    which combines them without a join; no metrics -> 0.
    """
    h = headline_metrics(summary).withColumn("detection_pct", F.lit(None).cast("double"))
    d = model_metrics.agg(F.round(F.max("auc") * 100, 2).alias("detection_pct"))
    stacked = h.unionByName(d, allowMissingColumns=True)
    cols = h.columns
    out = stacked.agg(*[F.max(c).alias(c) for c in cols])
    return out.withColumn("detection_pct", F.coalesce(F.col("detection_pct"), F.lit(0.0)))


def headline_text(summary: DataFrame) -> DataFrame:
    """Headline numbers as display text: 1,234 / 2.85% / $130,239."""
    m = headline_metrics(summary)
    exp = F.round(F.col("avg_fraud_amt") * F.col("fraud_alerts"), 0).cast("long")
    return m.select(
        F.format_number("transactions_monitored", 0).alias("transactions_text"),
        F.format_number("fraud_alerts", 0).alias("alerts_text"),
        F.format_number("cleared", 0).alias("cleared_text"),
        F.format_string("%.2f%%", F.col("fraud_rate_pct")).alias("rate_text"),
        F.concat(F.lit("$"), F.format_number(exp, 0)).alias("exposure_text"),
    )


def request_form(silver: DataFrame) -> DataFrame:
    """Transactions as the scoring form shows them (display-cased choices)."""
    return silver.select(
        S.ID,
        F.col(S.AMOUNT).alias("amount"),
        C.title("card4").alias("card_network"),
        C.title("card6").alias("card_category"),
        F.when(F.col("P_emaildomain").isin(S.FORM_EMAILS), F.col("P_emaildomain"))
        .otherwise(F.lit(S.FORM_OTHER))
        .alias("email"),
    )


#: The form's further fields and the features they stand for.
_FORM_NUMBERS = {"addresses": "C1", "cards": "C2", "days_since": "D1", "card1": "card1", "card2": "card2"}


def normalize_requests(form: DataFrame) -> DataFrame:
    """Form choices -> model vocabulary: lower case, 'Other' -> unknown; numbers under their feature's name."""
    return form.select(
        S.ID,
        F.col("amount").alias(S.AMOUNT),
        F.lower("card_network").alias("card4"),
        F.lower("card_category").alias("card6"),
        F.when(F.col("email") == S.FORM_OTHER, F.lit(S.UNKNOWN))
        .otherwise(F.lower("email"))
        .alias("P_emaildomain"),
        *[F.col(c).alias(feature) for c, feature in _FORM_NUMBERS.items() if c in form.columns],
    )


def daily_exposure(silver: DataFrame) -> DataFrame:
    """Fraud amount per arrival day and its change against the previous day.

    The window runs over the per-day aggregate (one row per day), never over
    transactions.
    """
    fraud_amt = F.when(C.is_fraud(), F.col(S.AMOUNT)).otherwise(F.lit(0.0))
    d = silver.groupBy(F.to_date(S.EVENT_TIME).alias("d")).agg(
        F.round(F.sum(fraud_amt), 2).alias("exposure")
    )
    prev = F.lag("exposure").over(Window.orderBy("d"))
    return d.select(
        F.date_format("d", "yyyy-MM-dd").alias("day"),
        "exposure",
        F.round(F.col("exposure") - prev, 2).alias("change"),
    )
