"""Invariants of the cleaning and the rollups."""

import pytest
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.functions import columns as C
from riskhouse.operators import gold, insights, metrics, silver
from riskhouse.sources import fixtures
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def silver_df(spark):
    return silver.to_silver(fixtures.transactions(spark, SMALL)).cache()


def test_silver_ids_unique_and_typed(silver_df):
    n = silver_df.count()
    assert silver_df.select(S.ID).distinct().count() == n
    assert dict(silver_df.dtypes)[S.ID] == "int"
    assert silver_df.columns == S.SILVER_COLUMNS


def test_rollups_sum_to_overall(silver_df):
    total = silver_df.count()
    fraud = silver_df.filter(C.is_fraud()).count()
    for t in (gold.by_card_network(silver_df), gold.by_amount_tier(silver_df)):
        r = t.agg(F.sum("total_transactions"), F.sum("fraud_count")).first()
        assert r[0] == total and r[1] == fraud
    ct = insights.card_type_exposure(silver_df).agg(F.sum("total"), F.sum("fraud"), F.sum("legit")).first()
    assert ct[0] == total and ct[1] == fraud and ct[2] == total - fraud
    o = gold.overall_summary(silver_df).first()
    assert o.total_transactions == total and o.fraud_count + o.legit_count == total


def test_single_scan_rollups_equal_separate(silver_df):
    parts = gold.split_rollups(gold.all_rollups(silver_df))
    pairs = {
        "gold_fraud_by_card_network": gold.by_card_network(silver_df),
        "gold_fraud_by_email_domain": gold.by_email_domain(silver_df),
        "gold_fraud_by_amount_tier": gold.by_amount_tier(silver_df),
        "gold_overall_summary": gold.overall_summary(silver_df),
    }
    for name, df in pairs.items():
        assert sorted(parts[name].collect()) == sorted(df.collect()), name


def test_email_top20_tie_break(silver_df):
    rows = gold.by_email_domain(silver_df).collect()
    assert len(rows) == S.TOP_EMAIL_DOMAINS
    keys = [(-r.fraud_count, r.P_emaildomain) for r in rows]
    everything = gold.by_email_domain(silver_df, top=1000).collect()
    assert keys == sorted((-r.fraud_count, r.P_emaildomain) for r in everything)[:20]


def test_tier_boundaries(spark):
    amounts = [0.0, 25.0, 25.01, 50.0, 50.01, 100.0, 100.01, 200.0, 200.01, 500.0, 500.01,
               1000.0, 1000.01, None, float("nan")]
    df = spark.createDataFrame([(a,) for a in amounts], f"{S.AMOUNT} double")
    got = [r[0] for r in df.select(C.amount_tier()).collect()]
    assert got == ["$0-25", "$0-25", "$25-50", "$25-50", "$50-100", "$50-100", "$100-200",
                   "$100-200", "$200-500", "$200-500", "$500-1K", "$500-1K", "$1K+", "$1K+", "$1K+"]


def test_heatmap_cells_and_wide_form(silver_df):
    long = insights.risk_heatmap(silver_df).collect()
    assert long and all(0.0 <= r.fraud_rate <= 1.0 for r in long)
    wide = insights.risk_heatmap_wide(silver_df)
    domains = [c for c in wide.columns if c != "card4"]
    assert 0 < len(domains) <= S.TOP_HEATMAP_DOMAINS
    assert wide.count() * len(domains) == len(long)
    assert "0" not in [r.card4 for r in wide.collect()]


def test_summary_on_empty_and_no_fraud_tables(spark):
    empty = spark.createDataFrame([], S.SILVER_SCHEMA)
    r = gold.overall_summary(empty).first()
    assert r.total_transactions == 0 and r.fraud_rate_pct is None and r.avg_fraud_amt is None
    h = insights.headline_metrics(gold.overall_summary(empty)).first()
    assert h.transactions_monitored == 0 and h.fraud_rate_pct == 0.0
    legit = spark.createDataFrame(
        [(1, 0.0, 1.0, 10.0, "W", 1.0, 1.0, "visa", "debit", "a.com", 1.0, 1.0, 1.0, None, "LEGIT", "x")],
        S.SILVER_SCHEMA,
    )
    c = gold.by_card_network(legit).first()
    assert c.fraud_count == 0.0 and c.avg_fraud_amt is None and c.fraud_rate_pct == 0.0


def test_dedup_survivor_is_latest_then_largest(spark):
    rows = [
        (7.0, 0.0, 1.0, 10.0, "W", 3.0, None, None, None, None, 1.0, 1.0, 1.0, "2024-01-01 00:00:00"),
        (7.0, 1.0, 1.0, 20.0, "W", 3.0, None, None, None, None, 1.0, 1.0, 1.0, "2024-01-02 00:00:00"),
        (7.0, 0.0, 1.0, 99.0, "W", 3.0, None, None, None, None, 1.0, 1.0, 1.0, "2024-01-02 00:00:00"),
        (8.0, 0.0, 1.0, 5.0, "W", 3.0, None, None, None, None, 1.0, 1.0, 1.0, "2024-01-01 00:00:00"),
    ]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.MESSAGE_SCHEMA.fields)
    df = spark.createDataFrame(rows, schema + ", ts string").withColumn(
        S.EVENT_TIME, F.col("ts").cast("timestamp")).drop("ts")
    out = {r[S.ID]: r for r in silver.deduplicate(df).collect()}
    assert out[7.0][S.AMOUNT] == 99.0 and out[8.0][S.AMOUNT] == 5.0
    # carrying fewer columns does not change the survivor (no exact ties here)
    slim = {r[S.ID]: r for r in silver.deduplicate(df, [S.LABEL]).collect()}
    assert slim[7.0][S.LABEL] == out[7.0][S.LABEL]
    assert silver.deduplicate(df, [S.LABEL]).columns == [S.ID, S.LABEL]


def test_hot_id_dedup(spark):
    """One id holding a third of the rows: one survivor, the latest arrival."""
    n = 3000
    rows = [
        (1.0 if i % 3 == 0 else float(i + 10), float(i), f"2024-01-01 00:00:{i % 60:02d}")
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, f"{S.ID} double, {S.AMOUNT} double, ts string").select(
        S.ID, S.AMOUNT, F.lit(7.0).alias("card1"), F.col("ts").cast("timestamp").alias(S.EVENT_TIME)
    ).repartition(8)
    d = silver.deduplicate(df, with_copies=True)
    hot = d.filter(F.col(S.ID) == 1.0).first()
    assert hot.copies == n // 3
    latest = max(i for i in range(0, n, 3) if i % 60 == max(j % 60 for j in range(0, n, 3)))
    assert hot[S.AMOUNT] == float(latest)
    assert d.count() == n - n // 3 + 1


def test_split_exact_for_any_bucket_size(silver_df):
    from riskhouse.operators import features

    a = features.stratified_split(silver_df.select(S.ID, S.LABEL), hex_digits=1)
    b = features.stratified_split(silver_df.select(S.ID, S.LABEL), hex_digits=4)
    assert sorted(a.collect()) == sorted(b.collect())


def test_auc_exact_for_any_bucket_count(spark, silver_df):
    from riskhouse.operators import metrics

    # many distinct scores, like a model's probabilities
    scored = silver_df.select(
        S.LABEL, (F.col(S.AMOUNT) / 3000.0 + F.col("D1") / 50.0).alias("score")
    )
    got = {b: metrics.roc_auc(scored, buckets=b).first().auc for b in (2, 17, 256)}
    rows = scored.collect()
    pos = [r.score for r in rows if r[S.LABEL] == 1.0]
    neg = sorted(r.score for r in rows if r[S.LABEL] == 0.0)
    import bisect

    wins = sum(bisect.bisect_left(neg, p) + 0.5 * (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p)) for p in pos)
    brute = round(wins / (len(pos) * len(neg)), 6)
    assert set(got.values()) == {brute}


def test_auc_ranks_missing_scores_lowest(spark):
    rows = [(1.0, float("nan")), (0.0, 0.2), (1.0, 0.9), (0.0, None), (0.0, -5.0)]
    df = spark.createDataFrame(rows, f"{S.LABEL} double, score double")
    # positives: NaN (ties with the null, below the rest) and 0.9 (above all)
    assert metrics.roc_auc(df).first()["auc"] == round((0.5 + 3) / 6, 6)
