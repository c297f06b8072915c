"""The jobs end to end on sf0.001: replay -> bronze -> silver -> gold -> reports."""

import pytest
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.operators import gold, silver
from riskhouse.plans import medallion, queries
from riskhouse.session import scratch_path
from riskhouse.sources import fixtures, tables
from riskhouse.sources.tables import Lake
from tests.conftest import SMALL
from tests.test_models import QUICK


@pytest.fixture(scope="module")
def lake(spark):
    lk = Lake.fresh(spark, "test-lake")
    landing = scratch_path(spark, "test-landing")
    medallion.replay(fixtures.transactions(spark, SMALL), landing, partitions=3)
    medallion.ingest_bronze(spark, landing, lk, scratch_path(spark, "test-ckpt"))
    lk.counts = medallion.build_silver(lk)
    medallion.build_gold(lk)
    return lk


def test_observed_counts_match_quality_counts(spark, lake):
    q = silver.quality_counts(fixtures.transactions(spark, SMALL)).first()
    c = lake.counts
    assert c["bronze_rows"] == q.bronze_rows
    assert c["silver_rows"] == q.silver_rows == lake.read("silver_transactions").count()
    assert c["fraud_rows"] == q.fraud_rows and c["legit_rows"] == q.legit_rows


def test_silver_rerun_is_noop_and_full_rebuild_replaces(lake):
    n = lake.read("silver_transactions").count()
    medallion.build_silver(lake)
    assert lake.read("silver_transactions").count() == n
    medallion.build_silver(lake, incremental=False)
    assert lake.read("silver_transactions").count() == n


def test_gold_tables_equal_direct_rollups(spark, lake):
    s = silver.to_silver(fixtures.transactions(spark, SMALL))
    want = {
        "gold_fraud_by_card_network": gold.by_card_network(s),
        "gold_fraud_by_email_domain": gold.by_email_domain(s),
        "gold_fraud_by_amount_tier": gold.by_amount_tier(s),
        "gold_overall_summary": gold.overall_summary(s),
    }
    for name, df in want.items():
        assert sorted(lake.read(name).collect()) == sorted(df.collect()), name
    medallion.build_gold(lake)  # rebuilding replaces, never duplicates
    assert lake.read("gold_overall_summary").count() == 1


def test_reports_run_on_tables(lake):
    for name, df in medallion.reports(lake).items():
        assert df.count() >= 1, name


def test_table_contract(spark):
    rows = tables.contract_rows(spark).collect()
    assert {r.table_name for r in rows} == set(S.TABLES)
    silver_cols = [r.column_name for r in sorted(rows) if r.table_name == "silver_transactions"]
    assert set(silver_cols) == set(S.SILVER_COLUMNS)
    lk = Lake.fresh(spark, "contract")
    for t in S.TABLES:
        lk.create_if_absent(t)
        lk.create_if_absent(t)  # idempotent
        assert lk.read(t).schema == S.TABLES[t]
        assert lk.read(t).count() == 0


def test_train_select_score_and_headline(spark, lake):
    from riskhouse.operators import insights

    table = medallion.train(lake, QUICK)
    rows = table.collect()
    assert {r.kind for r in rows} == {"gbt", "rf", "lr"}
    assert sum(r.is_best for r in rows) == 1 and all(0.0 <= r.auc <= 1.0 for r in rows)
    best = max(r.auc for r in rows)
    scored = medallion.score(lake, lake.read("bronze_transactions").drop(S.LABEL))
    assert scored.count() == lake.read("bronze_transactions").count()
    assert scored.filter("score < 0 OR score > 1").count() == 0
    h = insights.headline_with_detection(
        lake.read("gold_overall_summary"), medallion.read_model_metrics(lake)
    ).first()
    assert h.detection_pct == round(best * 100, 2)
    assert h.transactions_monitored == lake.read("silver_transactions").count()


GOLD = ["gold_fraud_by_card_network", "gold_fraud_by_email_domain", "gold_fraud_by_amount_tier", "gold_overall_summary"]


def gold_of(lk, from_partials):
    medallion.build_gold(lk, from_partials=from_partials)
    return {n: sorted(lk.read(n).collect()) for n in GOLD}


def same(a, b):
    return all(
        len(a[n]) == len(b[n])
        and all(x == y or (isinstance(x, float) and abs(x - y) < 1e-9) for r, s in zip(a[n], b[n], strict=True) for x, y in zip(r, s, strict=True))
        for n in GOLD
    )


def test_incremental_equals_full_rebuild_of_all_bronze(spark):
    txn = fixtures.transactions(spark, SMALL)
    lk, full = Lake.fresh(spark, "inc-lake"), Lake.fresh(spark, "full-lake")
    for part in queries.deliveries(txn):
        lk.append("bronze_transactions", part)
        medallion.build_silver(lk)
    full.append("bronze_transactions", txn)
    medallion.build_silver(full, incremental=False)
    want = gold_of(full, False)
    assert sorted(lk.read("silver_transactions").collect()) == sorted(full.read("silver_transactions").collect())
    assert same(gold_of(lk, True), want) and same(gold_of(lk, False), want)
    # a rebuild of the same lake replaces the batches, and later deliveries merge into it
    medallion.build_silver(lk, incremental=False)
    assert len(lk.commits()) == 1
    lk.append("bronze_transactions", txn.limit(100))
    assert medallion.build_silver(lk)["silver_rows"] == 0
    assert same(gold_of(lk, True), want)


@pytest.mark.parametrize("table", ["silver_survivors", "gold_partials", "silver_commits"])
def test_crash_between_the_writes_of_a_batch(spark, monkeypatch, table):
    """A failure before any of a batch's writes shows nothing of it, and the re-run completes it."""
    lk, full = Lake.fresh(spark, "crash-lake"), Lake.fresh(spark, "whole-lake")
    txn = fixtures.transactions(spark, SMALL)
    first, second, _ = queries.deliveries(txn)
    lk.append("bronze_transactions", first)
    medallion.build_silver(lk)
    before = sorted(lk.read("silver_transactions").collect())
    lk.append("bronze_transactions", second)
    put, commit = Lake.put_batch, Lake.commit

    def failing_put(self, name, *a):
        if name == table:
            raise RuntimeError("lost")
        return put(self, name, *a)

    def failing_commit(self, *a, **k):
        if table == "silver_commits":
            raise RuntimeError("lost")
        return commit(self, *a, **k)

    monkeypatch.setattr(Lake, "put_batch", failing_put)
    monkeypatch.setattr(Lake, "commit", failing_commit)
    with pytest.raises(Exception, match="lost"):
        medallion.build_silver(lk)
    monkeypatch.undo()
    assert sorted(lk.read("silver_transactions").collect()) == before
    medallion.build_silver(lk)
    full.append("bronze_transactions", txn)
    medallion.build_silver(full, incremental=False)
    assert sorted(lk.read("silver_transactions").collect()) == sorted(full.read("silver_transactions").collect())
    assert same(gold_of(lk, True), gold_of(full, False))


def test_every_bad_message_is_quarantined(spark):
    lk = Lake.fresh(spark, "bad-lake")
    txn = fixtures.transactions(spark, SMALL).limit(20)
    bad = txn.withColumn(S.ID, F.lit(None).cast("double"))
    lk.append("bronze_transactions", txn.unionByName(bad).unionByName(bad))
    counts = medallion.build_silver(lk)
    assert counts["quarantined_rows"] == 40 == medallion.quarantined(lk).count()
    assert counts["bronze_rows"] == 60
