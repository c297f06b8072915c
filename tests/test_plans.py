"""Physical-plan properties that matter at scale (checked on the plans, not data)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from riskhouse import schemas as S
from riskhouse.operators import gold, insights, silver
from riskhouse.plans import incremental, oracle, queries
from riskhouse.sources import fixtures
from riskhouse.sources.tables import Lake
from tests.conftest import SMALL

# Keys whose plan is built without running jobs first (no streams, models, writes).
WRITES = ("stream_", "csv_", "parquet_glob", "gold_overwrite", "gold_incremental", "silver_append", "silver_quarantine", "replay_capped")
JOBS = ("roc_auc", "label_encode", "comparison_fixed_scores", "metrics_roundtrip", "headline_detection", "assembled_features", "saved_model_scores",
        "tree_table_scores", "fit_certificates", "auc_by_round")
PLAN_ONLY = [k for k in oracle.ORACLE if not k.startswith(WRITES) and k not in JOBS]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", PLAN_ONLY)
def test_no_cartesian_or_nested_loop_join(spark, key):
    p = plan(E.queries()[key](spark, SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dedup_combines_map_side(spark):
    p = plan(silver.deduplicate(fixtures.transactions(spark, SMALL), [S.LABEL]))
    # partial aggregate below the shuffle on the id, final above it
    assert re.search(r"partial_max\(struct", p)
    assert p.index("Exchange hashpartitioning(TransactionID") < p.index("partial_max")


def test_rollup_reads_only_needed_columns(spark):
    df = E.queries()["gold_card_network"](spark, SMALL)
    p = formatted(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    for unused in ("l_partkey", "l_quantity", "l_discount", "l_linestatus"):
        assert unused not in schema
    assert "partial_count" in p and "partial_sum" in p


def test_filters_reach_the_silver_scan(spark):
    lake = Lake.fresh(spark, "plan-lake")
    incremental.merge_batch(lake, fixtures.transactions(spark, SMALL), "a")
    s = lake.read("silver_transactions")
    p = formatted(insights.fraud_only(s))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(isFraud,1\.0\)", p)
    assert re.search(r"ReadSchema: struct<TransactionID:int,isFraud:double,TransactionAmt:double>", p)


def test_single_scan_gold(spark):
    lake = Lake.fresh(spark, "plan-lake2")
    incremental.merge_batch(lake, fixtures.transactions(spark, SMALL), "a")
    p = plan(gold.all_rollups(lake.read("silver_transactions")))
    assert p.count("FileScan") == 1 and "Expand" in p


def test_registered_rollups_and_findings_finish_the_dedup_once(spark):
    for key in ("gold_rollups_single_scan", "key_findings"):
        p = plan(queries.QUERIES[key](spark, SMALL))
        assert p.count("Expand [") == 1 and p.count("partial_max(struct") == 1, key


def test_heatmap_runs_no_job_while_it_is_planned(spark):
    sc = spark.sparkContext
    sc.setJobGroup("heatmap-plan", "planning")
    queries.QUERIES["risk_heatmap"](spark, SMALL)
    jobs = sc.statusTracker().getJobIdsForGroup("heatmap-plan")
    sc.setJobGroup("tests", "")
    # reading a parquet footer may be a job; a query over the rows is not run
    assert len(jobs) <= 1


def test_single_rollups_carry_their_own_columns_only(spark):
    p = plan(queries.QUERIES["estimated_exposure"](spark, SMALL))
    assert "card4" not in p and "P_emaildomain" not in p


def test_top_k_is_distributed(spark):
    s = silver.to_silver(fixtures.transactions(spark, SMALL), [S.LABEL, S.AMOUNT])
    assert "TakeOrderedAndProject" in plan(insights.legit_sample(s))
    assert "TakeOrderedAndProject" in plan(gold.by_email_domain(
        silver.to_silver(fixtures.transactions(spark, SMALL), ["P_emaildomain", S.LABEL, S.AMOUNT])))


def test_no_python_udfs_in_queries(spark):
    for key in PLAN_ONLY:
        p = plan(E.queries()[key](spark, SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key
