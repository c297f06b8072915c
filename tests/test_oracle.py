"""Every registered query against its DuckDB oracle (or by rows when it has none).

Runs at sf0.001 by default; set ORACLE_SF_DIR (e.g. /root/testdata/sf0.01, the
driver's scale) to run the same checks elsewhere.
"""

import os

import pytest

import __spark_entry__ as E
from riskhouse.plans import oracle, queries
from tests.conftest import SMALL
from tests.oracle_compare import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", SMALL)

QUERIES, ORACLE = queries.QUERIES, oracle.ORACLE  # the training-data queries have tests of their own
SQL_KEYS = sorted(k for k in QUERIES if k in ORACLE)
ROW_KEYS = sorted(k for k in QUERIES if k not in ORACLE)


def test_every_query_has_oracle_or_is_model_or_stream_score():
    # only fitted-model outputs go without an SQL oracle
    for k in ROW_KEYS:
        assert k.startswith(("train_", "score_", "model_", "stream_score")), k


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_DIR, key, QUERIES[key], ORACLE[key], con)
    assert r["status"] == "ok", r


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == [
        "card4",
        "total_transactions",
        "fraud_count",
        "avg_transaction_amt",
        "avg_fraud_amt",
        "fraud_rate_pct",
    ]
