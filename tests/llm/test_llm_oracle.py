"""The training-data queries with SQL against DuckDB, as the driver does it."""

import os

import pytest

import __spark_entry__ as E
from riskhouse.llm import queries
from tests.conftest import SMALL
from tests.oracle_compare import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", SMALL)


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, key):
    r = compare(spark, SF_DIR, key, queries.QUERIES[key], queries.ORACLE[key], duck(SF_DIR))
    assert r["status"] == "ok", r


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert sorted(int(k.split("_")[0][2:]) for k in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_DIR)
    rows = out.collect()
    assert all(r["round_trip"] for r in rows) and 0 < len(rows) < docs.count()
    kept = {r["doc_id"] for r in rows}
    assert len(kept) == len(rows) and kept <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, empty, SF_DIR)
        assert made.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
