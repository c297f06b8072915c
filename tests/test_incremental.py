"""Named batches of silver: commits, races, lost checkpoints, folding, buckets and the continuous service."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.operators import gold, silver
from riskhouse.plans import incremental, medallion, queries
from riskhouse.session import scratch_path
from riskhouse.sources import fixtures, messages
from riskhouse.sources.tables import CommitRace, Lake
from riskhouse.streaming import ingest
from tests.conftest import SMALL
from tests.test_medallion import gold_of, same


def silver_of(lake):
    return sorted(lake.read("silver_transactions").collect())


@pytest.fixture(scope="module")
def txn(spark):
    path = scratch_path(spark, "txn")
    fixtures.transactions(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def whole(spark, txn):
    lake = Lake.fresh(spark, "whole")
    lake.append("bronze_transactions", txn)
    medallion.build_silver(lake, incremental=False)
    return silver_of(lake), gold_of(lake, False)


def test_groups_that_lose_their_last_row_are_gone(spark, txn, whole):
    lake = Lake.fresh(spark)
    for part in (queries.retired(txn), txn):
        lake.append("bronze_transactions", part)
        medallion.build_silver(lake)
    assert lake.read("gold_partials").where("card4 = 'retired network'").count() > 0
    assert silver_of(lake) == whole[0] and same(gold_of(lake, True), whole[1])


def test_new_silver_checkpoint_loses_nothing(spark, txn, whole, monkeypatch):
    lake = Lake.fresh(spark)
    first, second, _ = queries.deliveries(txn)
    lake.append("bronze_transactions", first)
    medallion.build_silver(lake)
    path = Lake.path
    monkeypatch.setattr(Lake, "path", lambda self, t: path(self, "silver_checkpoint_2" if t == "silver_checkpoint" else t))
    lake.append("bronze_transactions", second)
    assert medallion.build_silver(lake)["bronze_rows"] == txn.count()  # all of bronze once more
    assert silver_of(lake) == whole[0] and same(gold_of(lake, True), whole[1])


def test_new_bronze_checkpoint_keeps_old_batches(spark, txn):
    lake, landing, other = Lake.fresh(spark), scratch_path(spark, "land"), scratch_path(spark, "land")
    messages.publish(messages.to_messages(txn.limit(50)), landing)
    messages.publish(messages.to_messages(txn.limit(70)), other)
    ingest.run(ingest.start_bronze(lake, landing, scratch_path(spark, "c")))
    ingest.run(ingest.start_bronze(lake, other, scratch_path(spark, "c")))  # epoch 0 once more
    assert lake.read("bronze_transactions").count() == 120


def test_repeated_bronze_batch_is_left_alone(spark, txn, monkeypatch):
    """A micro-batch whose commit was lost after its writes runs again: bronze keeps its files, no message counts twice."""
    lake, landing, ckpt = Lake.fresh(spark), scratch_path(spark, "land"), scratch_path(spark, "c")
    msgs = messages.to_messages(txn.limit(40)).withColumn("value", F.when(F.col("key").cast("int") % 2 == 0, "no json").otherwise(F.col("value")))
    messages.publish(msgs, landing)
    put = Lake.put_bronze

    def lost(self, *a):
        put(self, *a)
        raise RuntimeError("lost")

    monkeypatch.setattr(Lake, "put_bronze", lost)
    with pytest.raises(Exception, match="lost"):
        ingest.run(ingest.start_bronze(lake, landing, ckpt))
    monkeypatch.undo()
    files = set(lake.read("bronze_transactions").inputFiles())
    medallion.build_silver(lake)
    ingest.run(ingest.start_bronze(lake, landing, ckpt))
    counts = medallion.build_silver(lake)
    assert set(lake.read("bronze_transactions").inputFiles()) == files and counts["bronze_rows"] == 0
    bad = medallion.quarantined(lake).collect()
    assert len(bad) == msgs.where("value = 'no json'").count() and {(r.raw, r.reason) for r in bad} == {("no json", S.REJECT_MALFORMED)}


def test_rebuild_beside_a_stream_batch(spark, txn, whole, monkeypatch):
    """A batch is committed between a rebuild's reading and its commit: the rebuild reads bronze again."""
    lake = Lake.fresh(spark)
    first, second, _ = queries.deliveries(txn)
    lake.append("bronze_transactions", first)
    medallion.build_silver(lake)
    commit, raced = Lake.commit, []

    def late(self, batches, after):
        if batches[-1][0].startswith("full-") and not raced:
            raced.append(True)
            lake.append("bronze_transactions", second)
            medallion.build_silver(lake)
        return commit(self, batches, after)

    monkeypatch.setattr(Lake, "commit", late)
    medallion.build_silver(lake, incremental=False)
    assert raced and len(lake.commits()) == 1
    assert silver_of(lake) == whole[0] and same(gold_of(lake, True), whole[1])
    assert medallion.build_silver(lake)["bronze_rows"] == 0


def test_one_of_two_commits_wins(spark):
    lake = Lake.fresh(spark)
    lake.commit([("a", 1)], after=0)
    with pytest.raises(CommitRace):
        lake.commit([("b", 1)], after=0)
    lake.commit([("a", 1), ("c", 2)], after=1)
    assert lake.head() == (2, [("a", 1), ("c", 2)])
    lake.clean()
    with pytest.raises(CommitRace):  # number 1 is free again, but no longer the next
        lake.commit([("d", 1)], after=0)
    assert lake.commits() == ["a", "c"]


def test_merging_a_small_batch_reads_its_buckets_only(spark, txn):
    lake = Lake(spark, scratch_path(spark, "lake"), id_range=1024)
    lake.append("bronze_transactions", txn)
    medallion.build_silver(lake)
    buckets = lake._files("silver_survivors", lake.commits()).select("bucket").distinct().count()
    few = txn.where(F.col(S.ID).between(8192, 8300))
    merged = []
    live = Lake.live_survivors

    def watched(self, names, only=None):
        merged.append(live(self, names, only))
        return merged[-1]

    lake.live_survivors = watched.__get__(lake)
    newer = few.withColumn(S.EVENT_TIME, F.col(S.EVENT_TIME) + F.expr("INTERVAL 1 DAY"))
    counts = incremental.merge_batch(lake, newer, "small")
    assert counts["silver_rows"] == 0 and counts["bronze_rows"] == few.count() and buckets > 8
    plan = merged[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket#" in plan.split("PartitionFilters")[1][:80]
    read = {r[0] for r in merged[0].select("bucket").distinct().collect()}
    assert read == {8}
    # and a bucket of a batch is one file
    files = lake._files("silver_survivors", ["small"]).inputFiles()
    assert len(files) == 1 and "bucket=8" in files[0]


def put_many(lake, bronze, n):
    """Silver of ``bronze`` as n committed batches; batch k also holds stale copies of ids that batch k + 1 replaces."""
    rows = silver.survivors_of(silver.deduplicate(bronze)).withColumn("bucket", lake.bucket())
    k = F.pmod(F.xxhash64("raw_id"), F.lit(n)).cast("int")
    before, was = F.format_string("b%04d", k - 1), F.lit(None).cast(S.SURVIVORS_SCHEMA["was"].dataType)
    own = rows.withColumns({"of_batch": F.when(k > 0, before), "batch": F.format_string("b%04d", k), "was": was})
    stale = rows.where(k > 0).withColumns({"of_batch": F.lit(None).cast("string"), "batch": before, "was": was, S.AMOUNT: F.lit(1.0)})
    both = own.unionByName(stale)
    both.write.partitionBy("batch", "bucket").parquet(lake.path("silver_survivors"))
    lake.put_batch("gold_partials", "b0000", gold.partials(rows))
    sizes = {r["batch"]: r["count"] for r in both.groupBy("batch").count().collect()}
    return [(f"b{i:04d}", sizes[f"b{i:04d}"]) for i in range(n)]


def test_two_hundred_batches_fold_to_one(spark, txn, whole):
    lake = Lake.fresh(spark)
    batches = put_many(lake, txn, 200)
    sums = lake.read("gold_partials", ["b0000"])
    for name, _ in batches[1:]:  # their sums all lie in the first batch's
        lake._fs(lake.root)[0].mkdirs(lake._fs(f"{lake.path('gold_partials')}/batch={name}")[1])
    lake.commit(batches, after=0)
    assert silver_of(lake) == whole[0] and sums.count() > 10
    before = gold_of(lake, True)
    assert same(before, whole[1])
    assert incremental.fold(lake) == {"before": 200, "after": 1} and len(lake.commits()) == 1
    assert silver_of(lake) == whole[0] and same(gold_of(lake, True), before)
    assert incremental.fold(lake) == {"before": 1, "after": 1}


def test_fold_leaves_a_large_old_batch(spark, txn, whole):
    lake = Lake.fresh(spark)
    lake.append("bronze_transactions", queries.deliveries(txn)[2].where(F.col(S.ID) > 500))
    medallion.build_silver(lake)
    base = lake.commits()
    for lo, hi in ((0, 150), (100, 300), (250, 500), (400, 600)):
        incremental.merge_batch(lake, queries.retired(txn).where(F.col(S.ID).between(lo, hi)), f"old-{lo}")
        incremental.merge_batch(lake, txn.where(F.col(S.ID).between(lo, hi)), f"new-{lo}")
    assert len(lake.commits()) == 9 and silver_of(lake) == whole[0]
    assert incremental.fold(lake)["after"] == 2 and lake.commits()[0] == base[0]
    assert silver_of(lake) == whole[0] and same(gold_of(lake, True), whole[1])
    # what a fold took out is deleted by a later one, not before
    old = f"{lake.path('silver_survivors')}/batch=new-0"
    assert lake._exists(old)
    incremental.merge_batch(lake, txn.where(F.col(S.ID) < 50), "again-1")
    incremental.merge_batch(lake, txn.where(F.col(S.ID) < 50), "again-2")
    assert incremental.fold(lake)["after"] == 3 and not lake._exists(old)  # two empty batches as one
    assert silver_of(lake) == whole[0] and same(gold_of(lake, True), whole[1])


def test_stream_folds_when_there_are_many(spark, txn, whole):
    lake = Lake.fresh(spark)
    for k in range(5):
        lake.append("bronze_transactions", txn.where(F.pmod(F.col(S.ID).cast("long"), F.lit(5)) == k))
        ingest.run(incremental.start_silver(lake, fold_above=2))
    assert len(lake.commits()) <= 3 and silver_of(lake) == whole[0]


def test_merge_counts_run_no_count_job(spark, txn, monkeypatch):
    from pyspark.sql import DataFrame

    lake = Lake.fresh(spark)
    monkeypatch.setattr(DataFrame, "count", lambda self: pytest.fail("a count job"))
    counts = incremental.merge_batch(lake, txn, "a")
    empty = incremental.merge_batch(lake, txn.limit(0), "b")
    monkeypatch.undo()
    q = silver.quality_counts(txn).first().asDict()
    assert counts == q and set(empty.values()) == {0}


def test_reject_reasons(spark):
    rows = [
        ('{"TransactionID":1,"TransactionAmt":5.0}', None), ("not json", S.REJECT_MALFORMED), ('{"TransactionID":3000000000}', S.REJECT_RANGE),
        ('{"TransactionAmt":2.0}', S.REJECT_NO_ID), ('{"TransactionID":"3"}', S.REJECT_MALFORMED), (None, S.REJECT_NO_ID), ("", S.REJECT_NO_ID),
    ]
    landing = scratch_path(spark, "land")
    spark.createDataFrame([(None, v) for v, _ in rows], "key string, value string").withColumn("timestamp", F.current_timestamp()).write.parquet(landing)
    lake = Lake.fresh(spark)
    ingest.run(ingest.start_bronze(lake, landing, scratch_path(spark, "c")))
    got = [(r.raw, r.reason) for r in medallion.quarantined(lake).collect()]
    assert sorted(got, key=str) == sorted(rows[1:], key=str) and lake.read("bronze_transactions").count() == len(rows)
    counts = medallion.build_silver(lake)
    assert counts["quarantined_rows"] == len(rows) - 1 and counts["silver_rows"] == 1


def test_service_keeps_gold_fresh_and_restarts(spark, txn):
    lake, landing, ckpt = Lake.fresh(spark), scratch_path(spark, "land"), scratch_path(spark, "c")
    stop = threading.Event()
    messages.publish(messages.to_messages(txn.limit(100)), landing)
    failed = []

    def run():
        try:
            medallion.serve(lake, landing, ckpt, stop.is_set, poll=0.5)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    service = threading.Thread(target=run)
    service.start()

    def total(want):
        for _ in range(240):
            try:
                found = lake.read("gold_overall_summary").first()
            except Exception:  # noqa: BLE001 - not written yet, or just being replaced
                found = None
            if found is not None and found["total_transactions"] == want:
                return True
            time.sleep(0.5)
        return False

    ids = lambda df: df.select(S.ID).distinct().count()
    try:
        assert total(ids(txn.limit(100)))
        for q in spark.streams.active:  # both streams end; the service starts them again
            q.stop()
        messages.publish(messages.to_messages(txn.limit(400)), landing)
        assert total(ids(txn.limit(400)))
    finally:
        stop.set()
        service.join(60)
    assert not failed and not service.is_alive() and not spark.streams.active


def test_trend_with_state_over_restarts_and_series(spark):
    """Days final in one run are compared with the days of the run before, per series."""
    rows = [(f"2024-01-{d:02d} 10:00:00", net, 1.0, float(10 * d + len(net))) for d in range(1, 9) for net in ("visa", "discover")]
    src, out, ckpt = scratch_path(spark, "src"), scratch_path(spark, "out"), scratch_path(spark, "c")
    schema = f"{S.EVENT_TIME} timestamp, card4 string, {S.LABEL} double, {S.AMOUNT} double"
    df = spark.createDataFrame(rows, f"t string, card4 string, {S.LABEL} double, {S.AMOUNT} double").withColumn("t", F.col("t").cast("timestamp")).withColumnRenamed("t", S.EVENT_TIME)
    for lo, hi in ((1, 3), (4, 6), (7, 8)):
        df.where(F.dayofmonth(S.EVENT_TIME).between(lo, hi)).coalesce(1).write.mode("append").parquet(src)
        ingest.run(ingest.start_trend(spark.readStream.schema(schema).parquet(src), out, ckpt, "1 day", "card4"))
    got = {(r.series, r.day.day): (r.exposure, r.change) for r in spark.read.parquet(out).collect()}
    want = {(net, d): (10.0 * d + len(net), None if d == 1 else 10.0) for d in range(1, 7) for net in ("visa", "discover")}
    assert got == want  # the last two days are not final yet


def test_merges_shuffle_no_derived_column(spark, txn, whole):
    """The hash and the label follow from other columns, and each field of an earlier survivor is shuffled once."""
    lake, merged, write = Lake.fresh(spark), [], Lake.put_batch

    def seen(table, name, df):
        if table == "silver_survivors":
            merged.append(df)
        write(lake, table, name, df)

    lake.put_batch = seen
    for name, part in zip("abc", queries.deliveries(txn), strict=True):
        incremental.merge_batch(lake, part, name)
    assert len(merged) == 3 and not any({"row_hash", "risk_label", "_new", "_old"} & set(df.columns) for df in merged)
    assert not any("row_hash" in df._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0] for df in merged)
    assert silver_of(lake) == whole[0]
