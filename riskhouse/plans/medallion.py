"""The pipeline's jobs: replay -> bronze (stream) -> silver -> gold -> reports.

Each job reads tables and writes tables in a ``Lake`` (a root folder in
the shared storage); nothing passes through the driver except counts.
Silver and gold follow bronze incrementally (``plans.incremental``); gold is
summed from partial sums, or rebuilt by one scan of silver (GROUPING SETS).

Run as ``python -m riskhouse.plans.medallion <job> --lake DIR [...]``.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.operators import features, gold, insights, models, silver
from riskhouse.session import checkpointed
from riskhouse.sources import messages
from riskhouse.plans import incremental as inc
from riskhouse.sources.tables import Lake
from riskhouse.streaming import ingest


def replay(source: DataFrame, landing: str, legacy_zero_fill: bool = False, fmt: str = "files",
           kafka_servers: str | None = None, partitions: int | None = None) -> None:
    """Producer: transaction rows -> keyed JSON messages on a topic / landing dir."""
    msgs = messages.to_messages(source, legacy_zero_fill)
    messages.publish(msgs, landing, fmt, kafka_servers, partitions=partitions)


def ingest_bronze(spark: SparkSession, landing: str, lake: Lake, checkpoint: str,
                  fmt: str = "files", kafka_servers: str | None = None,
                  available_now: bool = True, max_per_trigger: int | None = None):
    """Bronze consumer: parse messages and append them, resuming from the checkpoint."""
    q = ingest.start_bronze(lake, landing, checkpoint, fmt, kafka_servers, available_now, max_per_trigger)
    return ingest.run(q) if available_now else q


def build_silver(lake: Lake, incremental: bool = True) -> dict:
    """Bronze -> silver and gold partials.  Incremental: the bronze files not yet
    seen are merged, and a re-run is a no-op; otherwise all of bronze replaces
    them.  Both give the same silver.  Returns counts: new bronze rows,
    changes in silver's rows, and quarantined messages."""
    if not incremental:
        return inc.rebuild(lake)
    done: list[dict] = []
    ingest.run(inc.start_silver(lake, done=done))
    keys = ["bronze_rows", "silver_rows", "fraud_rows", "legit_rows", "quarantined_rows"]
    return {k: sum(d[k] for d in done) for k in keys}


def build_gold(lake: Lake, from_partials: bool = True) -> None:
    """The four gold tables: from the partial sums (a few rows per silver
    batch), or from one GROUPING SETS scan of silver."""
    if from_partials:
        rollups = checkpointed(gold.finalize(lake.read("gold_partials")))
    else:
        rollups = checkpointed(gold.all_rollups(lake.read("silver_transactions")))
    for name, df in gold.split_rollups(rollups).items():
        lake.replace(name, df)


def serve(
    lake: Lake, landing: str, checkpoint: str, stop: Callable[[], bool] = lambda: False, restarts: int = 10, poll: float = 5.0, **source
) -> None:
    """Bronze, silver and gold as one service: two continuous streams, the second of which refreshes gold after each merge.

    A stream that fails is started again from its checkpoint, ``restarts`` times at most; ``stop`` is asked
    every ``poll`` seconds.  ``source``: format, servers and limit of ``ingest.start_bronze``."""
    start = {
        "bronze": lambda: ingest.start_bronze(lake, landing, checkpoint, available_now=False, **source),
        "silver": lambda: inc.start_silver(lake, available_now=False, after=lambda: build_gold(lake)),
    }
    running, failures = {name: begin() for name, begin in start.items()}, dict.fromkeys(start, 0)
    try:
        while not stop():
            time.sleep(poll)
            for name, query in running.items():
                if query.isActive:
                    continue
                failures[name] += 1
                if failures[name] > restarts:
                    raise RuntimeError(f"the {name} stream failed {failures[name]} times: {query.exception()}")
                running[name] = start[name]()
    finally:
        for query in running.values():
            query.stop()


def train(lake: Lake, settings: dict | None = None, transactions: DataFrame | None = None) -> DataFrame:
    """Fit, compare and save the three models on deduplicated, unfilled features
    (80/20 exact stratified split, checkpointed once): those that bronze's messages carry, or
    all that ``transactions`` (deduplicated rows with more features, as by a star join) have.
    Writes the comparison table ``model_metrics`` (JSON) and returns it."""
    if transactions is None:
        transactions = silver.deduplicate(lake.read("bronze_transactions"), S.MESSAGE_FEATURES + [S.LABEL])
    split = checkpointed(features.stratified_split(models.model_frame(features.raw_features(transactions))))
    tr = split.filter(F.col("split") == "train")
    te = split.filter(F.col("split") == "test")
    table = models.train_and_select(tr, te, lake.path("models"), settings=settings)
    table.write.mode("overwrite").json(lake.path("model_metrics"))
    return read_model_metrics(lake)


def read_model_metrics(lake: Lake) -> DataFrame:
    return lake.spark.read.schema(
        "model string, kind string, auc double, path string, is_best boolean"
    ).json(lake.path("model_metrics"))


def score(lake: Lake, transactions: DataFrame) -> DataFrame:
    """Score transactions (bronze-shaped rows, batch or stream) with the best
    saved model: id, score, percentage and verdict.  Transactions need no label,
    and may lack features, which take the form's constants."""
    model = models.best_model(read_model_metrics(lake))
    scored = models.verdict(models.score(model, models.request_frame(transactions)))
    return scored.select(S.ID, "score", "pct", "verdict")


def quarantined(lake: Lake) -> DataFrame:
    """Messages in bronze without a usable id, every one of them, with their text and the reason."""
    return lake.read("silver_quarantine")


def reports(lake: Lake) -> dict[str, DataFrame]:
    """The analyst views, over the lake's silver and gold tables."""
    s = lake.read("silver_transactions")
    card = lake.read("gold_fraud_by_card_network")
    email = lake.read("gold_fraud_by_email_domain")
    tier = lake.read("gold_fraud_by_amount_tier")
    summary = lake.read("gold_overall_summary")
    return {
        "headline_metrics": insights.headline_metrics(summary),
        "headline_text": insights.headline_text(summary),
        "amount_histogram": insights.amount_histogram(s),
        "legit_sample": insights.legit_sample(s),
        "card_risk_ranked": insights.card_risk_ranked(card),
        "tier_status_long": insights.tier_status_long(tier),
        "key_findings": insights.key_findings(card, email, tier, summary),
        "estimated_exposure": insights.exposure(summary),
        "email_hotspots": insights.email_hotspots(email),
        "card_type_exposure": insights.card_type_exposure(s),
        "risk_heatmap": insights.risk_heatmap(s),
        "top_flagged": insights.top_flagged(s),
        "exposure_trend": insights.daily_exposure(s),
    }


def main(argv: list[str] | None = None) -> int:
    from riskhouse.session import build_session

    p = argparse.ArgumentParser(prog="riskhouse.plans.medallion")
    p.add_argument(
        "job", choices=["replay", "bronze", "silver", "gold", "serve", "fold", "reports", "train", "score"]
    )
    p.add_argument("--lake", required=True)
    p.add_argument("--source", help="parquet of bronze-shaped transactions (replay, score)")
    p.add_argument("--out", help="score: output folder for (id, score, pct, verdict)")
    p.add_argument("--landing", help="landing dir or Kafka topic")
    p.add_argument("--checkpoint", help="stream checkpoint (bronze)")
    p.add_argument("--format", default="files", choices=["files", "kafka"])
    p.add_argument("--kafka-servers")
    p.add_argument("--partitions", type=int, help="replay: landing files (keyed partitions)")
    p.add_argument("--full", action="store_true",
                   help="silver: replace instead of append; gold: rescan silver")
    p.add_argument("--continuous", action="store_true", help="bronze: run until stopped")
    p.add_argument("--max-per-trigger", type=int, help="bronze: Kafka offsets / files per batch")
    a = p.parse_args(argv)
    spark = build_session()
    lake = Lake(spark, a.lake)
    if a.job == "replay":
        src = spark.read.schema(S.BRONZE_SCHEMA).parquet(a.source)
        replay(src, a.landing, fmt=a.format, kafka_servers=a.kafka_servers,
               partitions=a.partitions)
    elif a.job == "bronze":
        q = ingest_bronze(spark, a.landing, lake, a.checkpoint, a.format, a.kafka_servers,
                          available_now=not a.continuous, max_per_trigger=a.max_per_trigger)
        if a.continuous:
            q.awaitTermination()
    elif a.job == "silver":
        print(json.dumps(build_silver(lake, incremental=not a.full)))
    elif a.job == "serve":
        serve(lake, a.landing, a.checkpoint, fmt=a.format, kafka_servers=a.kafka_servers, max_per_trigger=a.max_per_trigger)
    elif a.job == "fold":
        print(json.dumps(inc.fold(lake)))
    elif a.job == "gold":
        build_gold(lake, from_partials=not a.full)
    elif a.job == "train":
        train(lake).show(truncate=False)
    elif a.job == "score":
        src = spark.read.schema(S.BRONZE_SCHEMA).parquet(a.source)
        score(lake, src).write.mode("errorifexists").parquet(a.out)
    else:
        for name, df in reports(lake).items():
            print(name)
            df.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
