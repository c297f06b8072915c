"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query derives its input from the driver's tables through the fixture
views, so every plan grows with the data.  Names match ``oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.operators import dictionary, features, gold, insights, metrics, models, silver
from riskhouse.operators.ensemble import Ensemble
from riskhouse.session import checkpointed, file_state, scratch_path
from riskhouse.plans import incremental
from riskhouse.sources import fixtures, messages, tables
from riskhouse.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def kafka_ts_text(c: str = S.EVENT_TIME):
    """Arrival time as text, so result checks do not depend on client time zones."""
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias("kafka_ts")


def bronze_out(df: DataFrame) -> DataFrame:
    return df.select(*S.MESSAGE_COLUMNS, kafka_ts_text())


def txn(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.transactions(spark, sf)


def silver_txn(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Silver of the fixture; with ``columns``, only those (plus the id)."""
    return silver.to_silver(txn(spark, sf), list(columns) if columns else None)


AMT, LBL = S.AMOUNT, S.LABEL


# --- silver ----------------------------------------------------------------
@query("silver_dedup")
def q_silver_dedup(spark, sf):
    return bronze_out(silver.deduplicate(txn(spark, sf)))


@query("silver_clean")
def q_silver_clean(spark, sf):
    return bronze_out(silver.clean(silver.deduplicate(txn(spark, sf))))


@query("silver_risk_label")
def q_silver_risk_label(spark, sf):
    return silver_txn(spark, sf, LBL, "risk_label").select(S.ID, S.LABEL, "risk_label")


@query("silver_row_hash")
def q_silver_row_hash(spark, sf):
    return silver_txn(spark, sf, "row_hash").select(S.ID, "row_hash")


@query("silver_quality_counts")
def q_silver_quality_counts(spark, sf):
    return silver.quality_counts(txn(spark, sf))


# --- gold ------------------------------------------------------------------
@query("gold_card_network")
def q_gold_card_network(spark, sf):
    return gold.by_card_network(silver_txn(spark, sf, "card4", LBL, AMT))


@query("gold_email_domain")
def q_gold_email_domain(spark, sf):
    return gold.by_email_domain(silver_txn(spark, sf, "P_emaildomain", LBL, AMT))


@query("amount_tier")
def q_amount_tier(spark, sf):
    return gold.with_amount_tier(silver_txn(spark, sf, AMT)).select(S.ID, "amount_tier")


@query("gold_amount_tier")
def q_gold_amount_tier(spark, sf):
    return gold.by_amount_tier(silver_txn(spark, sf, LBL, AMT))


@query("gold_overall_summary")
def q_gold_overall_summary(spark, sf):
    return gold.overall_summary(silver_txn(spark, sf, LBL, AMT))


@query("gold_rollups_single_scan")
def q_gold_rollups_single_scan(spark, sf):
    """The four rollups from one GROUPING SETS scan, in one long table."""
    return gold.rollups_long(gold.all_rollups(silver_txn(spark, sf, "card4", "P_emaildomain", LBL, AMT)))


def rollups_long(tables: dict[str, DataFrame]) -> DataFrame:
    """The four gold tables as one long table (gset, segment, measures)."""
    m = ["total_transactions", "fraud_count", "fraud_rate_pct", "avg_transaction_amt"]

    def part(name, gset, key):
        t = tables[name]
        seg = F.col(key) if key else F.lit(None).cast("string")
        return t.select(
            F.lit(gset).alias("gset"),
            seg.alias("segment"),
            *[F.col(c).cast("double") if c == "fraud_count" else F.col(c) for c in m],
        )

    return (
        part("gold_fraud_by_card_network", "card", "card4")
        .unionByName(part("gold_fraud_by_email_domain", "email", "P_emaildomain"))
        .unionByName(part("gold_fraud_by_amount_tier", "tier", "amount_tier"))
        .unionByName(part("gold_overall_summary", "overall", None))
    )


def deliveries(bronze: DataFrame) -> list[DataFrame]:
    """Out of order and with different copies of the same ids: the newer part, the older part, then everything again."""
    cut = F.lit("1996-01-01").cast("timestamp")
    newer = F.col(S.EVENT_TIME) >= cut
    return [bronze.filter(newer), bronze.filter(~newer), bronze]


def retired(bronze: DataFrame) -> DataFrame:
    """Earlier copies of the older half of the ids, under a network and a domain that no later copy has."""
    old = bronze.filter(F.col(S.EVENT_TIME) < F.lit("1996-01-01").cast("timestamp"))
    return old.withColumns({
        S.EVENT_TIME: F.col(S.EVENT_TIME) - F.expr("INTERVAL 40 YEARS"),
        "card4": F.lit("retired network"),
        "P_emaildomain": F.lit("retired.example"),
    })


@query("gold_incremental")
def q_gold_incremental(spark, sf):
    """Bronze delivered out of order, the first copies in groups that later copies empty again; silver
    and partials merged after each delivery and folded at the end; gold finalised from the partial sums."""
    from riskhouse.plans import medallion

    lake, bronze = tables.Lake.fresh(spark), txn(spark, sf)
    for part in [retired(bronze), *deliveries(bronze)]:
        lake.append("bronze_transactions", part)
        medallion.build_silver(lake)
    incremental.fold(lake)
    medallion.build_gold(lake, from_partials=True)
    return rollups_long({n: lake.read(n) for n in S.TABLES if n.startswith("gold_") and n != "gold_partials"})


@query("silver_quarantine")
def q_silver_quarantine(spark, sf):
    """Messages without a usable id, all of them, with their text and the reason, after two deliveries of
    every message through the bronze stream: some are no JSON, some lack the id, some have one beyond INT."""
    from riskhouse.plans import medallion

    k, cents = F.pmod(F.col("C2").cast("long"), F.lit(25)), F.round(F.col(S.AMOUNT) * 100).cast("long").cast("string")
    bad = F.when(k == 0, F.lit(None)).when(k == 1, F.col(S.ID) + 3e9).otherwise(F.col(S.ID))
    source = txn(spark, sf).withColumn(S.ID, bad)
    sent = source.select(F.when(k == 2, F.concat(F.lit("{broken "), cents)).alias("text"), *source.columns)
    whole = F.to_json(F.struct(*S.MESSAGE_COLUMNS))
    msgs = sent.select(F.lit(None).cast("string").alias("key"), F.coalesce("text", whole).alias("value"), F.col(S.EVENT_TIME).alias("timestamp"))
    landing, ckpt, lake = scratch_path(spark, "landing"), scratch_path(spark, "ckpt-bronze"), tables.Lake.fresh(spark)
    for _ in range(2):
        messages.publish(msgs, landing)
        ingest.run(ingest.start_bronze(lake, landing, ckpt))
        medallion.build_silver(lake)
    amount = F.get_json_object("raw", f"$.{S.AMOUNT}").cast("double").alias("raw_amount")
    text = F.when(F.col("reason") == S.REJECT_MALFORMED, F.col("raw")).alias("raw_text")
    return medallion.quarantined(lake).select(*S.MESSAGE_COLUMNS, kafka_ts_text(), "reason", amount, text)


# --- insights --------------------------------------------------------------
def gold_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One rollup, from silver with only the columns it groups and sums."""
    make, key = {
        "card": (gold.by_card_network, ["card4"]),
        "email": (gold.by_email_domain, ["P_emaildomain"]),
        "tier": (gold.by_amount_tier, []),
        "summary": (gold.overall_summary, []),
    }[name]
    return make(silver_txn(spark, sf, *key, LBL, AMT))


@query("fraud_only")
def q_fraud_only(spark, sf):
    return insights.fraud_only(silver_txn(spark, sf, LBL, AMT))


@query("legit_only")
def q_legit_only(spark, sf):
    return insights.legit_only(silver_txn(spark, sf, LBL, AMT))


@query("distinct_rows")
def q_distinct_rows(spark, sf):
    return insights.distinct_segments(silver_txn(spark, sf, "card4", "card6", "P_emaildomain"))


@query("card_risk_ranked")
def q_card_risk_ranked(spark, sf):
    return insights.card_risk_ranked(gold_table(spark, sf, "card"))


@query("card_type_exposure")
def q_card_type_exposure(spark, sf):
    return insights.card_type_exposure(silver_txn(spark, sf, "card6", LBL))


@query("top_fraud_domains")
def q_top_fraud_domains(spark, sf):
    return insights.top_fraud_domains(silver_txn(spark, sf, "P_emaildomain", LBL))


@query("risk_heatmap")
def q_risk_heatmap(spark, sf):
    return insights.risk_heatmap(silver_txn(spark, sf, "card4", "P_emaildomain", LBL))


@query("amount_histogram")
def q_amount_histogram(spark, sf):
    return insights.amount_histogram(silver_txn(spark, sf, LBL, AMT))


@query("legit_sample")
def q_legit_sample(spark, sf):
    return insights.legit_sample(silver_txn(spark, sf, LBL, AMT))


@query("tier_status_long")
def q_tier_status_long(spark, sf):
    return insights.tier_status_long(gold_table(spark, sf, "tier"))


@query("email_hotspots")
def q_email_hotspots(spark, sf):
    return insights.email_hotspots(gold_table(spark, sf, "email"))


@query("key_findings")
def q_key_findings(spark, sf):
    return insights.findings_from_rollups(
        gold.all_rollups(silver_txn(spark, sf, "card4", "P_emaildomain", LBL, AMT))
    )


@query("estimated_exposure")
def q_estimated_exposure(spark, sf):
    return insights.exposure(gold_table(spark, sf, "summary"))


@query("top_flagged")
def q_top_flagged(spark, sf):
    return insights.top_flagged(
        silver_txn(spark, sf, LBL, AMT, "card4", "card6", "P_emaildomain")
    )


@query("headline_metrics")
def q_headline_metrics(spark, sf):
    return insights.headline_metrics(gold_table(spark, sf, "summary"))


@query("headline_text")
def q_headline_text(spark, sf):
    return insights.headline_text(gold_table(spark, sf, "summary"))


@query("literal_requests")
def q_literal_requests(spark, sf):
    s = silver_txn(spark, sf, AMT, "card4", "card6", "P_emaildomain")
    # the fixture's first domains stand for the form's choices
    email = F.col("P_emaildomain")
    for i, choice in enumerate(S.FORM_EMAILS):
        email = F.when(F.col("P_emaildomain") == f"d{i}.com", F.lit(choice)).otherwise(email)
    form = insights.request_form(s.withColumn("P_emaildomain", email))
    return insights.normalize_requests(form)


# --- features and evaluation ------------------------------------------------
def fixed_score(df: DataFrame) -> DataFrame:
    """The fixture's fixed score: D1 / 10 + 0.1 for product R; label at 0.5."""
    score = F.col("D1") / 10.0 + F.when(F.col("ProductCD") == "R", 0.1).otherwise(0.0)
    return df.withColumn("score", score).withColumn(
        "prediction", F.when(F.col("score") > S.THRESHOLD, 1.0).otherwise(0.0)
    )


def raw_features(spark, sf):
    """All features of the deduplicated transactions, by a star join with the tables they refer to."""
    keyed = fixtures.keyed_transactions(spark, sf)
    wanted = [*S.MESSAGE_FEATURES, LBL, S.EVENT_TIME, "TransactionDT", *[c for c in keyed.columns if c.startswith("l_")]]
    return features.raw_features(fixtures.with_all_features(silver.deduplicate(keyed, wanted), spark, sf))


@query("feature_projection")
def q_feature_projection(spark, sf):
    return raw_features(spark, sf)


@query("feature_impute")
def q_feature_impute(spark, sf):
    return features.impute(raw_features(spark, sf))


@query("label_encode")
def q_label_encode(spark, sf):
    """Codes of all 14 categories, from a dictionary table."""
    df = checkpointed(features.impute(raw_features(spark, sf)).select(S.ID, *S.CATEGORICAL))  # learned and encoded: read once each
    words = dictionary.learn(df, S.CATEGORICAL)
    enc = dictionary.encode(df, words, dictionary.sizes(words), "_ix")
    return enc.select(S.ID, *[c + "_ix" for c in S.CATEGORICAL])


@query("stable_split")
def q_stable_split(spark, sf):
    return features.split_counts(features.stable_split(silver_txn(spark, sf, LBL)))


@query("stratified_split")
def q_stratified_split(spark, sf):
    return features.split_counts(features.stratified_split(silver_txn(spark, sf, LBL)))


@query("class_weights")
def q_class_weights(spark, sf):
    split = features.stratified_split(silver_txn(spark, sf, LBL))
    return features.class_weights(split.filter(F.col("split") == "train"))


@query("label_rate")
def q_label_rate(spark, sf):
    return features.label_rate(txn(spark, sf))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return metrics.roc_auc(fixed_score(silver_txn(spark, sf, LBL, "D1", "ProductCD")))


@query("classification_report")
def q_classification_report(spark, sf):
    return metrics.classification_report(
        fixed_score(silver_txn(spark, sf, LBL, "D1", "ProductCD"))
    )


@query("auc_by_round")
def q_auc_by_round(spark, sf):
    """AUC of a score that shifts from one feature to another over five rounds, all rounds in one plan."""
    r = lambda k: F.col("D1") * k + F.col("C1") * (5 - k) + F.when(F.col("ProductCD") == "R", k).otherwise(0)
    staged = silver_txn(spark, sf, LBL, "D1", "C1", "ProductCD").select(LBL, F.posexplode(F.array(*[r(k) for k in range(1, 6)])).alias("place", "score"))
    return metrics.roc_auc_by(staged.withColumn("round", F.col("place") + 1), ["round"])


# --- sources and sinks ------------------------------------------------------
@query("replay_capped_scan")
def q_replay_capped_scan(spark, sf):
    """The first CAPPED_ROWS rows of a CSV file set, in id order (the cap is the feature)."""
    path = scratch_path(spark, "csv-capped")
    tables.write_csv(txn(spark, sf), path)
    order = [S.ID, S.EVENT_TIME, S.AMOUNT, "card1"]
    return bronze_out(tables.capped_scan(tables.read_csv(spark, path, S.BRONZE_SCHEMA), S.CAPPED_ROWS, order))


@query("csv_scan")
def q_csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    tables.write_csv(txn(spark, sf), path)
    return bronze_out(tables.read_csv(spark, path, S.BRONZE_SCHEMA))


@query("parquet_glob_scan")
def q_parquet_glob_scan(spark, sf):
    path = scratch_path(spark, "parquet")
    txn(spark, sf).write.parquet(path)
    return bronze_out(spark.read.schema(S.BRONZE_SCHEMA).parquet(f"{path}/*.parquet"))


@query("replay_messages")
def q_replay_messages(spark, sf):
    return messages.extract_fields(messages.to_messages(txn(spark, sf), legacy_zero_fill=True))


@query("bronze_parse")
def q_bronze_parse(spark, sf):
    return bronze_out(messages.parse_messages(messages.to_messages(txn(spark, sf))))


@query("gold_overwrite")
def q_gold_overwrite(spark, sf):
    lake = tables.Lake.fresh(spark)
    summary = gold.overall_summary(silver_txn(spark, sf, LBL, AMT))
    lake.replace("gold_overall_summary", summary)
    lake.replace("gold_overall_summary", summary)
    return lake.read("gold_overall_summary")


@query("silver_append_idempotent")
def q_silver_append_idempotent(spark, sf):
    lake = tables.Lake.fresh(spark)
    for name in ("a", "a", "b"):  # a repeated batch, then a redelivery: both add nothing
        incremental.merge_batch(lake, txn(spark, sf), name)
    return lake.read("silver_transactions").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct(S.ID).alias("distinct_ids")
    )


# --- streaming --------------------------------------------------------------
def _landing(spark, sf, redeliver: bool) -> str:
    """Event transactions published as message files; optionally a second,
    complete redelivery (at-least-once producer retry)."""
    msgs = messages.to_messages(fixtures.event_transactions(spark, sf))
    landing = scratch_path(spark, "landing")
    messages.publish(msgs, landing)
    if redeliver:
        messages.publish(msgs, landing)
    return landing


def _bronze(spark, landing: str, runs: int = 1) -> tables.Lake:
    lake = tables.Lake.fresh(spark)
    ckpt = scratch_path(spark, "ckpt-bronze")
    for _ in range(runs):
        ingest.run(ingest.start_bronze(lake, landing, ckpt))
    return lake


@query("stream_bronze")
def q_stream_bronze(spark, sf):
    return bronze_out(_bronze(spark, _landing(spark, sf, redeliver=True)).read("bronze_transactions"))


@query("stream_bronze_restart")
def q_stream_bronze_restart(spark, sf):
    return bronze_out(_bronze(spark, _landing(spark, sf, redeliver=False), runs=2).read("bronze_transactions"))


@query("stream_silver")
def q_stream_silver(spark, sf):
    """Messages with different copies of the same ids, the newest first and the
    older ones years late, streamed to bronze and on to silver in several micro-batches."""
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt-bronze")
    lake = tables.Lake.fresh(spark)
    for part in deliveries(txn(spark, sf)):
        messages.publish(messages.to_messages(part), landing)
        ingest.run(ingest.start_bronze(lake, landing, ckpt))
        ingest.run(incremental.start_silver(lake))
    s = lake.read("silver_transactions")
    return s.select(*[c for c in S.SILVER_COLUMNS if c != S.EVENT_TIME], kafka_ts_text())


@query("exposure_trend")
def q_exposure_trend(spark, sf):
    ev = fixtures.event_transactions(spark, sf)
    return insights.daily_exposure(silver.to_silver(ev, [LBL, AMT, S.EVENT_TIME]))


@query("stream_exposure_trend")
def q_stream_exposure_trend(spark, sf):
    """The exposure trend of a stream whose transactions come up to a day late: each day is emitted once
    it is final, with its change against the final day before it, which the stream's state holds."""
    ev = silver.to_silver(fixtures.event_transactions(spark, sf), [LBL, AMT, S.EVENT_TIME])
    day = F.datediff(F.to_date(S.EVENT_TIME), F.lit("2024-01-01").cast("date"))
    arrival = F.floor((day + F.pmod(F.col(S.ID), F.lit(2))) / 6)  # odd ids arrive with the next day's
    rows = ev.select(S.ID, LBL, AMT, S.EVENT_TIME, arrival.alias("arrival"))
    # a last row, far later and of no exposure, lets all days become final
    end = rows.agg(F.max(S.EVENT_TIME).alias("t"), F.max("arrival").alias("a")).select(
        F.lit(0).alias(S.ID), F.lit(0.0).alias(LBL), F.lit(0.0).alias(AMT), (F.col("t") + F.expr("INTERVAL 30 DAYS")).alias(S.EVENT_TIME), (F.col("a") + 1).alias("arrival")
    )
    arrivals, source = scratch_path(spark, "trend-arrivals"), scratch_path(spark, "trend-source")
    rows.unionByName(end).write.partitionBy("arrival").parquet(arrivals)  # read once an arrival, each its own part
    kept = spark.read.schema(rows.schema).parquet(arrivals)
    out, ckpt = scratch_path(spark, "trend"), scratch_path(spark, "ckpt-trend")
    days = [r[0] for r in kept.select("arrival").distinct().orderBy("arrival").collect()]  # few: one a six days
    for k in days:
        kept.where(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(source)
        # all files of an arrival are one micro-batch, and the stream goes on from its checkpoint
        stream = spark.readStream.schema(rows.drop("arrival").schema).parquet(source)
        ingest.run(ingest.start_trend(stream, out, ckpt, flush=k == days[-1]))
    trend = spark.read.schema("series string, day date, exposure double, change double").parquet(out)
    return trend.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "exposure", "change")


# --- models ------------------------------------------------------------------
_fitted: dict[tuple, str] = {}


def model_data(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Train / test parts of the deduplicated, imputed features, from a table in the shared folder: model fitting
    passes over the training part many times and must not recompute join, dedup and split."""
    key = _data_key(spark, sf)
    if key not in _fitted:
        path = scratch_path(spark, "model-data")
        features.stratified_split(models.model_frame(raw_features(spark, sf))).write.parquet(path)
        _fitted[key] = path
    s = spark.read.parquet(_fitted[key])
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


def _data_key(spark, sf) -> tuple:
    """The session and the state of the files that the features come from: changed tables are fitted anew."""
    state = [file_state(spark, f"{sf.rstrip('/')}/{t}.parquet") for t in ("lineitem", "orders", "customer", "part", "supplier")]
    return spark.sparkContext.applicationId, sf, *state


def fitted(spark, sf, kind: str) -> tuple[str, DataFrame]:
    """Path of the model of one kind, fitted at the reference's settings, and
    the test part.  The queries of one session share a fit: paths are all that is kept."""
    train, test = model_data(spark, sf)
    key = (*_data_key(spark, sf), kind)
    if key not in _fitted:
        _fitted[key] = models.fit(kind, train).path
    return _fitted[key], test


def held_out_auc(spark, sf, kind: str) -> DataFrame:
    path, test = fitted(spark, sf, kind)
    return metrics.roc_auc(models.score(models.load(path), test), digits=4)


def _trained_auc(spark, sf, kind: str) -> DataFrame:
    return held_out_auc(spark, sf, kind).select(F.lit(models.MODEL_NAMES[kind]).alias("model"), "auc")


@query("train_gbt")
def q_train_gbt(spark, sf):
    return _trained_auc(spark, sf, "gbt")


@query("train_rf")
def q_train_rf(spark, sf):
    return _trained_auc(spark, sf, "rf")


@query("train_lr")
def q_train_lr(spark, sf):
    return _trained_auc(spark, sf, "lr")


def comparison(spark, sf) -> DataFrame:
    aucs = {k: held_out_auc(spark, sf, k).first()["auc"] for k in ("gbt", "rf", "lr")}
    return models.compare(spark, aucs)


@query("model_comparison")
def q_model_comparison(spark, sf):
    return comparison(spark, sf)


#: Largest gradient (of a mean log-loss, in spreads of the feature) that counts as nil.
GRADIENT = 1e-3
FIXED_SCORES = {"amount": AMT, "card": "card1", "fixed": "score"}


def fixed_comparison(spark, sf) -> DataFrame:
    """The comparison table over three fixed scoring expressions instead of models."""
    scored = checkpointed(fixed_score(silver_txn(spark, sf, LBL, AMT, "card1", "D1", "ProductCD")))
    aucs = {k: metrics.roc_auc(scored, score=e).first()["auc"] for k, e in FIXED_SCORES.items()}
    return models.compare(spark, aucs)


@query("comparison_fixed_scores")
def q_comparison_fixed_scores(spark, sf):
    return fixed_comparison(spark, sf)


@query("metrics_roundtrip")
def q_metrics_roundtrip(spark, sf):
    """The comparison document written as JSON and read again."""
    path = scratch_path(spark, "model-metrics")
    fixed_comparison(spark, sf).write.json(path)
    return spark.read.schema("model string, auc double, is_best boolean").json(path)


@query("headline_detection")
def q_headline_detection(spark, sf):
    """The headline strip with the best score's AUC as its detection figure."""
    auc = metrics.roc_auc(fixed_score(silver_txn(spark, sf, LBL, "D1", "ProductCD")))
    return insights.headline_with_detection(gold_table(spark, sf, "summary"), auc)


@query("verdict_fixed_score")
def q_verdict_fixed_score(spark, sf):
    """Threshold, percentage and verdict text of the fixed score."""
    scored = models.verdict(fixed_score(silver_txn(spark, sf, "D1", "ProductCD")))
    return scored.select(S.ID, F.round("score", 6).alias("score"), "pct", "verdict")


@query("request_features")
def q_request_features(spark, sf):
    """Form requests normalised, with the form's constants (codes, for categories it does not ask for) for the fields they lack."""
    return models.request_frame(q_literal_requests(spark, sf)).select(S.ID, *S.REQUEST_DEFAULTS, *[c + "_code" for c in S.REQUEST_CODES])


@query("assembled_features")
def q_assembled_features(spark, sf):
    """The assembled model vector as an array column, with the codes as numbers."""
    frame = checkpointed(models.model_frame(raw_features(spark, sf)))
    words = dictionary.learn(frame, S.CATEGORICAL)
    out = Pipeline(stages=models.pipeline("lr").getStages()[:-1]).fit(frame.limit(0).withColumns({c + "_code": F.lit(0.0) for c in S.CATEGORICAL}))
    out = out.transform(dictionary.encode(frame, words, dictionary.sizes(words)))
    v = vector_to_array("features")
    return out.select(S.ID, *[v[i].alias(n) for i, n in enumerate(models.vector_columns(S.FEATURES))])


@query("saved_model_scores")
def q_saved_model_scores(spark, sf):
    """Rows scored, rows whose score changes when the model is saved and loaded again, scores outside [0, 1]."""
    path, _ = fitted(spark, sf, "gbt")
    frame = models.model_frame(raw_features(spark, sf))
    model, again = models.load(path), scratch_path(spark, "model-again")
    models.save(model, again)
    a = models.score(model, frame).select(S.ID, F.col("score").alias("a"))
    both = models.score(models.load(again), a.join(frame, S.ID)).select("a", "score")
    return both.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col("a") != F.col("score")).alias("rows_changed"),
        F.count_if(~F.col("score").between(0, 1)).alias("rows_outside"),
    )


def _all_scored(spark, sf) -> DataFrame:
    """Every transaction, scored without its label by the saved boosted-trees pipeline."""
    path, _ = fitted(spark, sf, "gbt")
    return models.verdict(models.score(models.load(path), models.request_frame(raw_features(spark, sf).drop(LBL))))


def _compared(model: models.FraudModel, frame: DataFrame) -> DataFrame:
    """Each row's score by the ML pipeline (a) and by the table of its trees (b)."""
    rows = models.score(model, frame).withColumnRenamed("score", "a")
    return rows.withColumn("b", Ensemble(model.trees()).probability(model.vector())).select(S.ID, "a", "b")


def _differing(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows_scored"), F.count_if(~(F.abs(F.col("a") - F.col("b")) < 1e-9)).alias("rows_differing"))


@query("tree_table_scores")
def q_tree_table_scores(spark, sf):
    """Transactions whose score from the table of the fitted trees differs from the pipeline's."""
    model = models.load(fitted(spark, sf, "gbt")[0], spark)
    return _differing(_compared(model, models.request_frame(raw_features(spark, sf).drop(LBL))))


@query("stream_tree_scores")
def q_stream_tree_scores(spark, sf):
    """The same for event messages scored as they stream in."""
    model, out = models.load(fitted(spark, sf, "gbt")[0], spark), scratch_path(spark, "scores")
    parsed = messages.parse_messages(ingest.message_stream(spark, _landing(spark, sf, redeliver=False))).drop(LBL)
    w = _compared(model, models.request_frame(parsed)).writeStream.format("parquet").option("path", out)
    ingest.run(w.option("checkpointLocation", scratch_path(spark, "ckpt-scores")).trigger(availableNow=True).start())
    return _differing(spark.read.schema(f"{S.ID} int, a double, b double").parquet(out))


@query("fit_certificates")
def q_fit_certificates(spark, sf):
    """Rows of the training part and whether the fits hold what they must: the logistic regression's gradient is
    nil at its coefficients, and the first boosted tree's leaves hold the weighted mean of their rows' labels."""
    train, _ = model_data(spark, sf)
    checks = [("gbt", models.first_tree_check, 1e-9), ("lr", models.gradient_check, GRADIENT)]
    parts = [
        check(models.load(fitted(spark, sf, kind)[0], spark), train).select(
            F.lit(models.MODEL_NAMES[kind]).alias("model"), "rows", (F.col("violation") < most).alias("within")
        )
        for kind, check, most in checks
    ]
    return parts[0].unionByName(parts[1])


@query("score_batch")
def q_score_batch(spark, sf):
    return _all_scored(spark, sf).select(S.ID, F.round("score", 6).alias("score"))


@query("score_verdict")
def q_score_verdict(spark, sf):
    return _all_scored(spark, sf).select(S.ID, F.round("score", 6).alias("score"), "pct", "verdict")


@query("stream_score")
def q_stream_score(spark, sf):
    """Arriving event messages, without labels, scored by the saved pipeline as they stream in."""
    model = models.load(fitted(spark, sf, "gbt")[0])
    landing = _landing(spark, sf, redeliver=False)
    parsed = messages.parse_messages(ingest.message_stream(spark, landing)).drop(LBL)
    scored = models.score(model, models.request_frame(parsed))
    out = scratch_path(spark, "scores")
    q = (
        scored.select(S.ID, F.round("score", 6).alias("score"))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "ckpt-scores"))
        .trigger(availableNow=True)
        .start()
    )
    ingest.run(q)
    return spark.read.schema(f"{S.ID} double, score double").parquet(out)
