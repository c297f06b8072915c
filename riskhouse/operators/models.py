"""Fraud classifiers on Spark ML: train, evaluate, compare, save, score.

A model is a dictionary of its categories (sorted texts, unseen -> extra code), the
columns it takes, and a Spark ML pipeline (vector assembler, classifier).  All three are fitted on the
training part only and saved together, so batch and stream scoring use exactly the
training vocabulary.  Class imbalance is handled with per-row weights (``weightCol``), as the
reference does with ``scale_pos_weight`` / ``class_weight='balanced'``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.operators import boosting, dictionary, features, metrics
from riskhouse.operators.ensemble import Ensemble, nodes_of
from riskhouse.session import checkpointed, scratch_path

# --- fixed values: the reference's model settings ---------------------------
FULL_SETTINGS = {
    "gbt": {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05},
    "rf": {"numTrees": 200, "maxDepth": 12},
    "lr": {"maxIter": 500, "tol": 1e-9},  # the reference's tolerance is one of the gradient; this one, of the loss, reaches it
}
WEIGHTING = {"gbt": "ratio", "rf": "balanced", "lr": "balanced"}
MODEL_NAMES = {"gbt": "Gradient Boosting", "rf": "Random Forest", "lr": "Logistic Regression"}
SEED = 42
# --- end of fixed values ----------------------------------------------------

#: Node numbers (a row has one in every tree) that a forest's fit may keep, four bytes each; beyond that rows walk from the roots.
NODE_IDS = 1 << 28


def _classifier(kind: str, params: dict):
    common = {"featuresCol": "features", "labelCol": S.LABEL, "weightCol": "weight"}
    if kind == "gbt":
        return GBTClassifier(seed=SEED, **common, **params)
    if kind == "rf":
        return RandomForestClassifier(seed=SEED, **common, **params)
    if kind == "lr":
        return LogisticRegression(**common, **params)
    raise ValueError(f"unknown model kind {kind!r}")


def vector_columns(names: list[str]) -> list[str]:
    """Columns of the feature vector: the numbers, then the categories' codes.

    Codes enter the models as numbers, as the reference's do, so a vocabulary of
    any size needs no more tree bins."""
    return [c for c in names if c not in S.CATEGORICAL] + [c + dictionary.SUFFIX for c in names if c in S.CATEGORICAL]


def pipeline(kind: str, params: dict | None = None, names: list[str] = S.FEATURES) -> Pipeline:
    """Assembler and classifier over encoded features; at the reference's settings unless told otherwise."""
    params = FULL_SETTINGS[kind] if params is None else params
    asm = VectorAssembler(inputCols=vector_columns(names), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[asm, _classifier(kind, params)])


def estimator(kind: str, encoded: DataFrame, params: dict | None, names: list[str]) -> Pipeline:
    """``pipeline``, whose forest keeps its rows' nodes between levels if the encoded rows are few enough: the same trees, sooner."""
    out = pipeline(kind, params, names)
    if kind == "rf":
        forest = out.getStages()[-1]
        forest.setCacheNodeIds(encoded.count() * forest.getNumTrees() <= NODE_IDS)
    return out


def fitted_pipeline(kind: str, encoded: DataFrame, params: dict | None, names: list[str]) -> PipelineModel:
    """``estimator`` fitted; boosted trees in one stage where that can be done (``boosting``)."""
    whole = estimator(kind, encoded, params, names)
    assembler, classifier = whole.getStages()
    if kind != "gbt" or not boosting.possible(encoded.sparkSession, classifier):
        return whole.fit(encoded)
    return PipelineModel([assembler, boosting.fit(classifier, encoded, vector_columns(names), S.LABEL, "weight")])


class FraudModel:
    """A fitted classifier: ``names`` are the features it takes, ``known`` the number of values of its categories."""

    def __init__(self, words: DataFrame, pipeline: PipelineModel, names: list[str], known: dict[str, int], path: str | None = None):
        self.words, self.pipeline, self.names, self.known, self.path = words, pipeline, names, known, path

    def encode(self, df: DataFrame) -> DataFrame:
        """df (batch or stream) with codes; a category whose code it brings along is taken as it is."""
        asked = {c: n for c, n in self.known.items() if c + dictionary.SUFFIX not in df.columns}
        return dictionary.encode(df, self.words, asked)

    def prepare(self, df: DataFrame) -> DataFrame:
        """df with the assembled ``features``."""
        return PipelineModel(stages=self.pipeline.stages[:-1]).transform(self.encode(df))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.encode(df))

    def trees(self) -> DataFrame:
        """The nodes of a saved tree ensemble, as a table."""
        stage = self.pipeline.stages[-1]
        return nodes_of(self.words.sparkSession, f"{self.path}/pipeline/stages/{len(self.pipeline.stages) - 1}_{stage.uid}")

    def vector(self) -> Column:
        """The feature vector over encoded rows, as an array."""
        return F.array(*[F.col(c).cast("double") for c in vector_columns(self.names)])


def model_frame(raw: DataFrame) -> DataFrame:
    """Raw (unfilled) features -> model input: 'nan' categories, -999 numbers; codes stay.

    The label is taken along if there is one; scoring does not need it."""
    codes = [c + dictionary.SUFFIX for c in S.CATEGORICAL]
    more = [c for c in [S.LABEL, *codes] if c in raw.columns]
    return features.impute(raw.select(S.ID, *[c for c in S.FEATURES if c in raw.columns], *more))


def request_frame(requests: DataFrame) -> DataFrame:
    """Scoring requests -> model input: features that a request lacks take the form's constants, as the codes
    themselves for categories that the form does not ask for.

    ``requests`` has an id and any of the features; a feature it has may still be
    null, which is a missing value and not an absent field.
    """
    absent = {c: F.lit(v) for c, v in S.REQUEST_DEFAULTS.items() if c not in requests.columns}
    absent |= {c + dictionary.SUFFIX: F.lit(v) for c, v in S.REQUEST_CODES.items() if c not in requests.columns}
    return model_frame(requests.withColumns(absent) if absent else requests)


def split(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    s = features.stratified_split(frame)
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


def fit(kind: str, train: DataFrame, params: dict | None = None, names: list[str] | None = None) -> FraudModel:
    """Model fitted on ``names`` (default: all features that ``train`` has), returned as saved and re-loaded from the shared folder.

    A freshly fitted classifier carries its training summary, which holds a
    DataFrame and so the session; scoring closures that capture the model
    would then drag the session into tasks.  The saved form has no summary.
    """
    names = [c for c in S.FEATURES if c in train.columns] if names is None else names
    words = dictionary.learn(train, [c for c in names if c in S.CATEGORICAL])
    known = dictionary.sizes(words)
    weighted = features.with_weights(train, WEIGHTING[kind])
    # the fit passes over its rows many times
    encoded = checkpointed(dictionary.encode(weighted, words, known).select(S.LABEL, "weight", *vector_columns(names)))
    fitted = FraudModel(words, fitted_pipeline(kind, encoded, params, names), names, known)
    path = scratch_path(train.sparkSession, f"model-{kind}")
    save(fitted, path)
    return load(path, train.sparkSession)


def score(model: FraudModel, df: DataFrame) -> DataFrame:
    """Adds ``score`` = positive-class probability."""
    out = model.transform(df)
    return out.withColumn("score", vector_to_array("probability")[1])


def auc_of(model: FraudModel, test: DataFrame) -> float:
    return metrics.roc_auc(score(model, test), S.LABEL, "score", digits=4).first()["auc"]


def verdict(scored: DataFrame) -> DataFrame:
    """Risk percentage (1 dp) and the approve / do-not-approve verdict."""
    return scored.withColumns(
        {
            "pct": F.round(F.col("score") * 100, 1),
            "verdict": F.when(F.col("score") > S.THRESHOLD, F.lit(S.VERDICT_HIGH)).otherwise(
                F.lit(S.VERDICT_LOW)
            ),
        }
    )


def compare(spark: SparkSession, aucs: dict[str, float]) -> DataFrame:
    """(model, auc, is_best) for the compared models (one row per model)."""
    rows = [(MODEL_NAMES.get(k, k), float(v)) for k, v in aucs.items()]
    df = spark.createDataFrame(rows, "model string, auc double")
    return mark_best(df)


def mark_best(table: DataFrame) -> DataFrame:
    """``is_best`` on one row: the highest AUC, ties to the first name."""
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("auc"), "model"))  # the few model rows
    return table.withColumn("is_best", place == 1)


def report(model: FraudModel, test: DataFrame) -> DataFrame:
    """Classification report of a model on ``test`` at the 0.5 threshold."""
    scored = score(model, test).withColumn(
        "prediction", F.when(F.col("score") > S.THRESHOLD, 1.0).otherwise(0.0)
    )
    return metrics.classification_report(scored)


def train_and_select(
    train: DataFrame, test: DataFrame, root: str, kinds=("gbt", "rf", "lr"), settings=None
) -> DataFrame:
    """Fit each model, save it under ``root``, and return the comparison table
    (model, kind, auc, is_best, path); the best model is the highest AUC."""
    spark = train.sparkSession
    rows = []
    for k in kinds:
        m = fit(k, train, (settings or {}).get(k))
        path = f"{root}/{k}"
        save(m, path)  # the comparison table names this copy
        rows.append((MODEL_NAMES[k], k, float(auc_of(m, test)), path))
    df = spark.createDataFrame(rows, "model string, kind string, auc double, path string")
    return mark_best(df)


def best_model(metrics_table: DataFrame) -> FraudModel:
    """Load the model the metrics table marks as best."""
    row = metrics_table.filter("is_best").orderBy("model").select("path").first()
    if row is None:
        raise ValueError("no model in the metrics table")
    return load(row["path"], metrics_table.sparkSession)


def save(model: FraudModel, path: str) -> None:
    spark = model.words.sparkSession
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    dictionary.save(model.words, f"{path}/dictionary")
    columns = [(k, c, model.known.get(c)) for k, c in enumerate(model.names)]
    spark.createDataFrame(columns, "place int, name string, n_values long").coalesce(1).write.mode("overwrite").json(f"{path}/columns")


def load(path: str, spark: SparkSession | None = None) -> FraudModel:
    spark = spark or SparkSession.active()
    columns = spark.read.schema("place int, name string, n_values long").json(f"{path}/columns").orderBy("place").collect()
    known = {r["name"]: r["n_values"] for r in columns if r["n_values"] is not None}
    return FraudModel(dictionary.load(spark, f"{path}/dictionary"), PipelineModel.load(f"{path}/pipeline"), [r["name"] for r in columns], known, path)


def boosting_progress(model: FraudModel, test: DataFrame) -> list[float]:
    """Log-loss on ``test`` after each boosting round (gbt models only);
    rows without a ``weight`` column count once."""
    if "weight" not in test.columns:
        test = test.withColumn("weight", F.lit(1.0))
    return list(model.pipeline.stages[-1].evaluateEachIteration(model.prepare(test)))


def boosting_auc(model: FraudModel, test: DataFrame, every: int = 50) -> DataFrame:
    """(round, auc) on ``test`` after each ``every`` boosting rounds and the last one.

    One plan: a row's trees are walked once, its margins after the rounds are exploded, and
    the AUC is taken by round.
    """
    trees = Ensemble(model.trees())
    rounds = sorted({*range(every, len(trees.trees) + 1, every), len(trees.trees)})
    rows = model.encode(test).select(S.LABEL, model.vector().alias("x"))
    return metrics.roc_auc_by(trees.staged(rows, "x", rounds), ["round"], score="margin", digits=4)


def table_scores(model: FraudModel, df: DataFrame) -> DataFrame:
    """df (batch or stream) with ``score`` from the table of the model's trees, by built-in functions alone."""
    return model.encode(df).withColumn("score", Ensemble(model.trees()).probability(model.vector()))


# --- certificates of a fit ----------------------------------------------------


def gradient_check(model: FraudModel, train: DataFrame, scheme: str = "balanced") -> DataFrame:
    """(rows, violation) of a logistic regression: the largest component of the weighted mean log-loss gradient at its
    coefficients, in units of the feature's spread; 0 at the optimum.  One aggregate over the training part."""
    rows = score(model, features.with_weights(train, scheme))
    error, columns = F.col("weight") * (F.col("score") - F.col(S.LABEL)), vector_columns(model.names)
    sums = [F.sum(error * F.col(c)).alias(f"g{k}") for k, c in enumerate(columns)]
    spread = [F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(columns)]
    one = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("w"), F.sum(error).alias("g"), *sums, *spread)
    parts = [F.abs(F.col("g")), *[F.abs(F.try_divide(F.col(f"g{k}"), F.col(f"s{k}"))) for k in range(len(columns))]]
    return one.select("rows", (F.greatest(*parts) / F.col("w")).alias("violation"))


def first_tree_check(model: FraudModel, train: DataFrame, scheme: str = "ratio") -> DataFrame:
    """(rows, violation) of boosted trees: the largest difference between a leaf value of the first tree and
    the weighted mean of its rows' labels (-1, 1), which least squares gives.  One aggregate by leaf."""
    trees = Ensemble(model.trees())
    rows = model.encode(features.with_weights(train, scheme)).withColumn("leaf", trees.leaf(0, model.vector()))
    leaves = rows.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.col("weight") * (2 * F.col(S.LABEL) - 1)) / F.sum("weight")).alias("mean")
    )
    stored = model.trees().filter("tree = 0").select(F.col("node").alias("leaf"), "value")
    both = leaves.join(stored, "leaf", "left")
    return both.agg(F.sum("n").alias("rows"), F.max(F.coalesce(F.abs(F.col("mean") - F.col("value")), F.lit(1.0))).alias("violation"))
