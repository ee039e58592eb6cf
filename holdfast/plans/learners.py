"""Propensity models and uplift learners on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial
from statistics import fmean, pstdev

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.numeric import fixed
from holdfast.operators.quantiles import median
from holdfast.operators.ranking import global_rank
from holdfast.plans.effects import PROPENSITY_FEATURES
from holdfast.plans.uplift import combine_effects
from holdfast.session import new_folder, shared_folder, store, together
from holdfast.sources import published

# Columns that are no features (key, arm, outcome, leak, duplicate).
NOT_FEATURES = ["customer_id", "treatment", "churn_binary", "revenue_at_risk", "tenure_bucket"]
SEED = 42
FOLDS = 5
# Rows that one task of a fit reads: a level of a tree over fewer is mostly the start of its tasks.
ROWS_PER_TASK = 50_000


@dataclass(frozen=True)
class Boosting:
    """Settings of a boosted-tree model; the defaults are the uplift learners'."""

    trees: int = 200
    depth: int = 4
    step: float = 0.05
    sample: float = 0.8
    min_leaf: int = 20
    seed: int = SEED

    def _params(self) -> dict[str, object]:
        return dict(
            maxIter=self.trees, maxDepth=self.depth, stepSize=self.step, subsamplingRate=self.sample,
            minInstancesPerNode=self.min_leaf, seed=self.seed, featuresCol="features", labelCol="label",
            maxMemoryInMB=1024, checkpointInterval=10,
        )

    def classifier(self) -> GBTClassifier:
        return GBTClassifier(**self._params())

    def regressor(self) -> GBTRegressor:
        return GBTRegressor(**self._params())


PROPENSITY_BOOSTING = Boosting(trees=100, depth=3, sample=1.0, min_leaf=30)


def feature_columns(df: DataFrame, drop: Sequence[str] = NOT_FEATURES) -> list[str]:
    return [name for name in df.columns if name not in drop]


def text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [name for name in columns if isinstance(df.schema[name].dataType, T.StringType)]


def fit_encoder(df: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Columns to one ``features`` vector; text becomes its place in sorted order.

    A text value that training did not see gets code 0.
    """
    texts = text_columns(df, columns)
    stages: list = []
    if texts:
        indexer = StringIndexer(
            inputCols=texts, outputCols=[f"{name}__place" for name in texts],
            stringOrderType="alphabetAsc", handleInvalid="keep",
        ).fit(df)
        codes = ", ".join(
            f"CASE WHEN `{name}__place` >= {len(labels)} THEN 0D ELSE `{name}__place` END AS `{name}__code`"
            for name, labels in zip(texts, indexer.labelsArray)
        )
        stages = [indexer, SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")]
    inputs = [f"{name}__code" if name in texts else name for name in columns]
    return PipelineModel([*stages, VectorAssembler(inputCols=inputs, outputCol="features")])


def encoded(encoder: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the feature vector."""
    return encoder.transform(df).select(*keep, "features")


def encoded_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with text columns replaced by their codes, as doubles."""
    texts = text_columns(df, columns)
    coded = fit_encoder(df, columns).transform(df)
    return coded.select([F.col(f"{c}__code").alias(c) if c in texts else F.col(c) for c in df.columns])


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add ``fold`` so every fold has each label's share to within one row.

    Rows are dealt out in the order of a hash of the key.
    """
    ranked = global_rank(df, [F.xxhash64(key, F.lit(seed)).asc(), F.col(key).asc()], by=[label], rank="_r", total="_n")
    return ranked.select(*df.columns, (F.col("_r") % folds).cast("int").alias("fold"))


@dataclass
class Validated:
    """A model fitted on all rows, and its cross-validated AUC."""

    model: object
    auc_mean: float
    auc_std: float


def fit_tasks(n_rows: int) -> int:
    """Partitions for a fit, in proportion to its rows; ``coalesce`` to them never adds any."""
    return max(1, -(-n_rows // ROWS_PER_TASK))


def fit_validated(estimator, rows: DataFrame, folds: int = FOLDS, parallelism: int | None = None) -> Validated:
    """Fit on all rows and on each fold's complement; ``rows`` has features, label and fold, and is read often.

    ``parallelism`` fits run at once; unless given, as many as have cores for their tasks.
    """
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    if set(sizes) != set(range(folds)) or len(sizes) < 2:
        raise ValueError(f"folds 0 to {folds - 1} need rows, and other folds must have none: {sizes}")
    tasks = fit_tasks(sum(sizes.values()))
    rows = rows.coalesce(tasks)

    def area(fold: int) -> float:
        model = estimator.copy().fit(rows.where(F.col("fold") != fold))
        return BinaryClassificationEvaluator().evaluate(model.transform(rows.where(F.col("fold") == fold)))

    cores = rows.sparkSession.sparkContext.defaultParallelism
    model, *areas = together(
        rows.sparkSession, lambda: estimator.copy().fit(rows), *[partial(area, fold) for fold in range(folds)],
        at_once=parallelism or max(1, cores // tasks),
    )
    return Validated(model, fmean(areas), pstdev(areas))


def _probability(model, name: str):
    """Set the model to add one probability vector column and nothing else."""
    return model.setProbabilityCol(name).setRawPredictionCol("").setPredictionCol("")


# ---------------------------------------------------------------- propensity


class BareLogisticRegression(LogisticRegression):
    """Logistic regression whose model comes without the training summary.

    The summary holds the session, which tasks cannot be sent once anything was
    observed in it. Stored models have none.
    """

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        folder = new_folder(dataset.sparkSession, "logistic")
        super()._fit(dataset).write().save(folder)
        return LogisticRegressionModel.load(folder)


def logistic(n_rows: int, strength: float = 1.0) -> LogisticRegression:
    """Ridge-penalised logistic model on unscaled features, intercept unpenalised."""
    return BareLogisticRegression(
        featuresCol="features", labelCol="label", regParam=1.0 / (n_rows * strength), elasticNetParam=0.0,
        standardization=False, maxIter=1000,
    )


@dataclass
class PropensityFit:
    """The chosen propensity model with both candidates' AUC."""

    encoder: PipelineModel
    model: object
    chosen: str
    auc: dict[str, tuple[float, float]]
    importances: list[tuple[str, float]]

    def score(self, df: DataFrame, column: str = "propensity") -> DataFrame:
        coded = self.encoder.transform(df).select(*df.columns, "features")
        scored = _probability(self.model, "_p").transform(coded)
        return scored.select(*df.columns, vector_to_array("_p")[1].alias(column))


def fit_propensity(
    modeling: DataFrame,
    features: Sequence[str] = PROPENSITY_FEATURES,
    boosting: Boosting = PROPENSITY_BOOSTING,
    folds: int = FOLDS,
) -> PropensityFit:
    """Logistic and boosted models of the offer; boosted only if its AUC is higher."""
    shared_folder(modeling.sparkSession)
    encoder = fit_encoder(modeling, features)
    rows = encoded(encoder, modeling, "customer_id", "treatment").withColumn("label", F.col("treatment").cast("double"))
    rows = store(stratified_folds(rows, "label", "customer_id", folds))
    n_rows = rows.count()
    plain, boosted = together(
        modeling.sparkSession,
        lambda: fit_validated(logistic(n_rows), rows, folds), lambda: fit_validated(boosting.classifier(), rows, folds)
    )
    chosen, best = ("boosted", boosted) if boosted.auc_mean > plain.auc_mean else ("logistic", plain)
    return PropensityFit(
        encoder, best.model, chosen,
        {"logistic": (plain.auc_mean, plain.auc_std), "boosted": (boosted.auc_mean, boosted.auc_std)},
        list(zip(features, (float(v) for v in boosted.model.featureImportances.toArray()))),
    )


def top_importances(spark: SparkSession, fit: PropensityFit, k: int = 5) -> DataFrame:
    return spark.createDataFrame(fit.importances, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    ).limit(k)


def propensity_report(spark: SparkSession, fit: PropensityFit) -> DataFrame:
    rows = [(name, mean, std, name == fit.chosen) for name, (mean, std) in fit.auc.items()]
    return spark.createDataFrame(rows, "model string, auc_mean double, auc_std double, chosen boolean")


# ------------------------------------------------------------------- learners


@dataclass
class Learner:
    """Outcome models per arm, and for the crossed learner effect models too."""

    encoder: PipelineModel
    features: list[str]
    control: GBTClassificationModel
    treated: GBTClassificationModel
    effect_treated: GBTRegressionModel | None = None
    effect_control: GBTRegressionModel | None = None
    n_rows: int = 0
    trained_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    risk_threshold: float | None = None
    auc: dict[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def kind(self) -> str:
        return "T-Learner" if self.effect_treated is None else "X-Learner"

    @property
    def suffix(self) -> str:
        return "" if self.effect_treated is None else "_xl"

    def outcomes(self, df: DataFrame, mu_0: str = "mu_0_control", mu_1: str = "mu_1_treatment") -> DataFrame:
        """``df`` with churn probabilities under no offer and offer; no shuffle."""
        coded = self.encoder.transform(df).select(*df.columns, "features")
        scored = _probability(self.treated, "_p1").transform(_probability(self.control, "_p0").transform(coded))
        return scored.select(
            *df.columns, "features", vector_to_array("_p0")[1].alias(mu_0), vector_to_array("_p1")[1].alias(mu_1)
        )

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the learner's outcome and uplift columns."""
        if self.effect_treated is None:
            scored = self.outcomes(df).drop("features")
            return scored.withColumn("uplift_score", F.col("mu_0_control") - F.col("mu_1_treatment"))
        scored = self.outcomes(df, "mu_0_xl", "mu_1_xl")
        for model, name in ((self.effect_control, "_tau_0"), (self.effect_treated, "_tau_1")):
            scored = model.setPredictionCol(name).transform(scored)
        uplift = combine_effects(F.col("_tau_0"), F.col("_tau_1"), F.col("propensity_score"))
        return scored.withColumn("uplift_score_xl", uplift).drop("features", "_tau_0", "_tau_1")

    def metadata(self, spark: SparkSession) -> DataFrame:
        row = (self.kind, self.trained_at, self.n_rows, len(self.features), self.features, self.risk_threshold)
        return spark.createDataFrame(
            [row],
            "model_type string, training_date timestamp, n_training_samples long, n_features int, "
            "features array<string>, risk_threshold double",
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Models and one metadata row under ``path``, published in one step: a reader gets this learner or the one before, whole."""
        parts = {
            "encoder": self.encoder, "control": self.control, "treated": self.treated,
            "effect_treated": self.effect_treated, "effect_control": self.effect_control,
        }

        def write(folder: str) -> None:
            for name, part in parts.items():
                if part is not None:
                    part.write().save(f"{folder}/{name}")
            self.metadata(spark).coalesce(1).write.parquet(f"{folder}/metadata")

        published.publish(spark, path, {"learner": write})
        published.clean(spark, path)


def load_learner(spark: SparkSession, path: str) -> Learner:
    """The learner that was saved last."""
    folder = published.places(spark, path, "learner", "Learner.save")[-1]
    facts = spark.read.parquet(f"{folder}/metadata").first()
    crossed = facts["model_type"] == "X-Learner"
    return Learner(
        encoder=PipelineModel.load(f"{folder}/encoder"),
        features=list(facts["features"]),
        control=GBTClassificationModel.load(f"{folder}/control"),
        treated=GBTClassificationModel.load(f"{folder}/treated"),
        effect_treated=GBTRegressionModel.load(f"{folder}/effect_treated") if crossed else None,
        effect_control=GBTRegressionModel.load(f"{folder}/effect_control") if crossed else None,
        n_rows=facts["n_training_samples"],
        trained_at=facts["training_date"],
        risk_threshold=facts["risk_threshold"],
    )


def fit_two_models(
    modeling: DataFrame, boosting: Boosting = Boosting(), validate: bool = False, folds: int = FOLDS
) -> Learner:
    """One churn model per arm, both fitted at the same time.

    The stored risk threshold is the median baseline risk over the training rows.
    """
    shared_folder(modeling.sparkSession)
    features = feature_columns(modeling)
    encoder = fit_encoder(modeling, features)
    rows = store(encoded(encoder, modeling, "customer_id", "treatment", "churn_binary").select(
        "customer_id", "treatment", "features", F.col("churn_binary").cast("double").alias("label")
    ))
    n_rows = rows.count()

    def fit(arm: int) -> Validated:
        part = rows.where(F.col("treatment") == arm)
        if validate:
            return fit_validated(boosting.classifier(), store(stratified_folds(part, "label", "customer_id", folds)), folds)
        return Validated(boosting.classifier().fit(part.coalesce(fit_tasks(n_rows))), float("nan"), float("nan"))

    control, treated = together(modeling.sparkSession, lambda: fit(0), lambda: fit(1))
    learner = Learner(encoder, features, control.model, treated.model, n_rows=n_rows)
    if validate:
        learner.auc = {"control": (control.auc_mean, control.auc_std), "treated": (treated.auc_mean, treated.auc_std)}
    # Ranking reads its input twice; scoring it once is cheaper.
    risk = store(learner.outcomes(modeling).select("customer_id", "mu_0_control"))
    learner.risk_threshold = median(risk, "mu_0_control", "customer_id").first()[0]
    return learner


def fit_crossed(modeling: DataFrame, boosting: Boosting = Boosting(), base: Learner | None = None) -> Learner:
    """Outcome models as above, then one effect model per arm on imputed effects.

    ``base`` reuses outcome models fitted before.
    """
    base = base or fit_two_models(modeling, boosting)
    treated, churned = F.col("treatment") == 1, F.col("churn_binary")
    imputed = F.when(treated, churned - F.col("mu_0_control")).otherwise(F.col("mu_1_treatment") - churned)
    # Stored, not cached: tasks carry the plan of what they read, here both outcome models.
    rows = store(base.outcomes(modeling).select("treatment", "features", imputed.alias("label")))
    tasks = fit_tasks(rows.count())
    on_treated, on_control = together(
        modeling.sparkSession,
        lambda: boosting.regressor().fit(rows.where(F.col("treatment") == 1).coalesce(tasks)),
        lambda: boosting.regressor().fit(rows.where(F.col("treatment") == 0).coalesce(tasks)),
    )
    return Learner(
        base.encoder, base.features, base.control, base.treated, on_treated, on_control,
        n_rows=base.n_rows, risk_threshold=base.risk_threshold, auc=base.auc,
    )


def importance_comparison(spark: SparkSession, learner: Learner, k: int = 5) -> DataFrame:
    """The control model's most important features, with both models' importances."""
    pairs = zip(learner.features, learner.control.featureImportances.toArray(), learner.treated.featureImportances.toArray())
    rows = [(name, float(a), float(b)) for name, a, b in pairs]
    return (
        spark.createDataFrame(rows, "feature string, control_importance double, treatment_importance double")
        .orderBy(F.desc("control_importance"), "feature")
        .limit(k)
    )


def auc_report(spark: SparkSession, learner: Learner) -> DataFrame:
    rows = [(arm, mean, std) for arm, (mean, std) in learner.auc.items()]
    return spark.createDataFrame(rows, "arm string, auc_mean double, auc_std double").select(
        "arm", fixed(F.col("auc_mean"), 4).alias("auc_mean"), fixed(F.col("auc_std"), 4).alias("auc_std")
    )
