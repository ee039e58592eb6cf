"""Fitted models: planted effect, stored form, folds, encoding."""

from __future__ import annotations

import inspect

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from holdfast.plans import learners, uplift
from registry import catalog


@pytest.fixture(scope="module")
def modeling(spark):
    from registry.fixtures import modeling as build

    return build(spark, MEDIUM)


@pytest.fixture(scope="module")
def two(modeling):
    return learners.fit_two_models(modeling, learners.Boosting(trees=8, depth=3))


def test_defaults_are_the_published_settings():
    b, p = learners.Boosting(), learners.PROPENSITY_BOOSTING
    assert (b.trees, b.depth, b.step, b.sample, b.min_leaf, b.seed) == (200, 4, 0.05, 0.8, 20, 42)
    assert (p.trees, p.depth, p.step, p.min_leaf) == (100, 3, 0.05, 30)


def test_features_leave_out_key_arm_outcome_and_leaks(modeling, two):
    assert len(two.features) == 21
    assert not {"customer_id", "treatment", "churn_binary", "revenue_at_risk", "tenure_bucket"} & set(two.features)


def test_planted_effect_is_found(modeling, two):
    scored = two.score(modeling)
    assert scored.where(F.col("uplift_score") != F.col("mu_0_control") - F.col("mu_1_treatment")).count() == 0
    means = {r.internet_service: r.u for r in scored.groupBy("internet_service").agg(F.avg("uplift_score").alias("u")).collect()}
    assert means["Fiber optic"] > means["DSL"] > means["No"]
    crossed = learners.fit_crossed(modeling, learners.Boosting(trees=5, depth=3), two).score(modeling)
    means = {r.internet_service: r.u for r in crossed.groupBy("internet_service").agg(F.avg("uplift_score_xl").alias("u")).collect()}
    assert means["Fiber optic"] > means["DSL"] > means["No"]


def test_stored_threshold_is_the_training_median(modeling, two):
    risks = sorted(r[0] for r in two.score(modeling).select("mu_0_control").collect())
    assert two.risk_threshold == pytest.approx((risks[749] + risks[750]) / 2)


def test_saved_learner_scores_the_same(spark, modeling, two, tmp_path):
    crossed = learners.fit_crossed(modeling, learners.Boosting(trees=3, depth=2), two)
    for learner in (two, crossed):
        learner.save(spark, str(tmp_path / learner.kind))
        back = learners.load_learner(spark, str(tmp_path / learner.kind))
        assert back.kind == learner.kind and back.risk_threshold == learner.risk_threshold
        assert back.score(modeling).exceptAll(learner.score(modeling)).count() == 0
        facts = back.metadata(spark).first()
        assert (facts.n_training_samples, facts.n_features) == (1500, 21)


def test_unseen_and_missing_text_get_code_zero(spark):
    known = spark.createDataFrame([("b",), ("c",), ("a",)], "x string")
    coded = learners.fit_encoder(known, ["x"]).transform(spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "x string"))
    assert [r.x__code for r in coded.collect()] == [0.0, 1.0, 2.0, 0.0, 0.0]


def test_folds_are_stratified(spark):
    rows = spark.range(1003).select("id", F.when(F.col("id") % 10 == 0, 1.0).otherwise(0.0).alias("label"))
    folded = learners.stratified_folds(rows, "label", "id")
    counts = folded.groupBy("label", "fold").count().collect()
    for label, low, high in ((1.0, 20, 21), (0.0, 180, 181)):
        sizes = [r["count"] for r in counts if r.label == label]
        assert len(sizes) == 5 and min(sizes) >= low and max(sizes) <= high


def test_propensity_picks_the_better_auc(spark, modeling):
    fit = learners.fit_propensity(modeling, boosting=learners.Boosting(trees=2, depth=2, sample=1.0, min_leaf=30), folds=2)
    better = "boosted" if fit.auc["boosted"][0] > fit.auc["logistic"][0] else "logistic"
    assert fit.chosen == better and all(0.5 < mean < 1 for mean, _ in fit.auc.values())
    scores = fit.score(modeling).agg(F.min("propensity"), F.max("propensity"), F.count("propensity")).first()
    assert 0 < scores[0] < scores[1] < 1 and scores[2] == 1500
    assert learners.top_importances(spark, fit).count() == 5


def test_crossed_effects_have_their_sign_turned(spark):
    rows = spark.createDataFrame([(-0.2, -0.4, 0.99)], "a double, b double, p double")
    got = rows.select(uplift.combine_effects(F.col("a"), F.col("b"), F.col("p")).alias("u")).first().u
    assert got == pytest.approx(0.95 * 0.2 + 0.05 * 0.4)


def test_logistic_model_works_in_a_session_that_observed(spark):
    rows = spark.createDataFrame([(float(i), float(i % 3 == 0), i % 2) for i in range(60)], "x double, label double, fold int")
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 60}
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    found = learners.fit_validated(learners.logistic(60), rows, folds=2)
    scored = found.model.transform(rows).select(vector_to_array("probability")[1].alias("p")).collect()
    assert len(scored) == 60 and sum(r.p for r in scored) == pytest.approx(20, abs=0.1)


def test_validation_is_that_of_spark(spark):
    rows = spark.createDataFrame([(float(i * 7 % 20), float(i % 3 == 0 or i % 20 > 11), i % 3) for i in range(90)], "x double, label double, fold int")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    found = learners.fit_validated(learners.logistic(90), rows, folds=3)
    spark_s = CrossValidator(
        estimator=learners.logistic(90), estimatorParamMaps=[{}], evaluator=BinaryClassificationEvaluator(), numFolds=3, foldCol="fold"
    ).fit(rows)
    assert (found.auc_mean, found.auc_std) == (pytest.approx(spark_s.avgMetrics[0]), pytest.approx(spark_s.stdMetrics[0]))
    assert list(found.model.coefficients) == pytest.approx(list(spark_s.bestModel.coefficients))
    for folds in (2, 4):
        with pytest.raises(ValueError, match="fold"):
            learners.fit_validated(learners.logistic(90), rows, folds=folds)


def test_fits_have_tasks_in_proportion_to_their_rows():
    assert [learners.fit_tasks(n) for n in (0, 1, 50_000, 50_001, 90_000_000)] == [1, 1, 1, 2, 1800]


class Asked(Exception):
    pass


def settings(spark, monkeypatch, name, fit):
    """The settings that a query's fit is called with."""
    signature = inspect.signature(getattr(learners, fit))

    def spy(*args, **given):
        call = signature.bind(*args, **given)
        call.apply_defaults()
        raise Asked(call.arguments)

    monkeypatch.setattr(catalog, "_fitted", {})
    monkeypatch.setattr(learners, fit, spy)
    with pytest.raises(Asked) as found:
        catalog.QUERIES[name](spark, SMALL)
    return found.value.args[0]


def test_fitted_crossed_has_the_published_settings(spark, monkeypatch, two):
    monkeypatch.setattr(catalog, "two_models", lambda *_: two)
    asked = settings(spark, monkeypatch, "fitted_crossed", "fit_crossed")
    assert asked["boosting"] == learners.Boosting() and asked["base"] is two


def test_fitted_importance_comparison_has_the_published_settings(spark, monkeypatch):
    asked = settings(spark, monkeypatch, "fitted_importance_comparison", "fit_two_models")
    assert (asked["boosting"], asked["folds"], asked["validate"]) == (learners.Boosting(), 5, True)


def test_fitted_propensity_has_the_published_settings(spark, monkeypatch):
    asked = settings(spark, monkeypatch, "fitted_propensity", "fit_propensity")
    assert (asked["boosting"], asked["folds"]) == (learners.PROPENSITY_BOOSTING, 5)


def test_fitted_propensity_effect_has_the_published_settings(spark, monkeypatch):
    asked = settings(spark, monkeypatch, "fitted_propensity_effect", "fit_propensity")
    assert (asked["boosting"], asked["folds"]) == (learners.PROPENSITY_BOOSTING, 5)


def test_saved_learner_responses_has_the_published_settings(spark, monkeypatch):
    asked = settings(spark, monkeypatch, "saved_learner_responses", "fit_two_models")
    assert (asked["boosting"], asked["folds"], asked["validate"]) == (learners.Boosting(), 5, True)
