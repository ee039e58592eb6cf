"""Ranking metrics and effects: definitions on small arrays, edges, and properties."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.plans import campaign, effects, evaluation, fairness, retention, uplift


def frame(spark, scores, y, t):
    rows = [(i, float(s), int(a), int(b)) for i, (s, a, b) in enumerate(zip(scores, y, t))]
    return spark.createDataFrame(rows, "customer_id long, s double, churn_binary int, treatment int")


def ranked(spark, scores, y, t):
    return evaluation.ranked_scores(frame(spark, scores, y, t), {"m": "s"})


def steps(spark, scores, y, t, percents=evaluation.TOP_PERCENTS):
    return evaluation.rank_steps(ranked(spark, scores, y, t), percents)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    n = 777
    scores = np.round(rng.normal(size=n), 1)
    t = (rng.random(n) < 0.4).astype(int)
    y = (rng.random(n) < 0.5 - 0.1 * t * np.sign(scores)).astype(int)
    order = np.lexsort((np.arange(n), -scores))
    return scores, y, t, y[order], t[order]


def gap(y, t):
    return y[t == 0].mean() - y[t == 1].mean()


def test_qini_by_definition(spark, sample):
    scores, y, t, ys, ts = sample
    n, step = len(y), len(y) // 100
    expected = {
        k: gap(ys[:k], ts[:k]) * k / n
        for k in range(1, n + 1, step)
        if 0 < ts[:k].sum() < k
    }
    curve = evaluation.qini_curve(steps(spark, scores, y, t))
    rows = {r.k: r for r in curve.collect()}
    assert rows.keys() == expected.keys()
    assert all(rows[k].qini == pytest.approx(v, abs=1e-12) for k, v in expected.items())
    assert all(r.random_qini == pytest.approx(gap(y, t) * k / n, abs=1e-12) for k, r in rows.items())
    points = np.array(sorted((k / n, v - gap(y, t) * k / n) for k, v in expected.items()))
    area = np.sum((points[1:, 1] + points[:-1, 1]) / 2 * np.diff(points[:, 0]))
    assert evaluation.qini_coefficients(curve).first().qini_coefficient == pytest.approx(area, abs=1e-12)


def test_uplift_at_k_by_definition(spark, sample):
    scores, y, t, ys, ts = sample
    got = {r.k_pct: r for r in evaluation.uplift_at_k(steps(spark, scores, y, t, (10, 30, 100)), (10, 30, 100)).collect()}
    for k, row in got.items():
        cut = int(len(y) * k / 100)
        effect = gap(ys[:cut], ts[:cut])
        assert (row.n_targeted, row.n_treated, row.n_control) == (cut, ts[:cut].sum(), cut - ts[:cut].sum())
        assert row.effect == pytest.approx(effect)
        assert row.capture_pct == pytest.approx(effect / gap(y, t) * (k / 100) * 100)
    assert got[100].effect == pytest.approx(gap(y, t))


def test_cumulative_gain_by_definition(spark, sample):
    scores, y, t, ys, ts = sample
    expected = {k: gap(ys[:k], ts[:k]) for k in range(100, len(y) + 1, len(y) // 100)}
    got = {r.k: r.gain for r in evaluation.cumulative_gain(steps(spark, scores, y, t)).collect()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_gain_needs_a_hundred_rows(spark):
    assert evaluation.cumulative_gain(steps(spark, range(99), [0, 1] * 49 + [1], [1, 0, 0] * 33)).count() == 0


def test_short_frames_step_by_one_and_skip_one_armed_points(spark):
    curve = evaluation.qini_curve(steps(spark, range(10, 0, -1), [0, 1, 0, 1, 1, 0, 0, 1, 0, 0], [1, 1, 1, 0, 0, 1, 0, 0, 1, 0]))
    assert [r.k for r in curve.orderBy("k").collect()] == [4, 5, 6, 7, 8, 9, 10]


def test_one_arm_gives_zeros_and_an_empty_curve(spark):
    one_arm = ranked(spark, [4, 3, 2, 1], [1, 0, 1, 0], [1, 1, 1, 1])
    between = evaluation.rank_steps(one_arm, (50, 100))
    assert evaluation.qini_curve(between).count() == 0
    for row in evaluation.uplift_at_k(between, (50, 100)).collect():
        assert (row.effect, row.capture_pct, row.n_control) == (0.0, 0.0, 0)
    report = evaluation.learner_report(one_arm).first()
    assert report.qini_coefficient == 0.0 and report.median_uplift == 2.5


def test_cuts_give_what_ranked_rows_give(spark, sample):
    scores, y, t, _, _ = sample
    rows = frame(spark, scores, y, t).withColumns({"other": F.when(F.col("customer_id") % 7 != 0, F.col("s") * F.col("customer_id")), "none": F.lit(None).cast("double")})
    learners = {"m": "s", "o": "other", "n": "none"}
    plain = evaluation.ranked_scores(rows, learners)
    cuts = evaluation.cut_scores(rows, learners)
    summed = lambda steps: {tuple(r) for r in steps.groupBy("learner", "n_rows", "qini_step", "gain_step", "top").sum("n_t", "n_c", "y_t", "y_c").collect()}
    assert summed(cuts.steps) == summed(evaluation.rank_steps(plain))
    assert {tuple(r) for r in evaluation.learner_report(cuts).collect()} == {tuple(r) for r in evaluation.learner_report(plain).collect()}


def test_learner_report_uses_population_spread(spark, sample):
    scores, y, t, _, _ = sample
    row = evaluation.learner_report(ranked(spark, scores, y, t)).first()
    assert row.std_uplift == round(float(scores.std()), 4)
    assert row.median_uplift == round(float(np.median(scores)), 4)
    assert row.pct_positive_uplift == round(float((scores > 0).mean() * 100), 1)


def test_comparison_of_equal_learners_prefers_the_simpler(spark, sample):
    scores, y, t, _, _ = sample
    rows = frame(spark, scores, y, t).withColumn("s2", F.col("s") * 2)
    row = evaluation.compare_learners(rows, ("a", "s"), ("b", "s2")).first()
    assert (row.winner, row.recommended, row.correlation, row.agreement) == ("b", "a", 1.0, "High agreement")
    assert row.effect_10_first == row.effect_10_second and row.first_gain_first is not None


def test_constant_propensity_changes_nothing(spark, sample):
    scores, y, t, _, _ = sample
    row = effects.effect_estimates(frame(spark, scores, y, t).withColumn("propensity_score", F.lit(0.4))).first()
    assert row.ipw_ate == pytest.approx(row.naive_ate) and row.naive_ate == pytest.approx(gap(y, t))


def test_extreme_propensities_are_held_off(spark):
    rows = frame(spark, [1, 2], [1, 0], [1, 0]).withColumn("propensity_score", F.lit(0.0))
    assert effects.weight_diagnostics(rows).first().max_weight == 20.0


def test_balance_of_constant_and_equal_features(spark):
    rows = spark.createDataFrame([(t, 7.0, x) for t in (0, 1) for x in (1.0, 2.0, 3.0)], "treatment int, c double, x double")
    got = {r.feature: r for r in effects.covariate_balance(rows.withColumn("propensity_score", F.lit(0.5)), ["c", "x"]).collect()}
    assert (got["c"].smd_raw, got["c"].smd_ipw, got["x"].smd_raw, got["x"].smd_ipw) == (0.0, 0.0, 0.0, 0.0)


def test_balance_by_definition(spark, sample):
    scores, y, t, _, _ = sample
    rng = np.random.default_rng(5)
    e = rng.uniform(0.02, 0.98, len(t))
    rows = spark.createDataFrame(
        [(float(s), int(a), float(p)) for s, a, p in zip(scores, t, e)], "x double, treatment int, propensity_score double"
    )
    got = effects.covariate_balance(rows, ["x"]).first()
    e, x_t, x_c = np.clip(e, 0.05, 0.95), scores[t == 1], scores[t == 0]
    spread = np.sqrt((x_t.var() + x_c.var()) / 2)
    weighted = np.average(x_t, weights=1 / e[t == 1]) - np.average(x_c, weights=1 / (1 - e[t == 0]))
    assert got.smd_raw == pytest.approx(abs(x_t.mean() - x_c.mean()) / spread, abs=1e-6)
    assert got.smd_ipw == pytest.approx(abs(weighted) / spread, abs=1e-6)


def test_quadrants_partition_the_rows_and_fairness_adds_up(small_modeling):
    segmented = uplift.segment(uplift.score_by_cells(small_modeling))
    assert segmented.where(F.col("quadrant").isNull()).count() == 0
    assert uplift.quadrant_summary(segmented).agg(F.sum("n_customers")).first()[0] == 150
    sums = fairness.fairness_report(segmented).groupBy("demographic").agg(F.sum("n_customers").alias("n")).collect()
    assert {r.n for r in sums} == {150} and len(sums) == 3


def test_one_group_has_no_parity_verdict(small_modeling):
    men = uplift.segment(uplift.score_by_cells(small_modeling), 0.3).withColumn("gender", F.lit("Male"))
    assert "gender" not in {r.demographic for r in fairness.parity_check(men).collect()}


def test_a_mean_between_two_cents_is_rounded_away_from_zero(spark):
    rows = spark.createDataFrame(
        [("Female", 0, "No", "Persuadable", 0.2, 9.0, v) for v in (0.01, 2.26)],
        "gender string, senior_citizen int, partner string, quadrant string, uplift_score double, clv double, value_at_risk double",
    )
    assert {r.avg_value_at_risk for r in fairness.persuadable_value(rows).collect()} == {1.14}


def test_a_budget_below_the_cost_buys_nothing(spark):
    rows = spark.createDataFrame(
        [(i, "Persuadable", 0.2, 100.0 * i, "One year", "DSL") for i in (1, 2, 3)],
        "customer_id long, quadrant string, uplift_score double, value_at_risk double, contract_type string, internet_service string",
    )
    row = campaign.campaign_return(campaign.eligible_targets(rows), budget=10, cost_per_contact=25).first()
    assert (row.n_selected, row.n_eligible, row.campaign_cost, row.roi_pct, row.verdict) == (0, 3, 0.0, 0.0, "negative")
    picked = campaign.select_targets(rows, 60, 25)
    assert [r.customer_id for r in picked.collect()] == [3, 2]
    full = campaign.campaign_return(rows, 60, 25).first()
    assert (full.campaign_cost, full.projected_savings, full.roi_pct, full.saved_per_dollar) == (50.0, 500.0, 900.0, 10.0)


def test_empty_segments_give_zero_kpis(small_modeling):
    nobody = uplift.segment(uplift.score_by_cells(small_modeling), 2.0).where(F.col("quadrant") == "Lost Cause")
    row = uplift.executive_kpis(nobody).first()
    assert (row.persuadable_count, row.persuadable_value, row.avg_persuadable_uplift) == (0, 0.0, 0.0)


def star_of(spark, clvs, treatments):
    n = len(clvs)
    ids = list(range(1, n + 1))
    make = spark.createDataFrame
    return {
        "customers": make([(i, i, "One year") for i in ids], "customer_id long, tenure_months int, contract_type string"),
        "billing": make([(i, 10.0, c) for i, c in zip(ids, clvs)], "customer_id long, monthly_charges double, customer_lifetime_value double"),
        "marketing": make([(i, t, 0.5) for i, t in zip(ids, treatments)], "customer_id long, marketing_offer_given int, propensity_score double"),
        "churn_labels": make([(i, i % 2) for i in ids], "customer_id long, churn_binary int"),
        "services": make([(i, "DSL") for i in ids], "customer_id long, internet_service string"),
    }


def test_equal_values_share_a_percentile_but_not_a_rank(spark):
    rows = retention.high_value_customers(star_of(spark, [5.0, 9.0, 9.0, 9.0, 1.0, 1.0], [0, 1] * 3), k=4).collect()
    assert [(r.customer_id, r.clv_rank, r.clv_percentile) for r in rows] == [(2, 1, 0.0), (3, 2, 0.0), (4, 3, 0.0), (1, 4, 0.6)]
    assert [r.cumulative_revenue_at_risk for r in rows] == [0.0, 120.0, 120.0, 240.0]


def test_uneven_cohorts_and_one_arm(spark):
    rows = retention.tenure_cohorts(star_of(spark, [1.0] * 13, [1] * 13)).orderBy("tenure_decile").collect()
    assert [r.customer_count for r in rows] == [2, 2, 2] + [1] * 7
    assert all(r.control_churn_pct is None and r.treatment_rate_pct == 100.0 for r in rows)
    segments = retention.segment_analysis(star_of(spark, [1.0] * 13, [1] * 13), min_n=13).collect()
    assert len(segments) == 1 and segments[0].control_churn_pct is None
    assert retention.segment_analysis(star_of(spark, [1.0] * 13, [1] * 13), min_n=14).count() == 0
