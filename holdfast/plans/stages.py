"""The stages as one batch job, with files between them and in the end.

    python -m holdfast.plans.stages --input EXPORT.csv [--input OLDER.csv] --output FOLDER [--budget 2500] [--cost 25]

reads the first export that can be used, checks and enriches it, stores the five
tables and the modeling dataset, fits, scores, evaluates, and writes:
``modeling``, ``scored`` (Parquet), ``model_report``, ``fairness_report`` and
``targets`` (CSV). ``spark.checkpoint.dir`` names the scratch folder, which is
empty again when the job ends.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators import checks
from holdfast.plans import campaign, evaluation, fairness, intake, learners, retention, uplift
from holdfast.schemas import MODELING_COLUMNS, RAW_CUSTOMERS
from holdfast.session import build_session, owned_scratch, store
from holdfast.sources import files
from holdfast.sources import tables as layout

T_LEARNER, X_LEARNER = "T-Learner", "X-Learner"


def export_modeling(modeling: DataFrame, path: str) -> None:
    """Write the modeling dataset if it has rows and all its columns; else raise."""
    absent = checks.missing_columns(modeling, MODELING_COLUMNS)
    if absent:
        raise checks.CheckFailed(f"missing columns: {', '.join(absent)}")
    if not checks.is_non_empty(modeling):
        raise checks.CheckFailed("the modeling dataset has no rows")
    modeling.select(MODELING_COLUMNS).write.mode("overwrite").parquet(path)


def closed_form_scores(modeling: DataFrame) -> DataFrame:
    """Both closed-form learners on the same rows, with the segments of the first."""
    crossed = uplift.score_by_crossed_cells(modeling).select("customer_id", "uplift_score_xl", "mu_0_xl", "mu_1_xl")
    return uplift.segment(store(uplift.score_by_cells(modeling).join(crossed, "customer_id")))


def fitted_scores(modeling: DataFrame, boosting: learners.Boosting | None = None) -> DataFrame:
    """The same by the fitted two-model and crossed learners; without settings, the published ones."""
    settings = boosting or learners.Boosting()
    two = learners.fit_two_models(modeling, settings)
    crossed = learners.fit_crossed(modeling, settings, two)
    pair = crossed.score(modeling).select("customer_id", "uplift_score_xl", "mu_0_xl", "mu_1_xl")
    return uplift.segment(store(two.score(modeling).join(pair, "customer_id")), two.risk_threshold)


def write_reports(scored: DataFrame, folder: str, budget: float, cost: float) -> None:
    """Model report, fairness report and target list, as files."""
    pairs = {T_LEARNER: "uplift_score", X_LEARNER: "uplift_score_xl"}
    files.write_report(evaluation.learner_report(evaluation.cut_scores(scored, pairs)), f"{folder}/model_report")
    files.write_report(fairness.fairness_report(scored), f"{folder}/fairness_report")
    eligible = campaign.eligible_targets(scored)
    files.write_csv(campaign.target_list(campaign.select_targets(eligible, budget, cost, spread=True)), f"{folder}/targets")


def run(spark: SparkSession, sources: Sequence[str], folder: str, budget: float = 2_500, cost: float = 25, fitted: bool = True) -> None:
    """All stages in order; raises on the first check that fails."""
    with owned_scratch(spark):
        enriched = intake.enrich(intake.clean(files.first_available(spark, sources, RAW_CUSTOMERS)))
        checks.require(intake.check_enriched(enriched))
        intake.load_checked(intake.five_tables(enriched), f"{folder}/tables")
        tables = layout.read_tables(spark, f"{folder}/tables")
        export_modeling(retention.modeling_dataset(tables), f"{folder}/modeling")
        modeling = files.read_required(spark, f"{folder}/modeling", "export_modeling")
        scored = fitted_scores(modeling) if fitted else closed_form_scores(modeling)
        scored.write.mode("overwrite").parquet(f"{folder}/scored")
        write_reports(files.read_required(spark, f"{folder}/scored", "run"), folder, budget, cost)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--input", action="append", required=True, help="CSV exports, best first")
    parser.add_argument("--output", required=True)
    parser.add_argument("--budget", type=float, default=2_500)
    parser.add_argument("--cost", type=float, default=25)
    parser.add_argument("--closed-form", action="store_true", help="cell means instead of fitted models")
    given = parser.parse_args()
    spark = build_session("holdfast-stages")
    run(spark, given.input, given.output, given.budget, given.cost, fitted=not given.closed_form)
    spark.stop()


if __name__ == "__main__":
    main()
