"""Every registered query: name to a function of (session, source folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import customer, segments
from holdfast.functions.numeric import fixed
from holdfast.operators import checks
from holdfast.operators.attach import attach
from holdfast.operators.cuts import scan
from holdfast.operators.prefix import prefix_sums
from holdfast.operators.quantiles import SKETCH_ERROR, approximate_percentiles, merged_sketches, percentiles, quantile_sketches, sketched_percentiles
from holdfast.operators.ranking import global_rank, tile, top_rows
from holdfast.plans import campaign, effects, evaluation, fairness, intake, learners, retention, scoring, stages, uplift
from holdfast.schemas import RAW_CUSTOMERS, REQUEST, SNAKE_CASE
from holdfast.session import settle, shared_folder, store
from holdfast.sources import files, rescued
from holdfast.sources import tables as layout
from holdfast.streaming import scoring as streaming
from registry.fixtures import dirty_tables, flat, modeling, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BUDGET, COST = 2_500, 25
LEARNERS = {"T-Learner": "uplift_score", "X-Learner": "uplift_score_xl"}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: fixed(F.col(name), digits) for name in columns})


def _by_customer(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two frames of all customers put together; neither is sent to the driver to be broadcast."""
    return first.join(second.hint("merge"), "customer_id")


# ------------------------------------------------------- sources and cleaning


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as an export writes them: total charges are text, blank for new customers."""
    rows = flat(spark, sf_dir)
    total = F.when(F.col("tenure_months") == 0, " ").otherwise(F.col("total_charges").cast("string"))
    rows = rows.withColumn("total_charges", total)
    return rows.select(
        [F.col(SNAKE_CASE[f.name]).cast(f.dataType).alias(f.name) for f in RAW_CUSTOMERS]
    )


@query
def customer_csv_round_trip(spark, sf_dir):
    """The export written as CSV and found as the second of two sources."""
    folder = _scratch(spark, "export")
    files.write_csv(raw_customers(spark, sf_dir), f"{folder}/customers")
    return files.first_available(spark, [f"{folder}/absent", f"{folder}/customers"], RAW_CUSTOMERS)


@query
def cleaned_customers(spark, sf_dir):
    return layout.snake_case(intake.clean(raw_customers(spark, sf_dir)))


@query
def enriched_customers(spark, sf_dir):
    """Lifetime value and the training form of the risk score, with the top 30 percent marked."""
    rows = layout.snake_case(intake.clean(raw_customers(spark, sf_dir)))
    tenure, monthly, contract = F.col("tenure_months"), F.col("monthly_charges"), F.col("contract_type")
    rows = rows.select(
        "customer_id",
        fixed(customer.lifetime_value(monthly, tenure, contract), 2).alias("customer_lifetime_value"),
        fixed(customer.risk_score(tenure, monthly, contract, F.col("churn_binary")), 2).alias("risk_score"),
    )
    return intake.flag_high_risk(rows, "risk_score", "customer_id")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.enrich(intake.clean(raw_customers(spark, sf_dir)))


@query
def enriched_export(spark, sf_dir):
    """The export with its added columns; the drawn offer has no SQL equal and is left out."""
    return enriched(spark, sf_dir).drop("Marketing_Offer_Given")


@query
def enriched_export_checks(spark, sf_dir):
    return intake.check_enriched(enriched(spark, sf_dir))


@query
def modeling_export(spark, sf_dir):
    """The modeling dataset after its checked export, read back."""
    folder = _scratch(spark, "modeling")
    stages.export_modeling(modeling(spark, sf_dir), folder)
    return files.read_required(spark, folder, "export_modeling")


def _job(spark: SparkSession, sf_dir: str) -> str:
    """One run of the batch job over the export as files, with the closed-form learners; gives its folder."""
    def run() -> str:
        folder = _scratch(spark, "job")
        known = _by_customer(segmented(spark, sf_dir), both_scores(spark, sf_dir).select("customer_id", "uplift_score_xl"))
        stages.write_reports(store(known), folder, BUDGET, COST)
        return folder

    return _once(spark, sf_dir, "job", run)


@query
def written_model_report(spark, sf_dir):
    """The model report as the job writes it, read back."""
    kinds = learner_report(spark, sf_dir).schema
    return files.read_required(spark, f"{_job(spark, sf_dir)}/model_report", "write_reports", kinds)


@query
def written_fairness_report(spark, sf_dir):
    return files.read_required(spark, f"{_job(spark, sf_dir)}/fairness_report", "write_reports", fairness.fairness_report(segmented(spark, sf_dir)).schema)


@query
def written_targets(spark, sf_dir):
    kinds = campaign.target_list(segmented(spark, sf_dir)).schema
    return _rounded(files.read_required(spark, f"{_job(spark, sf_dir)}/targets", "write_reports", kinds), 6, "uplift_score")


@query
def offer_assignment(spark, sf_dir):
    """Offers drawn by a hash of the key with each customer's propensity."""
    rows = modeling(spark, sf_dir).select("customer_id", "propensity_score")
    return rows.withColumn("offer", customer.hashed_assignment(F.col("customer_id"), F.col("propensity_score")))


def _register_table(name: str) -> None:
    QUERIES[f"table_{name}"] = lambda spark, sf_dir: tables(spark, sf_dir)[name]


for _name in ("customers", "services", "billing", "marketing", "churn_labels"):
    _register_table(_name)


@query
def table_refresh_and_append(spark, sf_dir):
    """A table replaced twice and then appended to: treated first, control after."""
    folder, rows = _scratch(spark, "refresh"), tables(spark, sf_dir)["marketing"]
    offered = F.col("marketing_offer_given") == 1
    layout.write_tables({"marketing": rows}, folder)
    layout.write_tables({"marketing": rows.where(offered)}, folder)
    layout.write_tables({"marketing": rows.where(~offered)}, folder, mode="append")
    return layout.read_table(spark, folder, "marketing")


@query
def table_after_failed_refresh(spark, sf_dir):
    """Two tables published, then a refresh of both whose second fails: what readers find is the first set."""
    folder, known = _scratch(spark, "publish"), tables(spark, sf_dir)
    both = {name: known[name] for name in ("marketing", "billing")}
    layout.write_tables(both, folder)
    failing = F.when(F.col("monthly_charges") >= 0, F.raise_error(F.lit("the source broke off"))).otherwise(0.0)
    broken = {"marketing": both["marketing"].limit(0), "billing": both["billing"].withColumn("monthly_charges", failing)}
    try:
        layout.write_tables(broken, folder)
    except (PythonException, SparkRuntimeException):
        pass
    found = {name: layout.read_table(spark, folder, name) for name in both}
    return found["marketing"].join(found["billing"], "customer_id")


@query
def absent_tables(spark, sf_dir):
    """Which tables can be read from a folder where only some were published; the others name their maker."""
    folder, known = _scratch(spark, "some"), tables(spark, sf_dir)
    layout.write_tables({name: known[name] for name in ("customers", "billing")}, folder)
    found = []
    for name in known:
        try:
            found.append(layout.read_table(spark, folder, name).agg(F.count("*").alias("n_rows"), F.lit(None).cast("string").alias("advice")))
        except files.MissingInput as missing:
            advice = str(missing).rsplit("; ", 1)[1]
            found.append(known[name].limit(0).agg(F.lit(None).cast("long").alias("n_rows"), F.lit(advice).alias("advice")))
        found[-1] = found[-1].select(F.lit(name).alias("table"), "n_rows", "advice")
    return reduce(DataFrame.unionByName, found)


@query
def catalog_report(spark, sf_dir):
    return layout.catalog_report(tables(spark, sf_dir))


@query
def table_row_counts(spark, sf_dir):
    return layout.row_counts(tables(spark, sf_dir))


@query
def table_checks(spark, sf_dir):
    return checks.check_tables(tables(spark, sf_dir))


@query
def table_checks_while_writing(spark, sf_dir):
    """The same report, counted by the jobs that write the tables and over the keys they wrote."""
    return intake.load_checked(tables(spark, sf_dir), _scratch(spark, "checked"))


@query
def table_checks_of_broken_rows(spark, sf_dir):
    """The same rules over tables in which every one of them is broken."""
    return checks.check_tables(dirty_tables(spark, sf_dir))


@query
def null_total_of_broken_rows(spark, sf_dir):
    return checks.null_total(dirty_tables(spark, sf_dir)["services"])


@query
def join_completeness(spark, sf_dir):
    return checks.join_is_complete(tables(spark, sf_dir))


@query
def null_total(spark, sf_dir):
    return checks.null_total(modeling(spark, sf_dir))


# ------------------------------------------------------------------- reports


@query
def q1_modeling_dataset(spark, sf_dir):
    return retention.modeling_dataset(tables(spark, sf_dir), ordered=True)


@query
def q2_tenure_cohorts(spark, sf_dir):
    return retention.tenure_cohorts(tables(spark, sf_dir))


@query
def q3_treatment_comparison(spark, sf_dir):
    return retention.treatment_comparison(tables(spark, sf_dir))


@query
def q3_treatment_comparison_union(spark, sf_dir):
    return retention.treatment_comparison_union(tables(spark, sf_dir))


@query
def q4_high_value_customers(spark, sf_dir):
    return retention.high_value_customers(tables(spark, sf_dir))


@query
def q4_all_customers_by_value(spark, sf_dir):
    """Q4 without its limit: rank, percentile, the customer before, and the running exposure, for every customer."""
    return retention.customers_by_value(tables(spark, sf_dir))


@query
def q5_segment_analysis(spark, sf_dir):
    return retention.segment_analysis(tables(spark, sf_dir))


@query
def data_summary(spark, sf_dir):
    return retention.data_summary(modeling(spark, sf_dir))


@query
def distinct_segments(spark, sf_dir):
    rows = modeling(spark, sf_dir)
    return rows.select("contract_type", "internet_service").distinct()


# ------------------------------------------------------------- scale operators


@query
def rank_all_customers(spark, sf_dir):
    rows = modeling(spark, sf_dir).select("customer_id", "clv")
    return global_rank(rows, [F.desc("clv"), F.asc("customer_id")])


@query
def rank_within_contract(spark, sf_dir):
    rows = modeling(spark, sf_dir).select("customer_id", "contract_type", "clv")
    return global_rank(rows, [F.desc("clv"), F.asc("customer_id")], by=["contract_type"])


@query
def tenure_tiles(spark, sf_dir):
    rows = modeling(spark, sf_dir).select("customer_id", "tenure_months")
    ranked = global_rank(rows, [F.asc("tenure_months"), F.asc("customer_id")])
    return ranked.select("customer_id", tile(F.col("rank"), F.col("n_rows"), 7).alias("tile"))


@query
def percentiles_by_contract(spark, sf_dir):
    rows = modeling(spark, sf_dir)
    found = percentiles(
        rows, "clv", {"p10": 0.1, "median": 0.5, "p70": 0.7, "p99": 0.99}, "customer_id", by=["contract_type"]
    )
    return _rounded(found, 6, "p10", "median", "p70", "p99")


@query
def approximate_percentiles_by_contract(spark, sf_dir):
    return approximate_percentiles(modeling(spark, sf_dir), "clv", {"p10": 0.1, "median": 0.5}, by=["contract_type"])


@query
def percentiles_of_prices(spark, sf_dir):
    """Exact percentiles of all prices in lineitem, over all rows and by return flag."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_returnflag", "l_extendedprice", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")
    )
    shares = {"p10": 0.1, "median": 0.5, "p99": 0.99}
    every = percentiles(rows, "l_extendedprice", shares, "line").withColumn("l_returnflag", F.lit("all"))
    return _rounded(every.unionByName(percentiles(rows, "l_extendedprice", shares, "line", by=["l_returnflag"])), 6, *shares)


@query
def approximate_percentiles_within_promise(spark, sf_dir):
    """Whether each value of the sketch lies within the promised share of rows from its exact place."""
    rows = modeling(spark, sf_dir).select("contract_type", F.col("clv").cast("double").alias("clv"))
    shares = {"p10": 0.1, "median": 0.5}
    found = attach(rows, approximate_percentiles(rows, "clv", shares, by=["contract_type"]), "contract_type")
    n = F.count("*")
    within = {
        f"{name}_within": (F.count_if(F.col("clv") < F.col(name)) <= n * share + n / 10_000 + 1)
        & (F.count_if(F.col("clv") <= F.col(name)) >= n * share - n / 10_000 - 1)
        for name, share in shares.items()
    }
    return found.groupBy("contract_type").agg(n.alias("n_rows"), *[x.alias(name) for name, x in within.items()])


@query
def merged_sketches_within_promise(spark, sf_dir):
    """Sketches by contract and service of half the customers, stored; those of the others appended; all merged by contract
    and held against the exact places of their values."""
    rows = modeling(spark, sf_dir).select("customer_id", "contract_type", "internet_service", F.col("clv").cast("double").alias("clv"))
    folder, first = _scratch(spark, "sketches"), F.col("customer_id") % 2 == 0
    for part, mode in ((first, "overwrite"), (~first, "append")):
        layout.write_tables({"sketches": quantile_sketches(rows.where(part), "clv", ["contract_type", "internet_service"])}, folder, mode)
    merged = merged_sketches(layout.read_table(spark, folder, "sketches"), ["contract_type"])
    shares = {"p10": 0.1, "median": 0.5, "p99": 0.99}
    found = attach(rows, sketched_percentiles(merged, shares), "contract_type")
    n = F.count("*")
    within = {
        f"{name}_within": (F.count_if(F.col("clv") < F.col(name)) <= n * (share + SKETCH_ERROR) + 1)
        & (F.count_if(F.col("clv") <= F.col(name)) >= n * (share - SKETCH_ERROR) - 1)
        for name, share in shares.items()
    }
    return found.groupBy("contract_type").agg(n.alias("n_rows"), *[x.alias(name) for name, x in within.items()])


@query
def prefix_counts(spark, sf_dir):
    rows = modeling(spark, sf_dir).select("customer_id", "clv", "treatment", "churn_binary")
    ranked = global_rank(rows, [F.desc("clv"), F.asc("customer_id")])
    points = prefix_sums(ranked, 100, {"n_treated": F.col("treatment"), "n_churned": F.col("churn_binary")})
    return points.select("k", "n_treated", "n_churned", "all_n_treated", "all_n_churned")


@query
def top_spenders(spark, sf_dir):
    rows = modeling(spark, sf_dir).select("customer_id", "monthly_charges", "clv")
    return top_rows(rows, 50, [F.desc("monthly_charges"), F.asc("customer_id")])


# ------------------------------------------------------------ closed-form uplift


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uplift.score_by_cells(modeling(spark, sf_dir))


def segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored once and stored; all summaries, fairness reports and campaigns of a session read it."""
    return _once(spark, sf_dir, "segmented", lambda: store(uplift.segment(store(scored(spark, sf_dir)))))


def both_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both learners' scores on the same rows; they share the cell means."""
    crossed = uplift.score_by_crossed_cells(modeling(spark, sf_dir))
    return crossed.withColumn("uplift_score", F.col("mu_0_xl") - F.col("mu_1_xl"))


@query
def cell_means(spark, sf_dir):
    means = uplift.fit_cell_means(uplift.with_tenure_band(modeling(spark, sf_dir)))
    return _rounded(means, 6, "mu_0_control", "mu_1_treatment")


@query
def scored_customers(spark, sf_dir):
    rows = segmented(spark, sf_dir).select(
        "customer_id", "mu_0_control", "mu_1_treatment", "uplift_score", "quadrant", "value_at_risk",
        segments.confidence(F.col("uplift_score")).alias("confidence"),
    )
    return _rounded(rows, 6, "mu_0_control", "mu_1_treatment", "uplift_score")


@query
def scored_customers_serving_threshold(spark, sf_dir):
    rows = uplift.segment(scored(spark, sf_dir), risk_threshold=segments.SERVING_RISK)
    return rows.select("customer_id", "quadrant", "value_at_risk")


@query
def scored_customers_crossed(spark, sf_dir):
    rows = uplift.segment(
        uplift.score_by_crossed_cells(modeling(spark, sf_dir)), uplift="uplift_score_xl", risk="mu_0_xl", suffix="_xl"
    ).select("customer_id", "mu_0_xl", "mu_1_xl", "uplift_score_xl", "quadrant_xl", "value_at_risk_xl")
    return _rounded(rows, 6, "mu_0_xl", "mu_1_xl", "uplift_score_xl")


@query
def paired_scores(spark, sf_dir):
    """Two separately scored frames put together by customer."""
    first = scored(spark, sf_dir).select("customer_id", "treatment", "churn_binary", "uplift_score")
    second = uplift.score_by_crossed_cells(modeling(spark, sf_dir)).select("customer_id", "uplift_score_xl")
    rows = _by_customer(first, second)
    return _rounded(rows, 6, "uplift_score", "uplift_score_xl")


@query
def score_distribution(spark, sf_dir):
    return uplift.score_distribution(scored(spark, sf_dir))


def _register_summary(name: str, function: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: function(segmented(spark, sf_dir))


for _name, _function in {
    "quadrant_summary": uplift.quadrant_summary,
    "quadrant_counts": uplift.quadrant_counts,
    "value_at_stake": uplift.value_at_stake,
    "value_by_quadrant": uplift.value_by_quadrant,
    "segment_deep_dive": uplift.segment_deep_dive,
    "executive_kpis": uplift.executive_kpis,
    "fairness_quadrant_rates": fairness.quadrant_rates_report,
    "fairness_parity": fairness.parity_check,
    "fairness_uplift_by_group": fairness.uplift_by_group,
    "fairness_uplift_gap": fairness.uplift_gap,
    "fairness_persuadable_value": fairness.persuadable_value,
    "fairness_report": fairness.fairness_report,
}.items():
    _register_summary(_name, _function)


# ---------------------------------------------------------------- effects


@query
def ate_comparison(spark, sf_dir):
    return effects.ate_comparison(modeling(spark, sf_dir))


@query
def inverse_weights(spark, sf_dir):
    rows = effects.with_weights(modeling(spark, sf_dir)).select("customer_id", "w_treated", "w_control")
    return _rounded(rows, 6, "w_treated", "w_control")


@query
def weight_diagnostics(spark, sf_dir):
    return effects.weight_diagnostics(modeling(spark, sf_dir))


@query
def encoded_features(spark, sf_dir):
    names = effects.PROPENSITY_FEATURES
    return learners.encoded_columns(modeling(spark, sf_dir).select("customer_id", *names), names)


@query
def feature_matrix(spark, sf_dir):
    """The learners' feature vectors, value by value: what the drop list leaves, text as its place in sorted order."""
    rows = modeling(spark, sf_dir)
    names = learners.feature_columns(rows)
    vectors = learners.encoded(learners.fit_encoder(rows, names), rows, "customer_id")
    values = vectors.select("customer_id", F.posexplode(vector_to_array("features")).alias("position", "value"))
    named = values.withColumn("feature", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("position") + 1))
    return _rounded(named.select("customer_id", "feature", "value"), 6, "value")


@query
def fold_sizes(spark, sf_dir):
    """Rows of each arm in each of the folds that validation uses."""
    rows = modeling(spark, sf_dir).select("customer_id", "treatment")
    folded = learners.stratified_folds(rows, "treatment", "customer_id")
    return folded.groupBy("treatment", "fold").agg(F.count("*").alias("n_rows"))


@query
def encoded_unseen_values(spark, sf_dir):
    """An encoder fitted without two-year contracts gives them code 0."""
    rows = modeling(spark, sf_dir).select("customer_id", "contract_type")
    known = rows.where(F.col("contract_type") != "Two year")
    coded = learners.fit_encoder(known, ["contract_type"]).transform(rows)
    return coded.select("customer_id", F.col("contract_type__code").alias("code"))


def _balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = effects.PROPENSITY_FEATURES
    rows = modeling(spark, sf_dir).select("treatment", "propensity_score", *names)
    return effects.covariate_balance(learners.encoded_columns(rows, names), names)


@query
def covariate_balance(spark, sf_dir):
    return _balance(spark, sf_dir)


@query
def covariate_balance_summary(spark, sf_dir):
    return effects.balance_summary(_balance(spark, sf_dir))


# ---------------------------------------------------------------- evaluation


def cuts(spark: SparkSession, sf_dir: str) -> evaluation.ScoreCuts:
    return evaluation.cut_scores(both_scores(spark, sf_dir), LEARNERS)


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts(spark, sf_dir).steps


@query
def qini_curve(spark, sf_dir):
    return _rounded(evaluation.qini_curve(steps(spark, sf_dir)), 6, "fraction", "qini", "random_qini")


@query
def qini_coefficients(spark, sf_dir):
    return _rounded(evaluation.qini_coefficients(evaluation.qini_curve(steps(spark, sf_dir))), 6, "qini_coefficient")


@query
def uplift_at_k(spark, sf_dir):
    return _rounded(evaluation.uplift_at_k(steps(spark, sf_dir)), 6, "effect", "capture_pct")


@query
def cumulative_gain(spark, sf_dir):
    return _rounded(evaluation.cumulative_gain(steps(spark, sf_dir)), 6, "fraction", "gain")


@query
def learner_report(spark, sf_dir):
    return evaluation.learner_report(cuts(spark, sf_dir))


@query
def compare_learners(spark, sf_dir):
    rows = store(both_scores(spark, sf_dir).select("customer_id", "treatment", "churn_binary", *LEARNERS.values()))
    first, second = LEARNERS.items()
    return evaluation.compare_learners(rows, first, second)


@query
def score_correlation(spark, sf_dir):
    return evaluation.score_correlation(both_scores(spark, sf_dir), *LEARNERS.values())


# ---------------------------------------------------------------- campaigns


@query
def campaign_targets(spark, sf_dir):
    chosen = campaign.select_targets(campaign.eligible_targets(segmented(spark, sf_dir)), BUDGET, COST)
    return _rounded(campaign.target_list(chosen), 6, "uplift_score")


@query
def campaign_targets_filtered(spark, sf_dir):
    eligible = campaign.eligible_targets(
        segmented(spark, sf_dir), min_uplift=0.05, contracts=["Month-to-month", "One year"], internet=["Fiber optic"]
    )
    return _rounded(campaign.target_list(campaign.select_targets(eligible, BUDGET, COST)), 6, "uplift_score")


@query
def campaign_targets_large(spark, sf_dir):
    """Every eligible customer as a target, with the place in the list."""
    eligible = campaign.eligible_targets(segmented(spark, sf_dir), min_uplift=0.01)
    return campaign.placed_targets(eligible, 1e9, COST).select("place", "customer_id", "value_at_risk")


@query
def campaign_return(spark, sf_dir):
    return campaign.campaign_return(campaign.eligible_targets(segmented(spark, sf_dir)), BUDGET, COST)


@query
def campaign_list_display(spark, sf_dir):
    chosen = campaign.select_targets(campaign.eligible_targets(segmented(spark, sf_dir)), BUDGET, COST)
    return campaign.target_list_display(chosen)


# ------------------------------------------------------------------- scoring


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a scoring request, some of them broken in a known way."""
    rows, key = flat(spark, sf_dir), F.col("customer_id")
    rows = rows.withColumns(
        {
            "payment_method": F.when(key % 10 == 0, "Cash").otherwise(F.col("payment_method")),
            "tenure_months": F.when(key % 11 == 0, 99).otherwise(F.col("tenure_months")),
            "gender": F.when(key % 13 != 0, F.col("gender")),
            "multiple_lines": F.when(key % 17 != 0, F.col("multiple_lines")),
            "total_charges": F.when(key % 19 == 0, -1.0).otherwise(F.col("total_charges")),
        }
    )
    return rows.select([F.col(f.name).cast(f.dataType) for f in REQUEST])


# Values that break a field of a request; any other text field takes "??".
BAD_NUMBERS = {"senior_citizen": 7, "tenure_months": 99, "monthly_charges": 500.0, "total_charges": -1.0}


def broken_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a request; of each field some are missing and some hold what is not allowed."""
    rows, key = flat(spark, sf_dir), F.col("customer_id")
    fields = [f for f in REQUEST if f.name != "customer_id"]
    cells = []
    for i, f in enumerate(fields):
        bad = F.lit(BAD_NUMBERS.get(f.name, "??")).cast(f.dataType)
        cell = F.when(key % 101 == i, F.lit(None)).when(key % 101 == 40 + i, bad).otherwise(F.col(f.name).cast(f.dataType))
        cells.append(cell.cast(f.dataType).alias(f.name))
    return rows.select(key.cast("string").alias("customer_id"), *cells)


@query
def request_errors_of_every_rule(spark, sf_dir):
    _, broken = scoring.split_requests(broken_requests(spark, sf_dir))
    return broken.select("customer_id", F.array_join("errors", "; ").alias("errors"))


@query
def response_checks_of_broken_rows(spark, sf_dir):
    """The promises about responses, over responses that break every one of them."""
    rows = scoring.score_batch(requests(spark, sf_dir), cell_outcomes(spark, sf_dir))[0]
    part = F.col("customer_id").cast("long") % 101
    changes = {
        "churn_risk": (0, 1.5), "churn_risk_with_offer": (2, -0.1), "uplift_score": (3, None), "quadrant": (4, "Nobody"),
        "customer_lifetime_value": (5, -1.0), "value_at_risk": (6, None), "confidence": (7, "sure"),
    }
    for name, (k, value) in changes.items():
        rows = rows.withColumn(name, F.when(part == k, F.lit(value).cast(rows.schema[name].dataType)).otherwise(F.col(name)))
    return scoring.check_responses(rows)


def cell_outcomes(spark: SparkSession, sf_dir: str) -> scoring.Outcomes:
    """Cell means of the training rows as a model; settled, so every use reads the same."""
    means = settle(uplift.fit_cell_means(uplift.with_tenure_band(modeling(spark, sf_dir))))
    return lambda rows: attach(uplift.with_tenure_band(rows), means, uplift.CELLS)


@query
def request_errors(spark, sf_dir):
    _, broken = scoring.split_requests(requests(spark, sf_dir))
    return broken.select("customer_id", F.array_join("errors", "; ").alias("errors"))


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a line of JSON; some hold text in number fields, some numbers in quotes, and some break off."""
    rows, key = flat(spark, sf_dir), F.col("customer_id")
    fields = {f.name: F.col(f.name).cast("string") for f in REQUEST}
    fields["tenure_months"] = F.when(key % 23 == 0, "soon").when(key % 23 == 1, "12.5").when(key % 23 == 2, " ").otherwise(fields["tenure_months"])
    fields["monthly_charges"] = F.when(key % 29 == 0, "$20").otherwise(fields["monthly_charges"])
    fields["senior_citizen"] = F.when(key % 31 == 0, "no").when(key % 31 != 1, fields["senior_citizen"])
    line = F.to_json(F.struct(*[x.alias(name) for name, x in fields.items()]))
    return rows.select(F.when(key % 37 == 0, F.substring(line, 1, 50)).otherwise(line).alias("value"))


@query
def request_errors_of_lines(spark, sf_dir):
    """Errors of requests that arrive as text: wrong types are told from missing fields, and lines that break off are kept."""
    folder = _scratch(spark, "lines")
    request_lines(spark, sf_dir).write.text(folder)
    _, broken = scoring.split_requests(rescued.parse_json(spark.read.text(folder), REQUEST))
    texts = F.array_join(F.transform(F.array_sort(F.map_entries("rescued")), lambda e: F.when(e["key"] == "_record", "").otherwise(e["value"])), "|")
    return broken.select("customer_id", F.array_join("errors", "; ").alias("errors"), texts.alias("texts"))


@query
def scored_requests(spark, sf_dir):
    return scoring.score_batch(requests(spark, sf_dir), cell_outcomes(spark, sf_dir))[0]


@query
def batch_totals(spark, sf_dir):
    return scoring.score_batch(requests(spark, sf_dir), cell_outcomes(spark, sf_dir))[1]


@query
def response_checks(spark, sf_dir):
    return scoring.check_responses(scoring.score_batch(requests(spark, sf_dir), cell_outcomes(spark, sf_dir))[0])


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Run the scoring stream over all requests as files; gives the output folder."""
    folder = _scratch(spark, "stream")
    requests(spark, sf_dir).repartition(4, "customer_id").write.json(f"{folder}/in")
    streaming.start_scoring(
        streaming.read_requests(spark, f"{folder}/in", files_per_batch=2),
        cell_outcomes(spark, sf_dir), f"{folder}/out", f"{folder}/state", available_now=True,
    ).awaitTermination()
    return f"{folder}/out"


@query
def streamed_scores(spark, sf_dir):
    return spark.read.parquet(f"{_streamed(spark, sf_dir)}/scored").drop("batch")


@query
def streamed_quarantine(spark, sf_dir):
    rows = spark.read.parquet(f"{_streamed(spark, sf_dir)}/quarantine")
    return rows.select("customer_id", F.array_join("errors", "; ").alias("errors"))


@query
def streamed_totals(spark, sf_dir):
    return streaming.running_totals(spark, _streamed(spark, sf_dir))


# ------------------------------------------------------------ models (no SQL)

_fitted: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, fit: Callable[[], object]):
    """One fit per session and folder; the queries below read different parts of it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _fitted:
        _fitted[key] = fit()
    return _fitted[key]


def two_models(spark: SparkSession, sf_dir: str) -> learners.Learner:
    return _once(spark, sf_dir, "two", lambda: learners.fit_two_models(modeling(spark, sf_dir), validate=True))


def propensity(spark: SparkSession, sf_dir: str) -> learners.PropensityFit:
    return _once(spark, sf_dir, "propensity", lambda: learners.fit_propensity(modeling(spark, sf_dir)))


@query
def fitted_propensity(spark, sf_dir):
    return learners.propensity_report(spark, propensity(spark, sf_dir))


@query
def fitted_propensity_scores(spark, sf_dir):
    return propensity(spark, sf_dir).score(modeling(spark, sf_dir)).select("customer_id", "propensity")


@query
def fitted_propensity_importances(spark, sf_dir):
    return learners.top_importances(spark, propensity(spark, sf_dir))


@query
def fitted_propensity_effect(spark, sf_dir):
    rows = propensity(spark, sf_dir).score(modeling(spark, sf_dir))
    return effects.ate_comparison(rows, "propensity")


@query
def fitted_two_models(spark, sf_dir):
    learner = two_models(spark, sf_dir)
    rows = uplift.segment(learner.score(modeling(spark, sf_dir)), learner.risk_threshold)
    return rows.select("customer_id", "mu_0_control", "mu_1_treatment", "uplift_score", "quadrant", "value_at_risk")


@query
def fitted_two_models_auc(spark, sf_dir):
    return learners.auc_report(spark, two_models(spark, sf_dir))


@query
def fitted_importance_comparison(spark, sf_dir):
    return learners.importance_comparison(spark, two_models(spark, sf_dir))


@query
def fitted_crossed(spark, sf_dir):
    rows = modeling(spark, sf_dir)
    learner = learners.fit_crossed(rows, base=two_models(spark, sf_dir))
    scored_rows = uplift.segment(
        learner.score(rows), learner.risk_threshold, uplift="uplift_score_xl", risk="mu_0_xl", suffix="_xl"
    )
    return scored_rows.select("customer_id", "mu_0_xl", "mu_1_xl", "uplift_score_xl", "quadrant_xl", "value_at_risk_xl")


@query
def saved_learner_metadata(spark, sf_dir):
    folder = _scratch(spark, "learner")
    two_models(spark, sf_dir).save(spark, folder)
    return learners.load_learner(spark, folder).metadata(spark).drop("training_date")


@query
def saved_learner_responses(spark, sf_dir):
    """Requests scored by a learner that was saved and loaded."""
    folder = _scratch(spark, "learner")
    two_models(spark, sf_dir).save(spark, folder)
    learner = learners.load_learner(spark, folder)
    return scoring.score_batch(requests(spark, sf_dir), learner.outcomes)[0]


@query
def fitted_scores_consistent(spark, sf_dir):
    """Of the fitted learner's stored rows: how many differ from uplift, quadrant and value worked out again from its two outcomes."""
    learner = two_models(spark, sf_dir)
    rows = store(uplift.segment(learner.score(modeling(spark, sf_dir)), learner.risk_threshold))
    u, risk = F.col("mu_0_control") - F.col("mu_1_treatment"), F.col("mu_0_control")
    again = (
        F.when((u > 0.01) & (risk > learner.risk_threshold), "Persuadable").when((u > 0.01) & (risk <= learner.risk_threshold), "Sure Thing")
        .when(u < -0.01, "Sleeping Dog").otherwise("Lost Cause")
    )
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("uplift_score") - u) > 1e-12).alias("n_uplift"),
        F.count_if(F.col("quadrant") != again).alias("n_quadrant"),
        F.count_if(F.abs(F.col("value_at_risk") - F.col("clv") * u) > 0.005 + 1e-9).alias("n_value"),
    )


@query
def saved_learner_consistent(spark, sf_dir):
    """Responses of a learner that was saved and loaded, against those of the learner itself: rows, and rows that differ."""
    asked = requests(spark, sf_dir)
    first = scoring.score_batch(asked, two_models(spark, sf_dir).outcomes)[0]
    second = saved_learner_responses(spark, sf_dir)
    differ = first.exceptAll(second).agg(F.count("*").alias("n")).scalar()
    return second.agg(F.count("*").alias("n_rows")).withColumn("n_differ", differ)


@query
def fitted_logistic_moments(spark, sf_dir):
    """The ridge-penalised logistic model, by its own condition: residuals times a feature sum to minus its coefficient, and to zero."""
    rows = modeling(spark, sf_dir)
    names = effects.PROPENSITY_FEATURES
    coded = learners.encoded(learners.fit_encoder(rows, names), rows, "customer_id", "treatment").withColumn("label", F.col("treatment").cast("double"))
    coded = store(coded)
    model = learners.logistic(coded.count()).fit(coded)
    terms = dict(zip(["intercept", *names], [0.0, *(float(c) for c in model.coefficients)]))
    x = F.array_insert(vector_to_array("features"), 1, F.lit(1.0))
    residual = vector_to_array("probability")[1] - F.col("label")
    each = model.transform(coded).select(residual.alias("r"), F.posexplode(x).alias("position", "x"))
    sums = each.groupBy("position").agg(F.sum(F.col("r") * F.col("x")).alias("moment"), F.sum(F.abs("x")).alias("size"), F.count("*").alias("n_rows"))
    told = spark.createDataFrame([(i, name, term) for i, (name, term) in enumerate(terms.items())], "position int, term string, coefficient double")
    met = F.abs(F.col("moment") + F.col("coefficient")) <= 0.002 * F.col("size") + 0.01
    return sums.join(F.broadcast(told), "position").select("term", "n_rows", met.alias("met"))


@query
def fitted_auc_by_rank_sum(spark, sf_dir):
    """The area under the curve of both arms' models and the propensity model, as Spark gives it and from the sum of ranks."""
    learner, rows = two_models(spark, sf_dir), modeling(spark, sf_dir)
    both = learner.outcomes(rows).select("customer_id", "treatment", "churn_binary", "mu_0_control", "mu_1_treatment")
    offered = propensity(spark, sf_dir).score(rows).select("customer_id", "propensity")
    both = store(_by_customer(both, offered))
    sides = {
        "control": (both.where("treatment = 0"), "mu_0_control", "churn_binary"), "treated": (both.where("treatment = 1"), "mu_1_treatment", "churn_binary"),
        "propensity": (both, "propensity", "treatment"),
    }
    found = []
    for name, (part, score, label) in sides.items():
        given = part.select("customer_id", F.col(score).alias("p"), F.col(label).cast("double").alias("label"))
        area = BinaryClassificationEvaluator(rawPredictionCol="p").evaluate(given)
        placed = scan(given, "p", "customer_id", descending=False, peers="least")
        tied = placed.groupBy("p").agg(F.min("least").alias("low"), F.count("*").alias("ties"), F.sum("label").alias("hits"))
        n, hits = F.sum("ties"), F.sum("hits")
        ranks = F.sum(F.col("hits") * (F.col("low") + (F.col("ties") - 1) / 2))
        by_ranks = (ranks - hits * (hits + 1) / 2) / (hits * (n - hits))
        found.append(tied.agg(F.lit(name).alias("model"), n.alias("n_rows"), hits.cast("long").alias("n_positive"), (F.abs(by_ranks - area) < 0.002).alias("agrees")))
    return reduce(DataFrame.unionByName, found)


@query
def fitted_propensity_moments(spark, sf_dir):
    """With a free intercept the logistic probabilities sum to the number treated, whatever the ridge term is."""
    fit = propensity(spark, sf_dir)
    rows = fit.score(modeling(spark, sf_dir))
    total, treated = F.sum("propensity"), F.sum("treatment")
    logistic = fit.chosen == "logistic"
    return rows.agg(
        F.count("*").alias("n_rows"), treated.alias("n_treated"),
        (F.lit(not logistic) | (F.abs(total - treated) <= 0.01 * treated + 1)).alias("sums_to_treated"),
        F.count_if(~F.col("propensity").between(0, 1)).alias("n_outside"),
    )
