"""Physical plans: what reaches the scan, what is shuffled, what runs in Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from holdfast.operators.ranking import global_rank
from holdfast.plans import campaign, effects, fairness, retention, uplift
from holdfast.sources.derived import flat_customers


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def count(df, operator: str) -> int:
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(rf"\b{operator}\b", tree))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_five_table_join_needs_no_shuffle(small_tables, no_broadcast):
    joined = retention.modeling_dataset(small_tables)
    assert count(joined, "SortMergeJoin") == 4 and count(joined, "Exchange") == 0


def test_segments_shuffle_only_partial_sums(small_tables, no_broadcast):
    text = plan(retention.segment_analysis(small_tables))
    tree = text.split("\n\n")[0]
    # One exchange of partial aggregates, one for the final order.
    assert len(re.findall(r"\bExchange\b", tree)) == 2 and len(re.findall(r"HashAggregate", tree)) == 2


def test_scans_read_only_what_is_used(small_tables):
    text = plan(retention.treatment_comparison(small_tables))
    read = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert len(read) == 4
    assert not any("payment_method" in r or "gender" in r for r in read)


def test_filters_reach_the_scan(small_tables):
    text = plan(retention.treatment_comparison_union(small_tables))
    assert "EqualTo(marketing_offer_given,1)" in text and "EqualTo(marketing_offer_given,0)" in text


def test_top_customers_are_taken_before_the_window(small_tables):
    tree = plan(retention.high_value_customers(small_tables)).split("\n\n")[0]
    assert tree.index("Window") < tree.index("TakeOrderedAndProject")


def test_derived_customers_share_one_shuffle_by_customer(spark, no_broadcast):
    # Partial sums of orders, and customers, by the same key; the join adds none.
    assert count(flat_customers(spark, SMALL), "Exchange") == 2


def test_no_plan_runs_python(small_modeling):
    segmented = uplift.segment(uplift.score_by_cells(small_modeling))
    for df in (
        segmented, uplift.executive_kpis(segmented), fairness.fairness_report(segmented),
        effects.ate_comparison(small_modeling), campaign.campaign_return(campaign.eligible_targets(segmented), 1000, 25),
    ):
        assert not re.search(r"EvalPython\b|InPandas\b|InArrow\b|MapPartitions\b", plan(df))


def test_no_plan_multiplies_rows(small_modeling):
    segmented = uplift.segment(uplift.score_by_cells(small_modeling))
    for df in (segmented, uplift.executive_kpis(segmented), fairness.group_totals(segmented), uplift.segment_deep_dive(segmented)):
        text = plan(df)
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def test_ranking_gathers_only_partition_sizes(small_modeling):
    ranked = global_rank(small_modeling.select("customer_id", "clv"), [F.desc("clv"), F.asc("customer_id")])
    tree = plan(ranked).split("\n\n")[0]
    below = tree[tree.index("Exchange", tree.index("Window")) :]
    # The one gathering exchange sits on counts per partition, not on customers.
    assert len(re.findall("Exchange", below)) == 2 and "HashAggregate" in below.splitlines()[1]
    assert plan(ranked).count("SinglePartition") == 1


def test_customer_rows_never_meet_in_one_partition(small_modeling):
    segmented = uplift.segment(uplift.score_by_cells(small_modeling)).select("customer_id", F.col("quadrant"))
    assert "SinglePartition" not in plan(segmented).split("Subqueries")[0]
