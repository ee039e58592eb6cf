"""Ranks, quantiles, prefix sums and joins against plain definitions."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.operators import quantiles
from holdfast.operators.attach import attach
from holdfast.operators.prefix import prefix_sums
from holdfast.operators.quantiles import SKETCH_ERROR, median, merged_sketches, percentiles, quantile_sketches, sketched_percentiles
from holdfast.operators.ranking import global_rank, range_partitions, tile, top_rows
from holdfast.session import owned_scratch


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; one score holds a third of them and one group most of them."""
    n = 20_000
    rows = spark.range(n, numPartitions=7).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(997)) / 997.0).alias("score"),
        F.when(F.col("id") % 10 < 8, "a").when(F.col("id") % 10 == 8, "b").alias("g"),
        F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("t"),
        F.when(F.col("id") % 7 < 3, 1).otherwise(0).alias("y"),
    )
    return rows


@pytest.mark.parametrize("partitions", [None, 1, 5, 16])
def test_global_rank_equals_plain_window(skewed, partitions):
    order = [F.desc("score"), F.asc("id")]
    got = global_rank(skewed, order, partitions=partitions)
    plain = skewed.withColumn("expected", F.row_number().over(W.orderBy(*order)))
    joined = got.join(plain.select("id", "expected"), "id")
    assert joined.where(F.col("rank") != F.col("expected")).count() == 0
    assert got.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank"), F.min("n_rows")).first() == (1, 20_000, 20_000, 20_000)


def test_global_rank_spreads_a_hot_score(skewed):
    ranked = global_rank(skewed, [F.desc("score"), F.asc("id")], partitions=8)
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_global_rank_by_group_with_null_group_and_null_score(skewed):
    holed = skewed.withColumn("score", F.when(F.col("id") % 11 != 0, F.col("score")))
    order = [F.col("score").desc_nulls_last(), F.asc("id")]
    got = global_rank(holed, order, by=["g"])
    plain = holed.select(
        "id", F.row_number().over(W.partitionBy("g").orderBy(*order)).alias("e"), F.count("*").over(W.partitionBy("g")).alias("n")
    )
    joined = got.join(plain, "id")
    assert joined.count() == 20_000
    assert joined.where((F.col("rank") != F.col("e")) | (F.col("n_rows") != F.col("n"))).count() == 0


def test_global_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert global_rank(empty, [F.asc("v"), F.asc("id")]).count() == 0


@pytest.mark.parametrize("n,k", [(13, 10), (10, 10), (4, 10), (103, 7)])
def test_tile_equals_ntile(spark, n, k):
    rows = spark.range(1, n + 1).select(F.col("id").alias("rank"), F.lit(n).cast("long").alias("n"))
    both = rows.select(tile(F.col("rank"), F.col("n"), k).alias("a"), F.ntile(k).over(W.orderBy("rank")).alias("b"))
    assert both.where("a <> b").count() == 0


def test_percentiles_equal_numpy(skewed):
    shares = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p70": 0.7, "p100": 1.0}
    got = percentiles(skewed, "score", shares, "id").first()
    values = np.array([r.score for r in skewed.select("score").collect()])
    for name, share in shares.items():
        assert got[name] == pytest.approx(np.percentile(values, 100 * share), abs=1e-12)


@pytest.mark.parametrize("share", [0.0, 0.003, 0.25, 0.5, 0.61803, 0.9997, 1.0])
def test_percentiles_of_many_distinct_values(spark, share):
    """Enough rows that the sketch only brackets the target."""
    rows = spark.range(50_021, numPartitions=5).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0).alias("v"), F.when(F.col("id") % 50 == 0, "few").otherwise("many").alias("g")
    )
    values = rows.toPandas()
    got = {r.g: r.p for r in percentiles(rows, "v", {"p": share}, "id", by=["g"]).collect()}
    for group, part in values.groupby("g"):
        assert got[group] == pytest.approx(np.percentile(part.v, 100 * share), rel=1e-13)
    assert percentiles(rows, "v", {"p": share}, "id").first().p == pytest.approx(np.percentile(values.v, 100 * share), rel=1e-13)


def test_percentiles_beside_a_hot_value(spark):
    """A third of the rows share the value next to the target."""
    rows = spark.range(30_000).select("id", F.when(F.col("id") < 10_000, 5.0).otherwise(F.col("id") / 1000.0 - 9).alias("v"))
    values = rows.toPandas().v
    shares = {f"p{i}": i / 40 for i in range(41)}
    got = percentiles(rows, "v", shares, "id").first()
    for name, share in shares.items():
        assert got[name] == pytest.approx(np.percentile(values, 100 * share), rel=1e-13)


def test_a_missed_bracket_falls_back_to_ranking(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    monkeypatch.setattr(quantiles, "MARGIN", 0.0)
    rows = spark.range(5_000).select("id", F.pmod(F.xxhash64("id"), F.lit(100_003)).cast("double").alias("v"))
    values = rows.toPandas().v
    got = percentiles(rows, "v", {"a": 0.37, "b": 0.5}, "id").first()
    assert (got.a, got.b) == (pytest.approx(np.percentile(values, 37)), pytest.approx(np.percentile(values, 50)))


def test_median_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, g string, v double")
    assert percentiles(empty, "v", {"m": 0.5}, "id", by=["g"]).count() == 0
    assert median(empty.withColumn("v", F.lit(None).cast("double")), "v", "id").select(F.max("median")).first()[0] is None


def test_median_by_group_ignores_nulls(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 2.0), (3, "a", 10.0), (4, "a", None), (5, "b", 4.0), (6, "b", 6.0), (7, "c", None)],
        "id long, g string, v double",
    )
    assert {r.g: r.median for r in median(rows, "v", "id", by=["g"]).collect()} == {"a": 2.0, "b": 5.0}


@pytest.mark.parametrize("start", [1, 100])
def test_prefix_sums_equal_plain_window(skewed, start):
    order = [F.desc("score"), F.asc("id")]
    ranked = global_rank(skewed, order)
    got = prefix_sums(ranked, start, {"t": F.col("t"), "ty": F.col("t") * F.col("y")})
    w = W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    plain = skewed.select(
        F.row_number().over(W.orderBy(*order)).alias("k"), F.sum("t").over(w).alias("t"), F.sum(F.col("t") * F.col("y")).over(w).alias("ty")
    ).where((F.col("k") >= start) & ((F.col("k") - start) % 200 == 0))
    assert {tuple(r) for r in got.select("k", "t", "ty").collect()} == {tuple(r) for r in plain.collect()}


def test_attach_keeps_null_keys_and_leaves_the_strategy_to_spark(spark, skewed):
    small = skewed.groupBy("g").agg(F.count("*").alias("n"))
    joined = attach(skewed, small, "g")
    assert joined.count() == 20_000 and joined.columns == [*skewed.columns, "n"]
    holed = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id long, k string")
    sides = spark.createDataFrame([(None, 7), ("a", 8)], "k string, v int")
    assert {tuple(r) for r in attach(holed, sides, "k").select("id", "v").collect()} == {(1, 7), (2, 8)}
    assert {tuple(r) for r in attach(holed, sides, "k", how="left").select("id", "v").collect()} == {(1, 7), (2, 8), (3, None)}


@pytest.mark.parametrize("k", [1, 900, 5_000, 30_000])
def test_top_rows_are_in_order_for_every_k_and_plan(skewed, k):
    order = [F.desc("score"), F.asc("id")]
    expected = [r.id for r in skewed.orderBy(*order).collect()][:k]
    for spread in (False, True):
        top = top_rows(skewed, k, order, spread)
        assert [r.id for r in top.collect()] == expected and top.columns == skewed.columns


def test_range_partitions_grow_with_the_rows(spark):
    assert range_partitions(spark.range(10)) == 8
    assert range_partitions(spark.range(1_000), rows_per_task=10) == 100


def test_owned_scratch_is_removed(spark):
    with owned_scratch(spark) as mine:
        ranked = global_rank(spark.range(100), [F.asc("id")])
        assert ranked.count() == 100 and mine
        assert all(Path(path.removeprefix("file:")).exists() for path in mine)
    assert not any(Path(path.removeprefix("file:")).exists() for path in mine)


def test_merged_sketches_are_within_their_promise(spark):
    rows = spark.range(50_000).select((F.col("id") % 5).alias("g"), (F.col("id") % 7).alias("part"), F.when(F.col("id") % 11 != 0, F.hash("id").cast("double")).alias("v"))
    merged = merged_sketches(quantile_sketches(rows, "v", ["g", "part"]), ["g"])
    shares = {"low": 0.0, "p30": 0.3, "top": 1.0}
    for got in sketched_percentiles(merged, shares).collect():
        values = sorted(r[0] for r in rows.where(f"g = {got.g} AND v IS NOT NULL").select("v").collect())
        for name, share in shares.items():
            place = values.index(got[name])
            assert abs(place - share * (len(values) - 1)) <= SKETCH_ERROR * len(values)
    none = sketched_percentiles(quantile_sketches(rows.where("v IS NULL"), "v", ["g"]), shares)
    assert {r.p30 for r in none.collect()} == {None}


def test_small_customer_tables_are_not_broadcast(small_tables):
    from holdfast.operators.star import star

    plan = star(small_tables)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_rows_of_few_groups_stay_spread(spark, monkeypatch):
    from holdfast.session import settle

    rows = spark.range(400).selectExpr("nullif(id % 4, 3) AS g", "CAST(id AS double) AS v", "id AS k")
    facts = settle(rows.groupBy("g").count())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plan = quantiles._attached(rows, facts, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    found = [sorted(quantiles.percentiles(rows, "v", {"p": 0.3}, "k", by=["g"]).collect(), key=str)]
    monkeypatch.setattr(quantiles, "FEW_GROUPS", 3)
    plan = quantiles._attached(rows, facts, ["g"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    found.append(sorted(quantiles.percentiles(rows, "v", {"p": 0.3}, "k", by=["g"]).collect(), key=str))
    assert found[0] == found[1] and len(found[0]) == 4


def test_scores_of_all_customers_are_not_broadcast(spark):
    from registry.catalog import _by_customer

    rows = spark.range(10).withColumnRenamed("id", "customer_id")
    plan = _by_customer(rows, rows.withColumn("score", F.lit(1.0)))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
