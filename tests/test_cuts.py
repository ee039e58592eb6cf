"""Cuts, thresholds and scans over all rows against plain sorting."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.operators import cuts
from holdfast.operators.cuts import first_rows, refine, scan
from holdfast.plans import evaluation

NUMBERS = {
    "spread": lambda rng: rng.uniform(-1, 1),
    "hot": lambda rng: 0.25 if rng.random() < 0.4 else round(rng.uniform(-1, 1), 1),
    "constant": lambda rng: 3.5,
    "huge": lambda rng: rng.choice([1.7e308, -1.7e308, 5e-324, -5e-324, 0.0, -0.0, 1e-310, rng.uniform(-1e300, 1e300)]),
    "near": lambda rng: 1.0 + rng.randrange(40) * 2.0**-52,
    "odd": lambda rng: rng.choice([None, float("nan"), float("inf"), float("-inf"), 0.0, rng.gauss(0, 1)]),
}
KEYS = {
    "long": lambda i: i * 7919 - 5000,
    "wide": lambda i: (i * 0x9E3779B97F4A7C15 + 17) % (1 << 64) - (1 << 63),
    "text": lambda i: f"customer-with-a-long-name-{i:05d}",
    "mixed": lambda i: "é" * (i % 23) + str(i) + "z" * (i % 5),
}


def place(value: float | None, descending: bool) -> tuple:
    """Nulls last; NaN above everything, as Spark orders it."""
    if value is None:
        return (1, 0, 0.0)
    nan = math.isnan(value)
    return (0, -nan if descending else nan, 0.0 if nan else (-value if descending else value) + 0.0)


def made(spark, number: str, key: str, n: int = 900, seed: int = 1):
    rng = random.Random(seed)
    rows = [(KEYS[key](i), NUMBERS[number](rng), rng.randrange(2), rng.randrange(1000)) for i in range(n)]
    rng.shuffle(rows)
    kind = "long" if key in ("long", "wide") else "string"
    return rows, spark.createDataFrame(rows, f"k {kind}, v double, t int, c int")


def in_order(rows: list[tuple], descending: bool) -> list[tuple]:
    return sorted(rows, key=lambda r: (place(r[1], descending), r[0].encode() if isinstance(r[0], str) else r[0]))


@pytest.mark.parametrize(
    "number,key,descending",
    [("spread", "long", True), ("hot", "long", False), ("huge", "wide", True), ("near", "text", False), ("odd", "long", False), ("constant", "mixed", True), ("constant", "wide", False), ("odd", "mixed", True)],
)
def test_cuts_have_the_sums_of_sorted_rows(spark, monkeypatch, number, key, descending):
    monkeypatch.setattr(cuts, "BINS", 1 << 11)
    rows, df = made(spark, number, key)
    ranks = [1, 2, 77, 400, 401, 899, 900, 5000, 0]
    found = refine(df, "v", "k", lambda n: ranks, {"t": F.col("t"), "c": F.col("c").cast("decimal(20,2)")}, descending, places=lambda n, m: [1, 450, m])
    ordered = in_order(rows, descending)
    assert [c.rank for c in found.cuts[None]] == [1, 2, 77, 400, 401, 899, 900] and found.totals[None] == 900
    for cut in found.cuts[None]:
        top = ordered[: cut.rank]
        assert cut.sums == {"t": sum(r[2] for r in top), "c": Decimal(sum(r[3] for r in top))}
        assert cut.last[2] == top[-1][0]
    scored = sum(r[1] is not None for r in rows)
    for rank, value in found.values[None].items():
        assert place(value, descending) == place(ordered[rank - 1][1], descending)
    assert set(found.values[None]) == {1, 450, scored}


def test_no_row_is_exchanged_for_the_curves(spark, monkeypatch):
    _, df = made(spark, "hot", "long")
    seen = []
    plain = cuts._bins

    def watched(rows, text, bits, n_sums):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return plain(rows, text, bits, n_sums)

    monkeypatch.setattr(cuts, "_bins", watched)
    evaluation.cut_scores(df.selectExpr("k AS customer_id", "v AS s", "t AS treatment", "c % 2 AS churn_binary"), {"a": "s"})
    assert len(seen) > 1 and not any("Exchange hash" in plan or "Exchange range" in plan for plan in seen)


def test_groups_are_cut_for_themselves_and_may_be_empty(spark):
    rows, df = made(spark, "hot", "long")
    group = F.when(F.col("t") == 1, 0).otherwise(2)
    found = refine(df, "v", "k", lambda n: [n // 2], {"c": F.col("c")}, group=group, labels=["one", "none", "zero"])
    assert found.cuts["none"] == [] and found.totals == {"one": sum(r[2] for r in rows), "none": 0, "zero": sum(1 - r[2] for r in rows)}
    for label, t in (("one", 1), ("zero", 0)):
        own = in_order([r for r in rows if r[2] == t], True)
        assert found.cuts[label][0].sums["c"] == sum(r[3] for r in own[: len(own) // 2])


def test_rows_without_an_order_are_refused(spark):
    twins = spark.createDataFrame([(1, 2.0), (1, 2.0), (3, 1.0)], "k long, v double")
    assert [c.rank for c in refine(twins, "v", "k", lambda n: [2]).cuts[None]] == [2]
    for df in (twins, twins.withColumn("k", F.lit("same text for all of them")), twins.withColumn("k", F.lit(None).cast("string"))):
        with pytest.raises(ValueError):
            refine(df, "v", "k", lambda n: [1])
    for wrong in (twins.withColumn("v", F.lit(1).cast("decimal(30,2)")), twins.withColumn("k", F.lit(1.5))):
        with pytest.raises(TypeError):
            refine(wrong, "v", "k", lambda n: [1])


@pytest.mark.parametrize("number,key,ks", [("hot", "long", (0, 333, 10_000)), ("odd", "text", (1, 899)), ("constant", "mixed", (333, 900)), ("huge", "wide", (500,))])
def test_first_rows_are_those_of_a_sort(spark, number, key, ks):
    rows, df = made(spark, number, key)
    for k in ks:
        chosen = first_rows(df, k, "v", "k")
        assert sorted(r["k"] for r in chosen.collect()) == sorted(r[0] for r in in_order(rows, True)[:k])
        assert chosen.columns == df.columns


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(None, 1.0), (5, 1.0), (6, 1.0), (7, 2.0)], "k long, v double")
    assert [{r["k"] for r in first_rows(df, k, "v", "k").collect()} for k in (1, 2, 3)] == [{7}, {7, None}, {7, None, 5}]


@pytest.mark.parametrize(
    "number,key,blocks",
    [("spread", "long", []), ("hot", "long", [1, 2, 3, 100, 101, 500, 640, 899]), ("odd", "text", [450, 880]), ("constant", "mixed", [1, 2, 3, 500]), ("huge", "wide", [450])],
)
def test_scan_equals_windows_over_all_rows(spark, number, key, blocks):
    _, df = made(spark, number, key)
    amount = F.col("c").cast("decimal(12,2)")
    got = scan(df, "v", "k", {"upto": amount, "n": F.col("t")}, {"prev_c": "c", "prev_v": "v"}, peers="least", wanted=lambda n: blocks)
    tied = F.when(~F.isnan("v"), F.col("v") + F.lit(0.0)).otherwise(F.col("v"))
    w = W.orderBy(tied.desc_nulls_last(), "k")
    plain = df.select(
        "*", F.row_number().over(w).cast("long").alias("rank"), F.sum(amount).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("upto"),
        F.sum("t").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("n"), F.lag("c").over(w).alias("prev_c"), F.lag("v").over(w).alias("prev_v"),
        F.count("*").over(W.partitionBy()).alias("n_rows"), F.rank().over(W.orderBy(tied.desc_nulls_last())).cast("long").alias("least"),
    )
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_scan_of_no_rows_and_of_doubles(spark):
    _, df = made(spark, "hot", "long")
    assert scan(df.limit(0), "v", "k", {"s": F.col("t")}, {"p": "c"}, peers="least").count() == 0
    with pytest.raises(TypeError):
        scan(df, "v", "k", {"s": F.col("v")})
