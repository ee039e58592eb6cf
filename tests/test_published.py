"""Sets that change in one step: tables, learners, running totals; and checks in one pass."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from holdfast.operators import checks
from holdfast.plans import intake
from holdfast.schemas import TABLES
from holdfast.sources import files, published
from holdfast.sources import tables as layout
from holdfast.streaming import scoring as streaming


def failing(column: str):
    return F.when(F.col(column).isNull(), 0).otherwise(F.raise_error(F.lit("broken off")).cast("int"))


def folders(path: Path) -> set[str]:
    return {p.name for p in (path / "data").iterdir()}


def test_readers_live_through_refreshes_that_fail_and_that_do_not(spark, tmp_path):
    first, second = spark.range(10).toDF("id"), spark.range(20).toDF("id")
    layout.write_tables({"customers": first, "billing": first}, str(tmp_path))
    held = layout.read_table(spark, str(tmp_path), "billing")
    before = folders(tmp_path)
    with pytest.raises(Exception, match="broken off"):
        layout.write_tables({"customers": second, "billing": second.select(failing("id").alias("id"))}, str(tmp_path))
    assert [layout.read_table(spark, str(tmp_path), n).count() for n in ("customers", "billing")] == [10, 10]
    assert folders(tmp_path) == before and published.versions(spark, str(tmp_path)) == [1]

    seen = []

    def during(folder: str) -> None:
        seen.append(layout.read_table(spark, str(tmp_path), "customers").count())
        second.write.parquet(folder)

    published.publish(spark, str(tmp_path), {"customers": during, "billing": during})
    assert seen == [10, 10] and held.count() == 10
    assert [layout.read_table(spark, str(tmp_path), n).count() for n in ("customers", "billing")] == [20, 20]
    assert layout.read_table(spark, str(tmp_path), "customers", version=1).count() == 10


def test_appends_and_single_tables_keep_the_rest(spark, tmp_path):
    rows = spark.range(4).toDF("id")
    layout.write_tables({"customers": rows, "billing": rows}, str(tmp_path))
    layout.write_tables({"billing": rows}, str(tmp_path), mode="append")
    layout.write_tables({"customers": spark.range(1).toDF("id")}, str(tmp_path))
    assert [layout.read_table(spark, str(tmp_path), n).count() for n in ("customers", "billing")] == [1, 8]
    with pytest.raises(files.MissingInput, match="run write_tables first"):
        layout.read_tables(spark, str(tmp_path))
    with pytest.raises(files.MissingInput):
        layout.read_tables(spark, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError):
        layout.write_tables({"customers": rows}, str(tmp_path), mode="ignore")


def test_only_what_no_kept_set_names_is_cleaned_away(spark, tmp_path):
    rows = spark.range(4).toDF("id")
    layout.write_tables({"customers": rows}, str(tmp_path))
    for _ in range(3):
        layout.write_tables({"billing": rows}, str(tmp_path))
    assert published.clean(spark, str(tmp_path), keep=2) == 1
    assert published.versions(spark, str(tmp_path)) == [3, 4] and len(folders(tmp_path)) == 3
    assert layout.read_table(spark, str(tmp_path), "customers").count() == 4
    assert published.clean(spark, str(tmp_path), keep=2) == 0


def test_of_two_writers_the_slower_starts_from_the_others_set(spark, tmp_path, monkeypatch):
    rows, plain, late = spark.range(3).toDF("id"), published._commit, []

    def overtaken(spark_, folder, version, parts):
        if not late:
            late.append(version)
            assert plain(spark_, folder, version, {"billing": ["data/x/billing"]})
        return plain(spark_, folder, version, parts)

    monkeypatch.setattr(published, "_commit", overtaken)
    assert published.publish_rows(spark, str(tmp_path), {"customers": rows}) == 2
    assert set(published.current(spark, str(tmp_path))) == {"billing", "customers"}
    monkeypatch.setattr(published, "_commit", lambda *a: False)
    before = folders(tmp_path)
    with pytest.raises(published.Contended):
        published.publish_rows(spark, str(tmp_path), {"customers": rows})
    assert folders(tmp_path) == before


def test_running_totals_open_one_file_and_a_replay_changes_nothing(spark, tmp_path):
    def batch(number: int, customers: int) -> None:
        row = [(customers, customers * 0.1, 1, 0.25, 2)]
        spark.createDataFrame(row, streaming.TOTALS).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/totals/batch={number}")
        streaming.add_to_running(spark, str(tmp_path), number)

    assert tuple(streaming.running_totals(spark, str(tmp_path)).first()) == (0, 0.0, 0, 0.0, 0)
    for number in range(8):
        batch(number, number)
    total = (28, 2.8, 8, 2.0, 16)
    assert tuple(streaming.running_totals(spark, str(tmp_path)).first()) == total
    batch(7, 7)
    batch(7, 7)
    assert tuple(streaming.running_totals(spark, str(tmp_path)).first()) == total
    assert len(published.places(spark, f"{tmp_path}/running", "running", "x")) == 1
    assert len(folders(tmp_path / "running")) <= streaming.SNAPSHOTS
    batch(8, 100)
    assert streaming.running_totals(spark, str(tmp_path)).first().total_customers == 128
    batch(0, 5)  # a new query over the same output begins again
    assert streaming.running_totals(spark, str(tmp_path)).first().total_customers == 5


def test_rules_are_counted_by_the_one_scan_of_each_table(spark, small_tables):
    watched = {n: checks.watch_rows(t, n)[0] for n, t in small_tables.items()}
    plan = checks.key_counts(watched, small_tables["customers"])._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \S+?_(customers|services|billing|marketing|churn_labels)\[([^\]]*)\]", plan)
    for name in TABLES:
        read = [columns for table, columns in scans if table == name]
        assert sum(columns.count(",") > 0 for columns in read) == 1  # once with its columns
        assert len(read) == (5 if name == "customers" else 1)  # the customers' keys alone for each other table
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_broken_tables_are_not_published(spark, small_tables, tmp_path):
    report = intake.load_checked(small_tables, str(tmp_path))
    assert report.where(~F.col("passed")).count() == 0 and report.count() == checks.check_tables(small_tables).count()
    broken = dict(small_tables) | {"marketing": small_tables["marketing"].withColumn("propensity_score", F.lit(1.5))}
    with pytest.raises(checks.CheckFailed, match="propensity_score in"):
        intake.load_checked(broken, str(tmp_path))
    copied = dict(small_tables) | {"billing": small_tables["billing"].union(small_tables["billing"])}
    with pytest.raises(checks.CheckFailed, match="customer_id unique"):
        intake.load_checked(copied, str(tmp_path))
    assert published.versions(spark, str(tmp_path)) == [1]
    back = layout.read_tables(spark, str(tmp_path))
    assert back["marketing"].exceptAll(small_tables["marketing"]).count() == 0


def test_checks_of_empty_tables(spark, small_tables):
    empty = {name: table.limit(0) for name, table in small_tables.items()}
    assert checks.check_tables(empty).where(F.col("n_bad") != 0).count() == 0
    alone = dict(empty) | {"billing": small_tables["billing"]}
    rows = {(r.table, r.check): r.n_bad for r in checks.check_tables(alone).collect()}
    assert rows["billing", "customer_id known"] == small_tables["billing"].count() and sum(rows.values()) == rows["billing", "customer_id known"]


