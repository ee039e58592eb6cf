"""Readers, table layout, and data-quality checks that must fail."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from holdfast.operators import checks
from holdfast.operators.star import star
from holdfast.plans import intake
from holdfast.schemas import ENRICHED_COLUMNS, RAW_CUSTOMERS, TABLES
from holdfast.sources import files, tables as layout


def test_missing_input_names_its_maker(spark, tmp_path):
    with pytest.raises(files.MissingInput, match="run load_orders first"):
        files.read_required(spark, str(tmp_path / "absent"), "load_orders")
    with pytest.raises(files.MissingInput, match="none of these"):
        files.first_available(spark, [str(tmp_path / "a"), str(tmp_path / "b")], RAW_CUSTOMERS)


def test_csv_keeps_blanks_and_checks_the_header(spark, tmp_path):
    path = str(tmp_path / "export")
    row = {f.name: None for f in RAW_CUSTOMERS} | {"customerID": "C1", "TotalCharges": " "}
    files.write_csv(spark.createDataFrame([row], RAW_CUSTOMERS), path)
    assert files.read_csv(spark, path, RAW_CUSTOMERS).first().TotalCharges == " "
    wrong = RAW_CUSTOMERS.fieldNames()
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path, type(RAW_CUSTOMERS)(list(reversed(RAW_CUSTOMERS.fields)))).collect()
    assert wrong[0] == "customerID"


def test_report_is_one_file(spark, tmp_path):
    files.write_report(spark.range(100).repartition(5), str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("part-*.csv"))) == 1


def test_keep_columns_skips_absent_ones(spark):
    rows = spark.createDataFrame([(1, 2)], "b int, a int")
    assert files.keep_columns(rows, ["a", "x", "b"]).columns == ["a", "b"]


def test_tables_survive_a_parquet_round_trip(spark, small_tables, tmp_path):
    layout.write_tables(small_tables, str(tmp_path))
    back = layout.read_tables(spark, str(tmp_path))
    for name in TABLES:
        assert back[name].exceptAll(small_tables[name]).count() == 0


def test_views_serve_sql(spark, small_tables):
    layout.register_views(small_tables)
    assert spark.sql("SELECT COUNT(*) FROM customers JOIN billing USING (customer_id)").first()[0] == 150


def test_missing_columns(spark):
    raw = spark.createDataFrame([], RAW_CUSTOMERS)
    assert checks.missing_columns(raw, RAW_CUSTOMERS.fieldNames() + ENRICHED_COLUMNS) == sorted(ENRICHED_COLUMNS)


def test_checks_find_what_is_broken(spark, small_tables):
    broken = dict(small_tables)
    marketing = small_tables["marketing"]
    first = marketing.agg(F.min("customer_id")).first()[0]
    hit = F.col("customer_id") == first
    broken["marketing"] = marketing.withColumns(
        {
            "propensity_score": F.when(hit, 1.5).otherwise(F.col("propensity_score")),
            "marketing_offer_given": F.when(~hit, F.col("marketing_offer_given")),
        }
    ).unionByName(marketing.where(hit)).unionByName(marketing.where(hit).withColumn("customer_id", F.lit(-1).cast("long")))
    report = {(r.table, r.check): r.n_bad for r in checks.check_tables(broken).collect()}
    assert report["marketing", "customer_id unique"] == 1
    assert report["marketing", "customer_id known"] == 1
    assert report["marketing", "propensity_score in [0,1]"] == 1
    assert report["marketing", "marketing_offer_given not null"] == 1
    assert report["marketing", "marketing_offer_given in 0,1"] == 1
    assert sum(n for (table, _), n in report.items() if table != "marketing") == 0
    with pytest.raises(checks.CheckFailed, match="customer_id unique: 1 bad"):
        checks.require(checks.unique_key(broken["marketing"], "customer_id"))
    checks.require(checks.check_tables(small_tables))


def test_join_completeness_notices_a_lost_row(small_tables):
    lost = dict(small_tables)
    lost["billing"] = small_tables["billing"].orderBy("customer_id").limit(149)
    assert not checks.join_is_complete(lost).first().passed
    assert checks.is_non_empty(star(lost))
    assert not checks.is_non_empty(star(lost).limit(0))


def test_an_export_becomes_five_tables(spark, tmp_path):
    from registry.catalog import raw_customers

    path = str(tmp_path / "export")
    files.write_csv(raw_customers(spark, SMALL), path)
    raw = files.first_available(spark, [str(tmp_path / "absent"), path], RAW_CUSTOMERS)
    with pytest.raises(checks.CheckFailed, match="missing columns: Customer_Lifetime_Value"):
        intake.check_enriched(intake.clean(raw))
    enriched = intake.enrich(intake.clean(raw))
    checks.require(intake.check_enriched(enriched))
    made = intake.five_tables(enriched)
    checks.require(checks.check_tables(made))
    assert {name: t.columns for name, t in made.items()} == {name: s.fieldNames() for name, s in TABLES.items()}
    given = intake.enrich(intake.clean(raw), propensity=F.lit(0.123456), offer=F.lit(1)).first()
    assert (given.Propensity_Score, given.Marketing_Offer_Given) == (0.1235, 1)
