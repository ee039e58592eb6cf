"""Request validation, responses, and the stream giving what the batch gives."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from holdfast.plans import scoring
from holdfast.schemas import REQUEST
from holdfast.sources import rescued
from holdfast.streaming import scoring as streaming

GOOD = {
    "customer_id": "K-7", "gender": "Male", "senior_citizen": 1, "partner": "No", "dependents": "Yes", "tenure_months": 31,
    "contract_type": "One year", "internet_service": "DSL", "online_security": "Yes", "online_backup": "Yes",
    "device_protection": "No", "tech_support": "Yes", "streaming_tv": "No", "streaming_movies": "Yes", "phone_service": "Yes",
    "multiple_lines": "Yes", "monthly_charges": 61.4, "total_charges": 1903.4, "payment_method": "Mailed check",
    "paperless_billing": "No",
}


def requests(spark, *changes):
    return spark.createDataFrame([{**GOOD, **change} for change in changes], REQUEST)


def fixed_risks(risk, offered):
    return lambda rows: rows.withColumns({"mu_0_control": F.lit(risk), "mu_1_treatment": F.lit(offered)})


@pytest.mark.parametrize(
    "change,expected",
    [
        ({}, []),
        ({"gender": "anything"}, []),
        ({"customer_id": None}, []),
        ({"multiple_lines": None}, []),
        ({"gender": None}, ["gender is required"]),
        ({"senior_citizen": 2}, ["senior_citizen is out of range"]),
        ({"tenure_months": 73}, ["tenure_months is out of range"]),
        ({"monthly_charges": 200.01}, ["monthly_charges is out of range"]),
        ({"total_charges": -0.01}, ["total_charges is out of range"]),
        ({"contract_type": "Weekly"}, ["contract_type is not an allowed value"]),
        ({"phone_service": "No phone service"}, ["phone_service is not an allowed value"]),
        ({"partner": "yes", "tech_support": None}, ["partner is not an allowed value", "tech_support is required"]),
    ],
)
def test_request_rules(spark, change, expected):
    assert scoring.with_errors(requests(spark, change)).first().errors == expected


def test_limits_are_allowed(spark):
    rows = requests(spark, {"tenure_months": 0, "monthly_charges": 0.0, "total_charges": 0.0}, {"tenure_months": 72, "monthly_charges": 200.0})
    valid, broken = scoring.split_requests(rows)
    assert (valid.count(), broken.count()) == (2, 0)


def test_response_rounds_only_at_the_end(spark):
    row = scoring.score_requests(requests(spark, {}), fixed_risks(0.270004, 0.260003)).first()
    # 0.010001 counts as uplift though it shows as 0.01, and 0.270004 as risk though it shows as 0.27.
    assert (row.churn_risk, row.uplift_score, row.quadrant, row.confidence) == (0.27, 0.01, "Persuadable", "low")
    clv = 61.4 * (3 * 3.4657359027997265 + 14)
    assert row.customer_lifetime_value == round(clv, 2) and row.value_at_risk == round(clv * 0.010001, 2)


def test_supplied_value_and_propensity_are_kept(spark):
    rows = requests(spark, {}).withColumns({"clv": F.lit(1000.0), "propensity_score": F.lit(0.4)})
    assert scoring.with_features(rows).select("clv", "propensity_score").first() == (1000.0, 0.4)
    assert scoring.with_features(requests(spark, {})).first().propensity_score == pytest.approx(0.05)


def test_bad_rows_do_not_stop_a_batch(spark):
    scored, totals, broken = scoring.score_batch(requests(spark, {}, {"tenure_months": 99}, {"customer_id": "C3"}), fixed_risks(0.5, 0.3))
    assert (scored.count(), broken.count(), totals.first().total_customers) == (2, 1, 2)
    assert scoring.check_responses(scored).where(~F.col("passed")).count() == 0
    empty = scoring.batch_totals(scored.limit(0)).first()
    assert (empty.total_customers, empty.total_revenue_at_risk) == (0, 0.0)


def test_broken_promises_are_found(spark):
    scored = scoring.score_requests(requests(spark, {}), fixed_risks(1.2, 0.3))
    assert [r.check for r in scoring.check_responses(scored).where(~F.col("passed")).collect()] == ["churn_risk in [0,1]"]


def test_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    from registry.catalog import cell_outcomes, requests as all_requests

    outcomes, rows = cell_outcomes(spark, SMALL), all_requests(spark, SMALL)
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    scored, totals, broken = scoring.score_batch(rows, outcomes)

    def run():
        stream = streaming.read_requests(spark, source, files_per_batch=1)
        streaming.start_scoring(stream, outcomes, out, state, available_now=True).awaitTermination()

    half = F.col("gender") == "Male"
    rows.where(half).coalesce(1).write.mode("append").json(source)
    run()
    rows.where(~half | F.col("gender").isNull()).repartition(2).write.mode("append").json(source)
    run()
    run()
    got = spark.read.parquet(f"{out}/scored").drop("batch")
    assert got.count() == scored.count() and got.exceptAll(scored).count() == 0
    assert spark.read.parquet(f"{out}/quarantine").count() == broken.count()
    assert streaming.running_totals(spark, out).first() == totals.first()


def test_scored_stream_feeds_any_sink(spark, tmp_path):
    requests(spark, {}, {"tenure_months": 99}).coalesce(1).write.json(str(tmp_path / "in"))
    stream = streaming.scored_stream(streaming.read_requests(spark, str(tmp_path / "in")), fixed_risks(0.5, 0.3))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.customer_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["K-7"]


def test_lines_keep_what_does_not_fit(spark, tmp_path):
    good = {f.name: {"string": "Yes", "int": 1, "double": 20.5}[f.dataType.simpleString()] for f in REQUEST} | {
        "contract_type": "One year", "internet_service": "DSL", "payment_method": "Mailed check"
    }
    lines = [
        good, good | {"tenure_months": "12", "monthly_charges": " 9.5 "}, good | {"tenure_months": "soon", "monthly_charges": True},
        good | {"tenure_months": None, "senior_citizen": ""}, good | {"total_charges": {"a": 1}},
    ]
    texts = [json.dumps(x) for x in lines] + ['{"customer_id": "C9", "gen', "", "7", "[]", "{}"]
    found = scoring.with_errors(rescued.parse_json(spark.createDataFrame([(t,) for t in texts], "value string"), REQUEST)).collect()
    errors = {r.raw: r.errors for r in found}
    unreadable, names = ["the record cannot be read"], REQUEST.fieldNames()
    assert [errors[t] for t in texts] == [
        [], [], ["tenure_months has the wrong type", "monthly_charges has the wrong type"],
        ["senior_citizen is required", "tenure_months is required"], ["total_charges has the wrong type"], *[unreadable] * 4,
        [f"{name} is required" for name in names if name not in ("customer_id", "multiple_lines")],
    ]
    assert {r.raw: r.rescued for r in found}[texts[2]] == {"tenure_months": "soon", "monthly_charges": "true"}
    assert {r.raw: r.rescued for r in found}[texts[5]] == {"_record": texts[5]}
    assert (found[1].tenure_months, found[1].monthly_charges) == (12, 9.5)


def test_csv_streams_keep_what_does_not_fit(spark, tmp_path):
    names = REQUEST.fieldNames()
    cells = [str({"string": "Yes", "int": 1, "double": 20.5}[f.dataType.simpleString()]) for f in REQUEST]
    odd = [*cells]
    odd[names.index("tenure_months")] = "a year"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([",".join(names), ",".join(cells), ",".join(odd), "only,two"]) + "\n")
    stream = streaming.read_requests(spark, str(tmp_path / "in"), "csv")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    streaming.start_scoring(stream, fixed_risks(0.5, 0.3), out, state, available_now=True).awaitTermination()
    kept = {tuple(r.errors): r.raw for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert kept[("the record cannot be read",)] == "only,two"
    assert any("tenure_months has the wrong type" in errors and "a year" in raw for errors, raw in kept.items())


def test_a_line_is_parsed_once(spark):
    from holdfast.schemas import REQUEST
    from holdfast.sources import rescued

    lines = spark.createDataFrame([('{"customer_id": 1, "tenure_months": "soon"}',), ('{"customer',), (None,)], "value string")
    _, broken = scoring.split_requests(rescued.parse_json(lines, REQUEST))
    plan = broken._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("map_from_entries") == 1
    found = {tuple(sorted(r["rescued"].items())) for r in broken.collect()}
    assert found == {(("tenure_months", "soon"),), (("_record", '{"customer'),), (("_record", ""),)}
