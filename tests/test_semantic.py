import pytest
from pyspark.sql import functions as F

from golden import golden
from landgate.functions.text import chunk_text, join_lines
from landgate.plans.semantic import (
    FACT, Item, SemanticModel, VerifiedQuery, draft_model, list_dimensions, list_facts,
    list_metrics, list_models, profile_columns, query,
)
from landgate.sources.text_lines import read_lines


@pytest.fixture(scope="module")
def risk(spark):
    return golden(spark).cache()


@pytest.fixture(scope="module")
def model(risk):
    drafted = draft_model(
        risk, "risk_model", "risk", "Risk by scenario.",
        [VerifiedQuery("How many rows?", "SELECT count(*) FROM risk")],
    )
    return drafted.with_metric(
        "avg_metric_value", "avg(metric_value)", "Average risk metric value"
    ).with_metric("total_record_count", "count(*)", "Total number of risk records")


def test_draft(spark, risk, model):
    assert len(model.dimensions) == 32 and [f.name for f in model.facts] == ["metric_value"]
    profile = {r.name: r for r in profile_columns(risk).collect()}
    assert profile["identifier_type"].approx_distinct == 4
    assert (profile["metric_value"].low, profile["metric_value"].high) == ("0.067", "0.891")
    assert profile["id_attributes"].nulls == 18 and profile["id_attributes"].low is None
    assert profile["as_of_date"].kind == "time_dimension"
    # Within the bound of the estimate.
    for column, seen in profile.items():
        if seen.approx_distinct is not None:
            exact = risk.select(F.count_distinct(f"`{column}`")).first()[0]
            assert abs(seen.approx_distinct - exact) <= max(1, 0.15 * exact)


def test_draft_of_an_empty_table(spark, risk):
    assert "0.0% filled" in draft_model(risk.limit(0), "m", "t").dimensions[0].comment


def test_metrics_by_type(risk, model):
    got = query(model, risk, ["identifier_type"], metrics=["avg_metric_value", "total_record_count"])
    assert {r[0]: (round(r[1], 6), r[2]) for r in got.collect()} == {
        "CUSIP": (0.237667, 3), "ISIN": (0.419778, 9), "SOVEREIGN": (0.735667, 3),
        "TICKER": (0.466333, 3),
    }


def test_rows_of_dimensions_and_facts(risk, model):
    dims = ["IDENTIFIER_TYPE", "ASSET_CLASS", "SCENARIO_NAME"]
    got = query(model, risk, dims, facts=["METRIC_VALUE"])
    assert got.columns == ["identifier_type", "asset_class", "scenario_name", "metric_value"]
    assert got.count() == 18
    assert query(model, risk, dims, facts=["METRIC_VALUE"], limit=10).count() == 10
    assert query(model, risk, dims, where="is_proxied = 'Y'").count() == 2
    assert query(model, risk, dims, where=F.col("is_proxied") == "Y").count() == 2


def test_totals(risk, model):
    assert query(model, risk, [], metrics=["total_record_count"]).first()[0] == 18


def test_facts_and_metrics_do_not_mix(risk, model):
    with pytest.raises(ValueError, match="not both"):
        query(model, risk, [], facts=["metric_value"], metrics=["total_record_count"])
    with pytest.raises(ValueError, match="has no"):
        query(model, risk, ["nothing"])


def test_validation(risk):
    SemanticModel("m", "t", dimensions=(Item("y", "year(as_of_date)"),)).validate(risk)
    with pytest.raises(ValueError, match="m.bad"):
        SemanticModel("m", "t", dimensions=(Item("bad", "no_such_column"),)).validate(risk)
    with pytest.raises(ValueError, match="m.bad"):
        SemanticModel("m", "t").with_metric("bad", "sum(no_such_column)").validate(risk)
    with pytest.raises(ValueError, match="more than once"):
        SemanticModel("m", "t", dimensions=(Item("a", "a"), Item("a", "b")))


def test_listings(spark, model):
    assert list_dimensions(spark, model).count() == 32
    assert [tuple(r)[:2] for r in list_facts(spark, model).collect()] == [("metric_value", FACT)]
    assert [r.expression for r in list_metrics(spark, model).collect()] == [
        "avg(metric_value)", "count(*)"
    ]
    assert list_models(spark, {"risk": model}).first().name == "risk_model"


def test_model_text_round_trip(spark, folder, model):
    """A model text cut to chunks, landed as a file, read as lines and joined is the same model."""
    text = model.to_json()
    df = spark.createDataFrame([(1, text)], "id int, text string")
    chunks = chunk_text(df, "text", 100)
    assert chunks.agg(F.max(F.length("chunk"))).first()[0] == 100
    rebuilt = "".join(r.chunk for r in chunks.orderBy("chunk_no").collect())
    assert SemanticModel.from_json(rebuilt) == model
    with open(f"{folder}/model.json", "w") as f:
        f.write(text)
    joined = join_lines(read_lines(spark, folder)).first().text
    assert SemanticModel.from_json(joined) == model


def test_chunks_of_odd_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x" * 8), (4, "é" * 9)], "id int, t string")
    got = [(r.id, r.chunk_no, r.chunk) for r in chunk_text(df, "t", 4).orderBy("id", "chunk_no").collect()]
    assert got == [
        (1, 1, ""), (2, 1, None), (3, 1, "xxxx"), (3, 2, "xxxx"), (4, 1, "éééé"), (4, 2, "éééé"), (4, 3, "é"),
    ]
    with pytest.raises(ValueError):
        chunk_text(df, "t", 0)


def test_join_with_other_separators(spark):
    df = spark.createDataFrame([("f", 2, "b"), ("f", 1, "it's"), ("f", 3, "")], "file string, line_no int, value string")
    assert join_lines(df, separator="','").first().text == "it's','b','"
    assert join_lines(df, separator="\\").first().text == "it's\\b\\"
