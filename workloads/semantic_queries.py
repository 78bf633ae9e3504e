"""Registered queries asked through the semantic model of the risk table."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgate.plans.rollup import answer, build_rollup
from landgate.plans.semantic import FACT, Item, SemanticModel, profile_columns, query
from landgate.plans.semantic import draft_model as draft
from workloads.risk_rows import risk_rows, risk_sql
from workloads.rounding import AVG_METRIC, stable

MODEL = (
    SemanticModel(
        "risk_model",
        "risk",
        "Scenario risk metrics of financial instruments, versioned by effective dates.",
        dimensions=tuple(
            Item(c, c)
            for c in (
                "identifier_type", "identifier", "asset_class", "region", "scenario_name",
                "scenario_year", "scenario_percentile", "metric_name",
            )
        )
        + (Item("start_year", "year(effective_start_date)", "year the version began"),),
        facts=(Item("metric_value", "metric_value", "score, higher is worse", FACT),),
    )
    .with_metric("avg_metric_value", "avg(metric_value)", "Average risk metric value")
    .with_metric("total_record_count", "count(*)", "Total number of risk records")
    .with_metric("instrument_count", "count(DISTINCT identifier)", "Instruments behind the figure")
)

CURRENT = "effective_end_date = DATE'9999-12-31'"


def semantic_rows(spark, sf):
    dims = ["IDENTIFIER_TYPE", "ASSET_CLASS", "SCENARIO_NAME"]
    return query(MODEL, risk_rows(spark, sf), dims, facts=["METRIC_VALUE"])


def semantic_metrics(spark, sf):
    answer = query(
        MODEL, risk_rows(spark, sf), ["identifier_type", "start_year"],
        metrics=["avg_metric_value", "total_record_count", "instrument_count"], where=CURRENT,
    )
    return stable(answer, "avg_metric_value")


def semantic_rollup(spark, sf):
    """Two dimensions of a roll-up of five, under a filter on a third."""
    rows = risk_rows(spark, sf)
    rollup = build_rollup(
        MODEL, rows, ["identifier_type", "asset_class", "region", "scenario_name", "start_year"],
        {
            "avg_metric_value": ("avg", "metric_value"), "total_record_count": ("count", "*"),
            "instrument_count": ("distinct", "identifier"),
        },
    )
    asked = answer(
        rollup, rows, ["identifier_type", "start_year"], ["avg_metric_value", "total_record_count", "instrument_count"],
        where="scenario_name <> 'RCP 4.5'",
    )
    return stable(asked, "avg_metric_value")


def semantic_totals(spark, sf):
    answer = query(
        MODEL, risk_rows(spark, sf), [], metrics=["avg_metric_value", "total_record_count"]
    )
    return stable(answer, "avg_metric_value")


def semantic_limit(spark, sf):
    """How many rows come back when seven are asked for."""
    few = query(MODEL, risk_rows(spark, sf), ["identifier"], facts=["metric_value"], limit=7)
    return few.agg(F.count(F.lit(1)).alias("shown"))


def draft_model(spark, sf):
    """The items of the model drafted of the risk table, each with all that its comment says of the column."""
    model = draft(risk_rows(spark, sf), "drafted", "risk", samples=3)
    rows = [(i.name, i.kind, i.comment) for i in model.items()]
    return spark.createDataFrame(rows, "name string, kind string, comment string")


PROFILED = ("name", "kind", "type", "rows", "nulls", "low", "high")


def semantic_dimensions(spark, sf):
    return profile_columns(risk_rows(spark, sf)).filter(F.col("kind") != FACT).select(*PROFILED)


def semantic_facts(spark, sf):
    return profile_columns(risk_rows(spark, sf)).filter(F.col("kind") == FACT).select(*PROFILED)


def _profile_sql(columns: dict[str, tuple[str, str]]) -> str:
    return risk_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS name, '{kind}' AS kind, '{type_}' AS type, count(*) AS rows,"
            f" count(*) FILTER ({c} IS NULL) AS nulls, CAST(min({c}) AS VARCHAR) AS low,"
            f" CAST(max({c}) AS VARCHAR) AS high FROM risk"
            for c, (kind, type_) in columns.items()
        )
    )


TEXTS = (
    "identifier", "identifier_type", "asset_class", "region", "scenario_name", "scenario_year",
    "scenario_percentile", "metric_name", "metric_name_internal", "is_proxied", "version",
)
DATES = ("effective_start_date", "as_of_date", "effective_end_date")

FACTS = {"metric_value": ("fact", "double"), "k": ("fact", "bigint")}
DIMENSIONS = {c: ("dimension", "string") for c in TEXTS} | {c: ("time_dimension", "date") for c in DATES}


def _listed(c: str, order: str) -> str:
    return f"""(SELECT coalesce(string_agg(v, ', ' ORDER BY place), '') FROM (SELECT v, row_number() OVER (ORDER BY {order}) AS place
        FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM risk WHERE {c} IS NOT NULL GROUP BY 1)) WHERE place <= 3)"""


def _drafted_sql() -> str:
    return risk_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS name, '{kind}' AS kind, concat('{type_}, ',
            printf('%.1f', 100.0 * count({c}) / count(*)), '% filled, ', count(DISTINCT {c}), ' values from ',
            CAST(min({c}) AS VARCHAR), ' to ', CAST(max({c}) AS VARCHAR),
            ', frequent: ', {_listed(c, "n DESC, v")}, ', samples: ', {_listed(c, "md5(v), v")}) AS comment FROM risk"""
            for c, (kind, type_) in (DIMENSIONS | FACTS).items()
        )
    )


QUERIES = {
    "semantic_rows": (
        semantic_rows,
        risk_sql("SELECT identifier_type, asset_class, scenario_name, metric_value FROM risk"),
    ),
    "semantic_limit": (
        semantic_limit,
        risk_sql("SELECT count(*) AS shown FROM (SELECT identifier, metric_value FROM risk LIMIT 7)"),
    ),
    "semantic_metrics": (
        semantic_metrics,
        risk_sql(f"""SELECT identifier_type, CAST(year(effective_start_date) AS INTEGER) AS start_year,
            {AVG_METRIC} AS avg_metric_value, count(*) AS total_record_count,
            count(DISTINCT identifier) AS instrument_count
            FROM risk WHERE {CURRENT.replace("DATE'", "DATE '")} GROUP BY 1, 2"""),
    ),
    "semantic_rollup": (
        semantic_rollup,
        risk_sql(f"""SELECT identifier_type, CAST(year(effective_start_date) AS INTEGER) AS start_year,
            {AVG_METRIC} AS avg_metric_value, count(*) AS total_record_count,
            count(DISTINCT identifier) AS instrument_count
            FROM risk WHERE scenario_name <> 'RCP 4.5' GROUP BY 1, 2"""),
    ),
    "semantic_totals": (
        semantic_totals,
        risk_sql(f"""SELECT {AVG_METRIC} AS avg_metric_value,
            count(*) AS total_record_count FROM risk"""),
    ),
    "semantic_dimensions": (
        semantic_dimensions,
        _profile_sql(DIMENSIONS),
    ),
    "semantic_facts": (
        semantic_facts,
        _profile_sql(FACTS),
    ),
    "draft_model": (draft_model, _drafted_sql()),
}
