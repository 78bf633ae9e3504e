"""Registered queries over the derived risk table, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgate.operators import risk as R
from landgate.operators.instants import as_of_pairs as pairs_in_force
from landgate.operators.quality import check_rules, within
from workloads.rounding import AVG_METRIC, stable
from workloads.risk_rows import METRIC, risk_rows, risk_sql

CURRENT = "effective_end_date = DATE '9999-12-31'"
ALL = (
    "identifier, identifier_type, asset_class, region, scenario_name, scenario_year, "
    "scenario_percentile, metric_name, effective_start_date, metric_value, k, "
    "metric_name_internal, as_of_date, is_proxied, version, effective_end_date"
)


def count_by_type(spark, sf):
    return R.count_by(risk_rows(spark, sf), "identifier_type")


def avg_by_class_scenario(spark, sf):
    return stable(
        R.avg_by(risk_rows(spark, sf), ["asset_class", "scenario_name"], METRIC), "avg_risk"
    )


def exposure_by_region(spark, sf):
    return stable(R.exposure_by(risk_rows(spark, sf), "region", METRIC), "avg_risk")


def metric_breakdown(spark, sf):
    return stable(R.metric_breakdown(risk_rows(spark, sf)), "avg_risk")


def proxied_split(spark, sf):
    return stable(R.proxied_split(risk_rows(spark, sf)), "avg_risk")


def lookup_batch(spark, sf):
    return R.lookup(risk_rows(spark, sf), "ISIN", ["ID0", "ID4", "ID16", "NONE"])


def lookup_by_table(spark, sf):
    ids = spark.read.parquet(f"{sf}/customer.parquet").filter("c_acctbal < 0")
    ids = ids.select(F.expr("concat('ID', CAST(c_nationkey AS STRING))").alias("id"))
    return R.lookup(risk_rows(spark, sf), "CUSIP", ids)


def current_rows(spark, sf):
    return R.current(risk_rows(spark, sf))


def history(spark, sf):
    return R.history(risk_rows(spark, sf), "ID4")


def as_of(spark, sf):
    return R.as_of(risk_rows(spark, sf), "1997-06-30")


def as_of_pairs(spark, sf):
    """For every order, what was in force for its customer on its day, and for the hot instrument as well."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    asked = orders.select(
        F.expr("concat('ID', CAST(CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE o_custkey END AS STRING))").alias("identifier"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").alias("order"),
    )
    return pairs_in_force(risk_rows(spark, sf), asked).select("asked_order", "asked_date", "identifier", "k", "metric_value")


def proxied(spark, sf):
    return R.proxied_report(risk_rows(spark, sf))


def proxied_flag(spark, sf):
    rows = R.flag_proxied(risk_rows(spark, sf))
    return rows.groupBy("proxied_flag", "asset_class").agg(F.count(F.lit(1)).alias("record_count"))


def instrument_profile(spark, sf):
    return R.instrument_profile(risk_rows(spark, sf), "ISIN", "ID8")


def instrument_question(spark, sf):
    return R.instrument_question(risk_rows(spark, sf), "ISIN", "ID0", "RCP 8.5", "2050")


def latest(spark, sf):
    return R.latest(risk_rows(spark, sf))


def latest_by_class(spark, sf):
    return R.latest(risk_rows(spark, sf), ["asset_class", "scenario_name"])


def worst_case(spark, sf):
    return R.worst_case(risk_rows(spark, sf))


def best_case(spark, sf):
    return R.best_case(risk_rows(spark, sf))


def scores_shown(spark, sf):
    """Sevenths of the scores, shown with three decimals."""
    rows = risk_rows(spark, sf).select("k", (F.col("metric_value") / 7 + 1.23e-9).alias("score"))
    return R.present(rows, "score")


def compare_scenarios(spark, sf):
    return R.compare_scenarios(
        risk_rows(spark, sf), "2050", "P50", METRIC,
        scenarios=("RCP 8.5", "RCP 4.5", "SSP2-4.5", "SSP1-2.6"),
    )


def compare_horizons(spark, sf):
    return R.compare_horizons(risk_rows(spark, sf), "RCP 8.5", "P95", METRIC, years=R.HORIZONS)


def compare_all_horizons(spark, sf):
    return R.compare_horizons(risk_rows(spark, sf), "RCP 4.5", "P50", METRIC)


def compare_all_scenarios(spark, sf):
    return R.compare_scenarios(risk_rows(spark, sf), "2030", "P5")


def top_risk(spark, sf):
    ties = ("identifier", "metric_name", "k")
    return R.top_risk(risk_rows(spark, sf), "asset_class", 5, ties=ties)


def top_risk_by_region(spark, sf):
    ties = ("identifier", "metric_name", "k")
    return R.top_risk(risk_rows(spark, sf), "region", 3, ties=ties)


def score_range(spark, sf):
    # 0.5 rather than 1.0 as the upper bound, so that the derived rows hold both sides.
    rules = [within("metric_value", 0, 1), within("metric_value", 0, 0.5)]
    return check_rules(R.current(risk_rows(spark, sf)), rules)


QUERIES = {
    "count_by_type": (
        count_by_type,
        risk_sql("SELECT identifier_type, count(*) AS record_count FROM risk GROUP BY 1"),
    ),
    "avg_by_class_scenario": (
        avg_by_class_scenario,
        risk_sql(f"""SELECT asset_class, scenario_name, {AVG_METRIC} AS avg_risk,
            count(*) AS record_count, count(DISTINCT identifier) AS instrument_count
            FROM risk WHERE {CURRENT} AND metric_name_internal = '{METRIC}' GROUP BY 1, 2"""),
    ),
    "exposure_by_region": (
        exposure_by_region,
        risk_sql(f"""SELECT region, {AVG_METRIC} AS avg_risk,
            count(*) AS record_count, count(DISTINCT identifier) AS instrument_count
            FROM risk WHERE {CURRENT} AND metric_name_internal = '{METRIC}' GROUP BY 1"""),
    ),
    "metric_breakdown": (
        metric_breakdown,
        risk_sql(f"""SELECT metric_name, count(*) AS record_count,
            count(DISTINCT identifier) AS instrument_count,
            {AVG_METRIC} AS avg_risk, max(metric_value) AS max_risk
            FROM risk WHERE {CURRENT} GROUP BY 1"""),
    ),
    "proxied_split": (
        proxied_split,
        risk_sql(f"""SELECT is_proxied, {AVG_METRIC} AS avg_risk,
            count(*) AS record_count, count(DISTINCT identifier) AS instrument_count,
            100.0 * CAST(count(*) AS DOUBLE)
              / (SELECT count(*) FROM risk WHERE {CURRENT}) AS share_pct
            FROM risk WHERE {CURRENT} GROUP BY 1"""),
    ),
    "lookup_batch": (
        lookup_batch,
        risk_sql(f"""SELECT {ALL} FROM risk WHERE {CURRENT} AND identifier_type = 'ISIN'
            AND identifier IN ('ID0', 'ID4', 'ID16', 'NONE')"""),
    ),
    "lookup_by_table": (
        lookup_by_table,
        risk_sql(f"""SELECT {ALL} FROM risk WHERE {CURRENT} AND identifier_type = 'CUSIP'
            AND identifier IN (SELECT concat('ID', CAST(c_nationkey AS STRING)) FROM customer
                               WHERE c_acctbal < 0)"""),
    ),
    "current_rows": (current_rows, risk_sql(f"SELECT {ALL} FROM risk WHERE {CURRENT}")),
    "history": (
        history,
        risk_sql("""SELECT identifier, effective_start_date, effective_end_date, version
            FROM risk WHERE identifier = 'ID4'"""),
    ),
    "as_of": (
        as_of,
        risk_sql(f"""SELECT {ALL} FROM risk
            WHERE DATE '1997-06-30' BETWEEN effective_start_date AND effective_end_date"""),
    ),
    "as_of_pairs": (
        as_of_pairs,
        risk_sql("""SELECT a.o_orderkey AS asked_order, CAST(a.o_orderdate AS DATE) AS asked_date, r.identifier, r.k, r.metric_value
            FROM orders a JOIN risk r
              ON r.identifier = concat('ID', CAST(CASE WHEN a.o_orderkey % 50 = 0 THEN 0 ELSE a.o_custkey END AS STRING))
              AND CAST(a.o_orderdate AS DATE) BETWEEN r.effective_start_date AND r.effective_end_date"""),
    ),
    "proxied": (
        proxied,
        risk_sql(f"""SELECT identifier_type, identifier, metric_name, metric_value, is_proxied
            FROM risk WHERE is_proxied = 'Y' AND {CURRENT}"""),
    ),
    "proxied_flag": (
        proxied_flag,
        risk_sql("""SELECT coalesce(is_proxied = 'Y', false) AS proxied_flag, asset_class, count(*) AS record_count
            FROM risk GROUP BY 1, 2"""),
    ),
    "instrument_profile": (
        instrument_profile,
        risk_sql(f"""SELECT identifier, scenario_name, scenario_year, scenario_percentile,
            metric_name, metric_value FROM risk
            WHERE identifier_type = 'ISIN' AND identifier = 'ID8' AND {CURRENT}"""),
    ),
    "instrument_question": (
        instrument_question,
        risk_sql(f"""SELECT {ALL} FROM risk WHERE identifier_type = 'ISIN' AND identifier = 'ID0'
            AND scenario_name = 'RCP 8.5' AND scenario_year = '2050' AND {CURRENT}"""),
    ),
    "latest": (
        latest,
        risk_sql(f"""SELECT {ALL} FROM risk WHERE {CURRENT}
            AND as_of_date = (SELECT max(as_of_date) FROM risk WHERE {CURRENT})"""),
    ),
    "latest_by_class": (
        latest_by_class,
        risk_sql(f"""SELECT {ALL} FROM risk WHERE {CURRENT}
            AND (asset_class, scenario_name, as_of_date) IN (
              SELECT (asset_class, scenario_name, max(as_of_date)) FROM risk WHERE {CURRENT}
              GROUP BY asset_class, scenario_name)"""),
    ),
    "worst_case": (
        worst_case,
        risk_sql(f"""SELECT {ALL} FROM risk WHERE {CURRENT}
            AND scenario_name = 'RCP 8.5' AND scenario_percentile = 'P95'"""),
    ),
    "best_case": (
        best_case,
        risk_sql(f"""SELECT {ALL} FROM risk WHERE {CURRENT}
            AND scenario_name IN ('RCP 4.5', 'SSP1-2.6') AND scenario_percentile = 'P5'"""),
    ),
    "scores_shown": (
        scores_shown,
        risk_sql("SELECT k, round(metric_value / 7 + 1.23e-9, 3) AS score FROM risk"),
    ),
    "compare_scenarios": (
        compare_scenarios,
        risk_sql(f"""SELECT identifier_type, identifier,
            max(CASE WHEN scenario_name = 'RCP 8.5' THEN metric_value END) AS rcp_8_5,
            max(CASE WHEN scenario_name = 'RCP 4.5' THEN metric_value END) AS rcp_4_5,
            max(CASE WHEN scenario_name = 'SSP2-4.5' THEN metric_value END) AS ssp2_4_5,
            max(CASE WHEN scenario_name = 'SSP1-2.6' THEN metric_value END) AS ssp1_2_6
            FROM risk WHERE {CURRENT} AND metric_name_internal = '{METRIC}'
            AND scenario_year = '2050' AND scenario_percentile = 'P50' GROUP BY 1, 2"""),
    ),
    "compare_horizons": (
        compare_horizons,
        risk_sql(f"""SELECT identifier_type, identifier,
            max(CASE WHEN scenario_year = '2030' THEN metric_value END) AS y2030,
            max(CASE WHEN scenario_year = '2050' THEN metric_value END) AS y2050,
            max(CASE WHEN scenario_year = '2100' THEN metric_value END) AS y2100
            FROM risk WHERE {CURRENT} AND metric_name_internal = '{METRIC}'
            AND scenario_name = 'RCP 8.5' AND scenario_percentile = 'P95' GROUP BY 1, 2"""),
    ),
    "compare_all_horizons": (
        compare_all_horizons,
        risk_sql(f"""SELECT identifier_type, identifier, scenario_year,
            max(metric_value) AS metric_value
            FROM risk WHERE {CURRENT} AND metric_name_internal = '{METRIC}'
            AND scenario_name = 'RCP 4.5' AND scenario_percentile = 'P50' GROUP BY 1, 2, 3"""),
    ),
    "compare_all_scenarios": (
        compare_all_scenarios,
        risk_sql(f"""SELECT identifier_type, identifier, scenario_name, max(metric_value) AS metric_value
            FROM risk WHERE {CURRENT} AND scenario_year = '2030' AND scenario_percentile = 'P5'
            GROUP BY 1, 2, 3"""),
    ),
    "top_risk": (
        top_risk,
        risk_sql(f"""SELECT * FROM (SELECT {ALL}, CAST(row_number() OVER (PARTITION BY asset_class
            ORDER BY metric_value DESC NULLS LAST, identifier, metric_name, k) AS INTEGER) AS risk_rank
            FROM (SELECT *, row_number() OVER (PARTITION BY asset_class, identifier_type, identifier
              ORDER BY metric_value DESC NULLS LAST, identifier, metric_name, k) AS own FROM risk WHERE {CURRENT})
            WHERE own = 1) WHERE risk_rank <= 5"""),
    ),
    "top_risk_by_region": (
        top_risk_by_region,
        risk_sql(f"""SELECT * FROM (SELECT {ALL}, CAST(row_number() OVER (PARTITION BY region
            ORDER BY metric_value DESC NULLS LAST, identifier, metric_name, k) AS INTEGER) AS risk_rank
            FROM (SELECT *, row_number() OVER (PARTITION BY region, identifier_type, identifier
              ORDER BY metric_value DESC NULLS LAST, identifier, metric_name, k) AS own FROM risk WHERE {CURRENT})
            WHERE own = 1) WHERE risk_rank <= 3"""),
    ),
    "score_range": (
        score_range,
        risk_sql(f"""SELECT 'within(metric_value, 0, 0.5)' AS rule, n AS violations,
              concat(CAST(n AS STRING), ' records with metric_value outside 0 to 0.5') AS message
            FROM (SELECT count(*) AS n FROM risk
                  WHERE {CURRENT} AND NOT metric_value BETWEEN 0 AND 0.5) WHERE n > 0
            UNION ALL
            SELECT 'within(metric_value, 0, 1)', n,
              concat(CAST(n AS STRING), ' records with metric_value outside 0 to 1')
            FROM (SELECT count(*) AS n FROM risk
                  WHERE {CURRENT} AND NOT metric_value BETWEEN 0 AND 1) WHERE n > 0"""),
    ),
}
