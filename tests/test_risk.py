import datetime

import pytest
from pyspark.sql import functions as F

from golden import golden
from landgate.operators import risk as R
from landgate.operators.quality import check_rules, within

OPEN = datetime.date(9999, 12, 31)


@pytest.fixture(scope="module")
def risk(spark):
    return golden(spark).cache()


def rounded(rows, digits=6):
    return [tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in rows]


def test_shape(risk):
    assert len(risk.columns) == 33
    assert risk.count() == 18


def test_count_by(risk):
    got = dict(map(tuple, R.count_by(risk, "identifier_type").collect()))
    assert got == {"CUSIP": 3, "ISIN": 9, "SOVEREIGN": 3, "TICKER": 3}


def test_current(risk):
    assert R.current(risk).count() == 17


def test_history(risk):
    got = [tuple(r)[1:] for r in R.history(risk, "US0378331005").collect()]
    assert got[0] == (datetime.date(2026, 3, 1), datetime.date(2026, 3, 31), "v3.1")
    assert got[1:] == [(datetime.date(2026, 4, 1), OPEN, "v3.2")] * 3


@pytest.mark.parametrize(
    "day, rows", [("2026-02-28", 0), ("2026-03-01", 1), ("2026-03-31", 1), ("2026-04-01", 17)]
)
def test_as_of_includes_both_ends(risk, day, rows):
    assert R.as_of(risk, day).count() == rows


def test_latest(risk):
    assert R.latest(risk).count() == 17
    older = risk.withColumn(
        "as_of_date",
        F.when(F.col("region") == "Europe", F.lit("2026-04-10").cast("date")).otherwise(
            F.col("as_of_date")
        ),
    )
    assert R.latest(older).count() == 17 - 4
    assert R.latest(older, ["region"]).count() == 17
    assert R.latest(older, ["asset_class"]).count() == 17 - 4


def test_latest_treats_null_keys_as_a_group(risk):
    nulls = risk.withColumn("region", F.lit(None).cast("string"))
    assert R.latest(nulls, ["region"]).count() == 17


def test_lookup(risk, spark):
    ids = ["US0378331005", "US5949181045"]
    assert R.lookup(risk, "ISIN", ids).count() == 5
    assert R.lookup(risk, "ISIN", ids, history=True).count() == 6
    assert R.lookup(risk, "CUSIP", ids).count() == 0
    assert R.lookup(risk, "ISIN", []).count() == 0
    assert R.lookup(risk, "ISIN", [None, *ids]).count() == 5
    many = ids + [f"none{i}" for i in range(R.MAX_IN_LIST)]
    assert R.lookup(risk, "ISIN", many).count() == 5
    table = spark.createDataFrame([(i,) for i in ids + ids], "id string")
    assert R.lookup(risk, "ISIN", table).count() == 5


def test_lookup_broadcasts_only_small_lists(risk, monkeypatch):
    many = [f"none{i}" for i in range(R.MAX_IN_LIST + 1)]

    def hinted():
        plan = R.lookup(risk, "ISIN", many)._jdf.queryExecution().analyzed().toString()
        return "broadcast" in plan.lower()

    assert hinted()
    monkeypatch.setattr(R, "MAX_BROADCAST_BYTES", 10)
    assert not hinted()


def test_instrument_profile(risk):
    got = R.instrument_profile(risk, "ISIN", "US0378331005").collect()
    assert [(r.scenario_name, r.scenario_percentile, r.metric_value) for r in got] == [
        ("RCP 4.5", "P50", 0.198), ("RCP 8.5", "P50", 0.342), ("RCP 8.5", "P95", 0.587),
    ]


def test_avg_by(risk):
    got = R.avg_by(risk, ["asset_class", "scenario_name"], R.PHYSICAL_RISK).collect()
    assert rounded([(r[0], r[1], r.avg_risk, r.record_count) for r in got]) == [
        ("FIXED_INCOME", "RCP 8.5", 0.521, 1),
        ("MULTI_ASSET", "RCP 8.5", 0.4715, 2),
        ("EQUITY", "RCP 8.5", 0.428833, 6),
        ("EQUITY", "RCP 4.5", 0.198, 1),
    ]
    assert [r.instrument_count for r in got] == [1, 1, 4, 1]


def test_exposure_by(risk):
    got = R.exposure_by(risk, "region", R.PHYSICAL_RISK).orderBy("region").collect()
    assert rounded([(r.region, r.instrument_count, r.avg_risk) for r in got]) == [
        ("Asia Pacific", 1, 0.558), ("Europe", 2, 0.455), ("Global", 1, 0.4715),
        ("North America", 2, 0.3648),
    ]


def test_proxied(risk):
    got = sorted((r.identifier_type, r.identifier, r.metric_value) for r in R.proxied_report(risk).collect())
    assert got == [("CUSIP", "06051GJE5", 0.521), ("ISIN", "DE0007164600", 0.389)]
    assert R.flag_proxied(risk).filter("proxied_flag").count() == 2
    split = {r.is_proxied: r for r in R.proxied_split(risk).collect()}
    assert (split["Y"].record_count, split["N"].record_count) == (2, 15)
    assert round(split["Y"].share_pct, 6) == round(200 / 17, 6)


def test_worst_and_best_case(risk):
    assert [(r.identifier, r.metric_value) for r in R.worst_case(risk).collect()] == [
        ("US0378331005", 0.587)
    ]
    assert R.best_case(risk).count() == 0
    optimistic = risk.withColumn("scenario_percentile", F.lit("P5"))
    assert R.best_case(optimistic).count() == 1
    assert R.best_case(optimistic, scenarios=("SSP1-2.6",)).count() == 0


def test_compare_scenarios(risk):
    got = {r.identifier: (r.rcp_4_5, r.rcp_8_5) for r in R.compare_scenarios(
        risk, "2050", "P50", R.PHYSICAL_RISK, ("RCP 4.5", "RCP 8.5")
    ).collect()}
    assert got.pop("US0378331005") == (0.198, 0.342)
    assert len(got) == 5 and all(low is None and high is not None for low, high in got.values())


def test_compare_horizons(risk):
    got = {r.identifier: tuple(r)[2:] for r in R.compare_horizons(
        risk, "RCP 8.5", "P50", R.PHYSICAL_RISK, R.HORIZONS
    ).collect()}
    assert got["US5949181045"] == (0.285, 0.412, None)
    assert got["BGSAX"] == (None, 0.298, 0.645)
    every = R.compare_horizons(risk.unionByName(risk.withColumn("scenario_year", F.lit("2040"))), "RCP 8.5", "P50")
    assert every.filter("scenario_year = '2040'").count() > 0
    every = R.compare_horizons(risk, "RCP 8.5", "P50", R.PHYSICAL_RISK)
    assert every.filter("identifier = 'BGSAX'").count() == 2


def test_metric_breakdown(risk):
    got = R.metric_breakdown(risk).orderBy("metric_name").collect()
    assert rounded([(r.metric_name, r.record_count, r.avg_risk) for r in got]) == [
        ("Flood Risk Score", 2, 0.508), ("Heat Stress Score", 1, 0.456),
        ("Physical Risk Score", 10, 0.4235), ("Sea Level Rise Score", 1, 0.782),
        ("Typhoon Risk Score", 1, 0.672), ("Wildfire Risk Score", 2, 0.3005),
    ]


def test_top_risk(risk):
    got = R.top_risk(risk, "asset_class", 1).orderBy("asset_class").collect()
    assert [(r.identifier, r.metric_value) for r in got] == [
        ("JP3435000009", 0.672), ("06051GJE5", 0.521), ("BGSAX", 0.645), ("NLD", 0.891),
    ]
    assert R.top_risk(risk, "region", 2).groupBy("region").count().agg(F.max("count")).first()[0] == 2


def test_top_risk_ranks_instruments(risk):
    got = R.top_risk(risk.unionByName(risk), "asset_class", 5000)
    own = got.groupBy("asset_class", "identifier_type", "identifier").count()
    assert own.agg(F.max("count")).first()[0] == 1
    assert own.count() == R.current(risk).select("asset_class", "identifier_type", "identifier").distinct().count()


def test_instrument_question(risk):
    got = R.instrument_question(risk, "ISIN", "US0378331005", "RCP 8.5", "2050").collect()
    assert sorted((r.scenario_percentile, r.metric_value) for r in got) == [
        ("P50", 0.342), ("P95", 0.587)
    ]


def test_score_range_rule(risk):
    assert check_rules(risk, [within("metric_value", 0, 1)]).count() == 0
    got = check_rules(risk, [within("metric_value", 0, 0.7)]).first()
    assert got.violations == 2


def test_present(risk):
    one = R.present(risk.select((F.col("metric_value") / 3).alias("v")), "v")
    assert all(round(r.v, 3) == r.v for r in one.collect())
