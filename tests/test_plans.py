"""What the physical plans must look like for the operators to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from golden import golden
from workloads import REGISTRY
from landgate.functions.variant import json_fields
from landgate.operators import quality as Q
from landgate.operators import risk as R
from landgate.operators.conform import conform
from landgate.plans.gate import GateConfig, run_gate, stage, staged_sides
from landgate.plans.load import LoadConfig, run_load
from landgate.schemas import CORRUPT, TRADE, TRADE_TARGET
from landgate.sources.json_records import parse_records, read_json
from landgate.workspace import workspace

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def risk(spark):
    path = workspace(spark, "risk")
    golden(spark).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def lines(folder):
    with open(f"{folder}/lines.json", "w") as f:
        for i in range(500):
            f.write('{"record_id":"%d","quantity":%s}\n' % (i, '"bad"' if i % 5 == 0 else i))
    return folder


class Scans:
    """Counts how often a source folder is scanned by the jobs run in a block."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def __enter__(self):
        self.store = self.spark._jsparkSession.sharedState().statusStore()
        self.before = self._ids()
        return self

    def _executions(self):
        rows = self.store.executionsList()
        return [rows.apply(i) for i in range(rows.size())]

    def _ids(self):
        return {e.executionId() for e in self._executions()}

    def __exit__(self, *_):
        new = [e for e in self._executions() if e.executionId() not in self.before]
        plans = [e.physicalPlanDescription() for e in new]
        # The initial plan of an adaptive query repeats the scan; count the final one.
        plans = [p.split("Initial Plan")[0] for p in plans]
        self.count = sum(
            len(re.findall(r"Location: \w+ \[[^\]]*" + re.escape(self.folder) + r"[\]/,]", p))
            for p in plans
        )


def test_gate_scans_its_source_once(spark, lines):
    cfg = GateConfig(
        lines, schema=TRADE, key_fields=["price", "quantity"], rules=[Q.required("price")],
        multiline=False, valid_table="plan_valid", invalid_table="plan_invalid",
        table_root=workspace(spark, "plan"),
    )
    with Scans(spark, lines) as scans:
        report = run_gate(spark, cfg)
        report.null_stats.collect()
        report.violations.collect()
        Q.reject_sample(report.invalid).collect()
    assert report.invalid_count == 100
    assert scans.count == 1


def test_load_scans_its_source_once(spark, lines):
    cfg = LoadConfig(lines, "plan_load", table_path=workspace(spark, "plan"))
    with Scans(spark, lines) as scans:
        report = run_load(spark, cfg)
    assert report.inserted == 400
    assert scans.count == 1


def test_staged_sides_read_their_own_files(spark, lines):
    parsed = read_json(spark, lines, TRADE, multiline=False)
    staged, _ = stage(parsed, workspace(spark, "plan"))
    for side, flag in zip(staged_sides(staged), ("is_valid", "NOT")):
        partition_filters = re.search(r"PartitionFilters: \[(.*?)\]", plan(side)).group(1)
        assert flag in partition_filters
    narrow = plan(staged_sides(staged)[0].select("record_id"))
    assert "ReadSchema: struct<record_id:string>" in narrow


def test_load_has_no_shuffle_and_no_python(spark, lines):
    valid, _ = Q.split_valid(read_json(spark, lines, TRADE, multiline=False))
    text = plan(conform(valid, TRADE_TARGET))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_lookup_and_current_reach_the_scan(risk):
    text = plan(R.lookup(risk, "ISIN", ["a", "b"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\]\s*,? ?ReadSchema", text, re.S).group(1)
    for part in ("effective_end_date", "identifier_type", "In(identifier"):
        assert part in pushed
    assert "Exchange" not in text


def test_long_lookup_keeps_the_big_side_in_place(risk):
    text = plan(R.lookup(risk, "ISIN", [f"i{n}" for n in range(5000)]))
    assert "LeftSemi" in text and "BroadcastExchange" in text
    assert "Exchange hashpartitioning" not in text


def test_top_risk_combines_and_ranks_in_parts(risk):
    for k in (5, 5000):
        text = plan(R.top_risk(risk, "asset_class", k))
        assert "partial_min_by" in text
        assert text.count("row_number()") >= 2


def test_exposure_aggregates_before_every_shuffle_without_expanding(risk):
    text = plan(R.exposure_by(risk, "region"))
    assert "Expand" not in text
    first_shuffle = text.rindex("Exchange hashpartitioning")
    assert "partial_avg" in text[first_shuffle:] and "identifier" in text[first_shuffle:]


def test_latest_never_sorts_a_key_group_in_a_window(risk):
    for keys in ((), ("asset_class",)):
        assert "Window" not in plan(R.latest(risk, keys))


def test_comparisons_shuffle_once(risk):
    for named in (None, ("2030", "2050")):
        assert plan(R.compare_scenarios(risk, "2050", "P50", scenarios=named)).count("Exchange") == 1
        assert plan(R.compare_horizons(risk, "RCP 8.5", "P50", years=named)).count("Exchange") == 1


def test_aggregates_read_only_their_columns(risk):
    text = plan(R.count_by(risk, "identifier_type"))
    assert "ReadSchema: struct<identifier_type:string>" in text


def test_rules_and_null_stats_are_one_aggregate(risk):
    rules = [Q.required("identifier"), Q.numeric_text("scenario_year"), Q.within("metric_value", 0, 1)]
    assert plan(Q.check_rules(risk, rules)).count("FileScan") == 1
    assert plan(Q.null_stats(risk, ["region", "status", "version"])).count("FileScan") == 1


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_json_text_is_parsed_once_for_all_leaves(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    leaves = json_fields(df, "props", {f"c{i}": (f"$.c{i}", "int") for i in range(3)})
    assert optimized(leaves).count("parseJson") == 1


def test_records_of_a_column_are_parsed_once_when_filtered(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").select("props")
    valid, _ = Q.split_valid(parse_records(df, "props", TRADE))
    assert optimized(valid).count("from_json") == 1


def test_registered_queries_stay_in_the_jvm(spark):
    for name, (run, _) in REGISTRY.items():
        text = plan(run(spark, SF))
        assert not re.search(r"PythonUDF|EvalPython|MapInPandas|MapInArrow|FlatMapGroups", text), name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_every_query_with_sql_is_registered():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert {name for name, (_, sql) in REGISTRY.items() if sql is None} == {"landing_list", "draft_model"}


def test_staging_does_not_sort_the_records(spark, lines):
    stage(read_json(spark, lines, TRADE, multiline=False), workspace(spark, "plans"))
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    texts = [executions.apply(i).physicalPlanDescription() for i in range(executions.size())]
    written = [t for t in texts if "WriteFiles" in t and "is_valid" in t][-1]
    assert "Sort" not in written
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_validity_survives_pruning_in_the_plan(spark, lines):
    df = read_json(spark, lines, TRADE, multiline=False)
    text = plan(df.filter(F.col(CORRUPT).isNull()).select("record_id"))
    assert "trade_details" in re.search(r"ReadSchema: (.*)", text).group(1)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "asset_class", "scenario_name", "avg_risk", "record_count", "instrument_count"
    ]
    assert df.count() > 0
