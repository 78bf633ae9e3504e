import dataclasses
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from landgate.operators import quality as Q
from landgate.plans.gate import GateConfig, gate_records, run_gate, stage, staged_sides
from landgate.schemas import BILLING, BILLING_KEY_FIELDS, CORRUPT, TRADE
from landgate.sources.json_records import parse_records, read_json
from landgate.workspace import workspace

GOOD = {
    "billing_account_id": "A1", "cost": "1.5", "currency": "USD", "project": "p",
    "service": {"id": "s"}, "sku": {"id": "k"},
}


def bills(folder, *records, name="bills.json"):
    with open(f"{folder}/{name}", "w") as f:
        f.write(json.dumps(list(records)))
    return folder


def name(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


@pytest.mark.parametrize(
    "records, status",
    [
        ([GOOD], Q.PASSED),
        ([GOOD, {**GOOD, "cost": "n/a"}], Q.PASSED_WITH_WARNINGS),
        ([GOOD, {"currency_conversion_rate": "x"}], Q.PARTIAL),
        ([GOOD, {"currency_conversion_rate": "x"}, {"cost": "1"}], Q.ISSUES),
    ],
)
def test_verdicts(spark, folder, records, status):
    assert run_gate(spark, GateConfig(bills(folder, *records))).status == status


def test_report(spark, folder):
    records = [GOOD, {"cost": "1e-5"}, {"billing_account_id": "A2", "cost": "-3"}, {"usage": 3}]
    report = run_gate(spark, GateConfig(bills(folder, *records)))
    assert (report.total, report.valid_count, report.invalid_count) == (4, 3, 1)
    assert {r.field: (r.nulls, round(r.pct, 2)) for r in report.null_stats.collect()} == {
        "billing_account_id": (1, 33.33), "cost": (0, 0.0), "currency": (2, 66.67),
        "project": (2, 66.67), "service": (2, 66.67), "sku": (2, 66.67),
    }
    assert [tuple(r) for r in report.violations.collect()] == [
        ("required(billing_account_id)", 1, "1 valid records with null billing_account_id"),
        ("numeric_text(cost)", 1, "1 records with non-numeric cost"),
    ]
    assert CORRUPT not in report.valid.columns
    assert [r[CORRUPT] for r in report.invalid.collect()] == ['{"usage": 3}']
    summary = report.summary.first()
    assert (summary.valid_pct, summary.invalid_pct) == (75.0, 25.0)


@pytest.mark.parametrize(
    "text, numeric",
    [
        ("1", True), ("-1.50", True), ("0.0", True), ("12\n", True), ("1e-5", False),
        (".5", False), ("5.", False), ("+1", False), (" 1", False), ("", False), ("1,5", False),
    ],
)
def test_numeric_text(spark, text, numeric):
    df = spark.createDataFrame([(text,), (None,)], "cost string")
    assert Q.check_rules(df, [Q.numeric_text("cost")]).count() == (0 if numeric else 1)


@pytest.mark.parametrize("files", [0, 1])
def test_empty_source(spark, folder, files):
    tables = {"valid_table": name("v"), "invalid_table": name("i")}
    for i in range(files):
        open(f"{folder}/{i}.json", "w").close()
    for multiline in (True, False):
        report = run_gate(spark, GateConfig(folder, multiline=multiline, **tables))
        assert (report.total, report.valid_count, report.invalid_count) == (0, 0, 0)
        assert report.status == Q.PASSED and report.tables == {}
        assert report.valid.count() == 0 and report.invalid.count() == 0
        assert {r.pct for r in report.null_stats.collect()} == {0.0}
        row = report.summary.first()
        assert (row.valid_pct, row.invalid_pct) == (0.0, 0.0)
    assert not any(spark.catalog.tableExists(t) for t in tables.values())


@pytest.mark.parametrize("linked", [False, True])
def test_tables_are_replaced(spark, folder, linked):
    root = f"{folder}/tables" if linked else None
    source = f"{folder}/in"
    os.makedirs(source)
    cfg = GateConfig(source, valid_table=name("v"), invalid_table=name("i"), table_root=root)
    bills(source, GOOD, {**GOOD, "cost": "2"}, {"usage": 3})
    assert run_gate(spark, cfg).tables == {cfg.valid_table: 2, cfg.invalid_table: 1}
    assert run_gate(spark, cfg).tables == {cfg.valid_table: 2, cfg.invalid_table: 1}
    assert spark.table(cfg.valid_table).count() == 2
    assert spark.table(cfg.invalid_table).select(CORRUPT).first()[0] == '{"usage": 3}'
    bills(source, {**GOOD, "cost": "7"})
    assert run_gate(spark, cfg).tables == {cfg.valid_table: 1}
    assert [r.cost for r in spark.table(cfg.valid_table).collect()] == ["7"]
    assert spark.table(cfg.valid_table).schema == parse_records(
        spark.createDataFrame([], "raw string"), "raw", BILLING
    ).drop(CORRUPT).schema
    # Nothing to reject this time: the table of the last rejects stays.
    assert spark.table(cfg.invalid_table).count() == 1


@pytest.mark.parametrize("made", ["(a int) USING parquet LOCATION '{}/old'", "(a int) USING parquet"])
def test_other_tables_are_replaced_only_on_demand(spark, folder, made):
    table = name("v")
    spark.sql(f"CREATE TABLE {table} {made.format(folder)}")
    spark.sql(f"INSERT INTO {table} VALUES (1)")
    source = f"{folder}/in"
    os.makedirs(source)
    cfg = GateConfig(bills(source, GOOD), valid_table=table, table_root=f"{folder}/tables")
    with pytest.raises(ValueError):
        run_gate(spark, cfg)
    assert spark.table(table).columns == ["a"] and spark.table(table).count() == 1
    run_gate(spark, dataclasses.replace(cfg, replace_tables=True))
    assert spark.table(table).count() == 1 and "cost" in spark.table(table).columns


def test_audit_rows_add_up(spark, folder):
    audit = name("audit")
    cfg = GateConfig(bills(folder, GOOD, {"cost": "x"}), audit_table=audit)
    run_gate(spark, cfg)
    run_gate(spark, cfg)
    rows = spark.table(audit).collect()
    assert len(rows) == 2
    assert rows[0].status == Q.PASSED_WITH_WARNINGS and rows[0].total == 2
    assert len(rows[0].null_stats) == len(BILLING_KEY_FIELDS) and len(rows[0].violations) == 2
    assert rows[0].validated_at is not None


def test_staging_splits_and_counts_once(spark, folder):
    with open(f"{folder}/lines.json", "w") as f:
        for i in range(3000):
            f.write('{"record_id":"%d","quantity":%s}\n' % (i, '"bad"' if i % 5 == 0 else i))
    parsed = read_json(spark, folder, TRADE, multiline=False)
    staged, metrics = stage(
        parsed.repartition(7), workspace(spark, "t"), ["price"], [Q.within("quantity", 0, 100)]
    )
    valid, invalid = staged_sides(staged)
    assert metrics == {
        "total": 3000, "valid": 2400, "invalid": 600, "null_0": 2400,
        "rule_0": sum(1 for i in range(3000) if i % 5 and i > 100),
    }
    assert (valid.count(), invalid.count()) == (2400, 600)
    assert valid.select("record_id").distinct().count() == 2400


def test_gate_over_parsed_records(spark):
    raw = spark.range(100).select(
        F.format_string('{"billing_account_id":"%d","cost":"%d"}', "id", "id").alias("raw")
    )
    report = gate_records(parse_records(raw, "raw", BILLING), GateConfig("generated"))
    assert (report.total, report.status) == (100, Q.PASSED)


def test_counts_over_nothing_are_zero(spark):
    row = Q.validation_counts(spark.createDataFrame([], f"id string, {CORRUPT} string")).first()
    assert tuple(row) == (0, 0, 0, 0.0, 0.0)


def test_rejected_texts_are_cut(spark):
    df = spark.createDataFrame([("x" * 201,), ("y" * 200,), ("a",)], f"{CORRUPT} string")
    got = sorted(r[0] for r in Q.reject_texts(df).collect())
    assert got == ["a", "x" * 200 + "...", "y" * 200]
    assert [r[0] for r in Q.reject_sample(df, n=2, width=1).collect()] == ["a", "x..."]
