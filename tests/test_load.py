import datetime
import decimal
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from golden import golden
from landgate.functions.reports import field_profile, schema_report
from landgate.functions.variant import json_fields, response_problems, to_variant, variant_fields
from landgate.operators.conform import conform
from landgate.operators.tables import append_table, clustered, create_target, overwrite_table
from landgate.plans.load import LoadConfig, run_load
from landgate.schemas import (
    BILLING, CORRUPT, RISK, RISK_CLUSTERING, RISK_TARGET, TRADE, TRADE_TARGET,
)

LINES = """\
{"record_id":"1","trade_date":"2026-01-02","quantity":1.00005,"price":2.5,"trade_details":{"order":{"order_type":"LIMIT"},"market_data":{"volume":7},"tags":["a","b"]}}
{"record_id":"2","quantity":"abc"}
{"record_id":"3"
{"record_id":"4","trade_date":"2026-13-45","quantity":1e20}
"""
MISSING_ID = '{"trade_date":"2026-01-02"}\n'


def name(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


def config(folder, text=LINES, **more):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/trades.json", "w") as f:
        f.write(text)
    return LoadConfig(f"{folder}/in", name("trades"), table_path=f"{folder}/table", **more)


def test_load(spark, folder):
    cfg = config(folder, audit_table=name("audit"))
    report = run_load(spark, cfg)
    assert (report.total, report.valid_count, report.invalid_count, report.inserted) == (4, 2, 2, 2)
    table = spark.table(cfg.table)
    assert table.columns == [c.name for c in TRADE_TARGET]
    rows = {r.RECORD_ID: r for r in table.drop("TRADE_DETAILS").collect()}
    assert rows["1"].TRADE_DATE == datetime.date(2026, 1, 2)
    assert rows["1"].QUANTITY == decimal.Decimal("1.0001")
    assert rows["1"].PRICE == decimal.Decimal("2.500000")
    assert rows["4"].TRADE_DATE is None and rows["4"].QUANTITY is None
    assert rows["1"].CREATED_AT == rows["1"].LOAD_TIMESTAMP == rows["4"].CREATED_AT
    assert sorted(r[CORRUPT] for r in report.rejects.collect()) == [
        '{"record_id":"2","quantity":"abc"}', '{"record_id":"3"',
    ]
    assert spark.table(cfg.audit_table).first().inserted == 2


def test_appending_twice_adds_twice(spark, folder):
    cfg = config(folder)
    assert [run_load(spark, cfg).inserted for _ in range(2)] == [2, 2]
    assert spark.table(cfg.table).count() == 4


def test_variant_leaves(spark, folder):
    cfg = config(folder)
    run_load(spark, cfg)
    fields = {
        "order_type": ("$.order.order_type", "string"),
        "volume": ("$.market_data.volume", "bigint"),
        "tag": ("$.tags[1]", "string"),
        "missing": ("$.market_data.none", "string"),
        "wrong": ("$.order.order_type", "int"),
    }
    got = variant_fields(spark.table(cfg.table), "TRADE_DETAILS", fields, keep=("RECORD_ID",))
    assert {tuple(r) for r in got.collect()} == {
        ("1", "LIMIT", 7, "b", None, None), ("4", None, None, None, None, None),
    }
    sql = f"SELECT TRADE_DETAILS:order.order_type::string FROM {cfg.table} WHERE RECORD_ID = '1'"
    assert spark.sql(sql).first()[0] == "LIMIT"


def test_missing_required_value_fails_before_anything_is_appended(spark, folder):
    cfg = config(folder, LINES + MISSING_ID)
    with pytest.raises(Exception, match="required column RECORD_ID is NULL"):
        run_load(spark, cfg)
    assert spark.table(cfg.table).count() == 0


def test_required_can_be_waived(spark, folder):
    cfg = config(folder, LINES + MISSING_ID, enforce_required=False)
    assert run_load(spark, cfg).inserted == 3


def test_empty_load(spark, folder):
    cfg = config(folder, "")
    report = run_load(spark, cfg)
    assert (report.total, report.inserted) == (0, 0)
    assert report.audit.first().valid_pct == 0.0
    assert spark.table(cfg.table).count() == 0


def test_load_of_an_empty_folder(spark, folder):
    os.makedirs(f"{folder}/in")
    report = run_load(spark, LoadConfig(f"{folder}/in", name("trades"), table_path=f"{folder}/t"))
    assert (report.total, report.valid_count, report.inserted) == (0, 0, 0)


def test_all_null_struct_and_absent_struct(spark):
    df = spark.createDataFrame([(1, (None,)), (2, None)], "id int, s struct<a: int>")
    got = dict(to_variant(df, "s").select("id", F.to_json("s")).collect())
    assert got == {1: '{"a":null}', 2: None}


def test_conform_keeps_variants(spark):
    df = spark.sql("SELECT '1' AS record_id, parse_json('{\"a\":1}') AS trade_details")
    one = [c for c in TRADE_TARGET if c.name in ("RECORD_ID", "TRADE_DETAILS")]
    assert conform(df, one).select(F.to_json("TRADE_DETAILS")).first()[0] == '{"a":1}'


def test_append_matches_by_name_and_counts(spark, folder):
    table = name("t")
    df = spark.range(5).select("id", (F.col("id") * 2).alias("b"))
    assert append_table(df, table, f"{folder}/t") == 5
    assert append_table(df.select("b", "id").repartition(3), table) == 5
    assert spark.table(table).filter("b = id * 2").count() == 10
    with pytest.raises(Exception):
        append_table(df.drop("b"), table)


def test_overwrite_verifies(spark, folder):
    table = name("t")
    assert overwrite_table(spark.range(5), table, f"{folder}/t") == (5, 5)
    assert overwrite_table(spark.range(3), table, f"{folder}/t") == (3, 3)


def test_declared_table(spark, folder):
    table = name("risk")
    create_target(spark, table, RISK_TARGET, f"{folder}/risk")
    assert append_table(golden(spark), table) == 18
    assert [f.dataType for f in spark.table(table).schema] == [f.dataType for f in RISK]
    trades = name("trades")
    create_target(spark, trades, TRADE_TARGET, f"{folder}/trades")
    spark.sql(f"INSERT INTO {trades} (RECORD_ID, CURRENCY) VALUES ('a', 'USD'), ('b', 'EUR')")
    rows = spark.table(trades).drop("TRADE_DETAILS").collect()
    assert all(r.CREATED_AT is not None and r.TRADE_DATE is None for r in rows)


def test_clustering_cuts_a_hot_group(spark):
    # All but a few rows agree in every clustering column.
    rows = spark.range(20000).select(
        F.lit("f1").alias("file_name"),
        F.when(F.col("id") % 1000 == 0, "2026-03-31").otherwise("9999-12-31").cast("date")
        .alias("effective_end_date"),
        F.lit("ISIN").alias("identifier_type"),
        F.lit("EQUITY").alias("asset_class"),
        F.col("id").cast("string").alias("identifier"),
    )

    def sizes(df):
        return sorted(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())

    assert max(sizes(clustered(rows, RISK_CLUSTERING, (), partitions=8))) > 15000
    for spread in (["identifier"], None):
        cut = sizes(clustered(rows, RISK_CLUSTERING, spread, partitions=8))
        assert max(cut) < 6000 and len(cut) == 8 and sum(cut) == 20000


def test_a_failed_overwrite_leaves_the_table(spark, folder):
    table = f"kept_{os.path.basename(folder).replace('-', '_')}"
    assert overwrite_table(spark.range(7), table, f"{folder}/t") == (7, 7)
    bad = spark.range(9).withColumn("id", F.expr("if(id = 5, raise_error('no'), id)").cast("long"))
    with pytest.raises(Exception, match="no"):
        overwrite_table(bad, table, f"{folder}/t")
    assert spark.table(table).count() == 7
    assert overwrite_table(spark.range(3), table, f"{folder}/t") == (3, 3)


def test_a_load_counts_what_it_nulls_and_keeps_rejects(spark, folder):
    with open(f"{folder}/a.json", "w") as f:
        for i, day in enumerate(["2026-01-02", "2026-13-45", None, "x"]):
            f.write(json.dumps({"record_id": str(i), "trade_date": day, "price": 1e15 if i == 0 else 1.0}) + "\n")
        f.write("{broken\n")
    tag = os.path.basename(folder).replace("-", "_")
    report = run_load(
        spark, LoadConfig(f"{folder}/a.json", f"nulled_{tag}", invalid_table=f"rejects_{tag}")
    )
    assert report.nulled == {"TRADE_DATE": 2, "QUANTITY": 0, "PRICE": 1}
    assert {r.field: r.nulls for r in report.audit.select(F.inline("nulled")).collect()} == report.nulled
    assert (report.total, report.inserted) == (5, 4)
    assert [r[0] for r in spark.table(f"rejects_{tag}").select("_corrupt_record").collect()] == ["{broken"]


def test_json_leaves(spark):
    df = spark.createDataFrame([('{"a":{"b":{"c":5}}}',), ("broken",), (None,)], "t string")
    got = json_fields(df, "t", {"c": ("$.a.b.c", "int"), "all": ("$", "string")}).collect()
    assert [r.c for r in got] == [5, None, None]
    problems = spark.createDataFrame(
        [('{"error_code":"E1","message":"no"}',), ('{"json_proto":{"warnings":["w"]}}',)], "t string"
    )
    assert [tuple(r) for r in response_problems(problems, "t").collect()] == [
        (None, "E1", "no"), ('["w"]', None, None),
    ]


def test_reports(spark, folder):
    df = spark.createDataFrame([], BILLING)
    paths = {r.path: r.type for r in schema_report(df).collect()}
    assert paths["usage.amount"] == "string" and paths["labels.key"] == "string"
    assert len({r.path for r in schema_report(spark.createDataFrame([], TRADE)).collect()}) == 67
    rows = spark.createDataFrame(
        [("1", [("k", None)]), (None, [(None, "v"), ("k", "v")]), (None, None), (None, [])],
        "billing_account_id string, labels array<struct<key: string, value: string>>",
    )
    got = {r.path: r.present for r in field_profile(rows).collect()}
    assert got == {"billing_account_id": 1, "labels": 3, "labels.key": 2, "labels.value": 1}
