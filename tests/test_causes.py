"""Causes of rejects, next to what Spark's reader rejects; safe overwrites; loads that can be run again."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.operators import causes as C
from landgate.operators.tables import overwrite_table, put_batch
from landgate.plans import load as load_plan
from landgate.plans.gate import GateConfig, run_gate
from landgate.plans.load import LoadConfig, run_load
from landgate.schemas import CORRUPT
from landgate.sources.json_records import read_json
from landgate.sources.landing import batch_identity

DDL = (
    "s string, d double, l long, i int, b boolean, m decimal(10,2), t struct<x: long, u: struct<y: double>>, "
    f"a array<struct<k: string, n: long>>, w array<double>, {CORRUPT} string"
)
CASES = [
    ('{"s":1,"d":1,"l":2,"b":true,"t":{"x":1,"u":{"y":2.5}},"a":[{"k":"a","n":1}],"w":[1,2.5]}', None, None),
    ('{"d":"NaN","l":null,"t":null,"a":null,"w":[null]}', None, None),
    ('{"d":"abc"}', C.TYPE, "d"), ('{"d":true}', C.TYPE, "d"), ('{"d":{}}', C.TYPE, "d"), ('{"d":[1]}', C.TYPE, "d"),
    ('{"l":1.5}', C.TYPE, "l"), ('{"l":"1"}', C.TYPE, "l"), ('{"i":3000000000}', C.TYPE, "i"), ('{"l":99999999999999999999}', C.TYPE, "l"),
    ('{"b":"true"}', C.TYPE, "b"), ('{"b":1}', C.TYPE, "b"), ('{"t":[1]}', C.TYPE, "t"), ('{"t":{"x":"1"}}', C.TYPE, "t.x"),
    ('{"t":{"u":{"y":"z"}}}', C.TYPE, "t.u.y"), ('{"t":{"u":3}}', C.TYPE, "t.u"), ('{"a":3}', C.TYPE, "a"),
    ('{"a":[{"k":"a"},{"n":"x"}]}', C.TYPE, "a[].n"), ('{"w":[1,"x"]}', C.TYPE, "w[]"), ('{"l":"1","d":"x"}', C.TYPE, "d"),
    ('{"s":"a"', C.SYNTAX, None), ('{"s":}', C.SYNTAX, None), ('{"s":"a" "d":1}', C.SYNTAX, None), ("junk", C.STRAY, None),
    (' \t{"l":}', C.SYNTAX, None), ("[1]x", C.STRAY, None), ("17", C.STRAY, None),
]


@pytest.fixture
def landed(folder):
    with open(f"{folder}/lines.json", "w") as f:
        f.write("\n".join(text for text, _, _ in CASES) + "\n")
    return folder


@pytest.fixture
def schema(spark):
    return T.StructType.fromDDL(DDL)


def name(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


def test_every_reject_has_its_cause(spark, landed, schema):
    parsed = read_json(spark, landed, schema, multiline=False)
    invalid = parsed.filter(F.col(CORRUPT).isNotNull())
    found = {r[CORRUPT]: (r.cause, r.path, r.place) for r in C.explained(invalid, schema).collect()}
    assert {text: v[:2] for text, v in found.items()} == {t: (c, p) for t, c, p in CASES if c}
    for text, (cause, _, place) in found.items():
        if cause == C.TYPE or text == "17":
            assert place is None
        else:
            with pytest.raises(json.JSONDecodeError) as fault:
                json.loads(text)
            assert fault.value.pos == place


def test_gate_counts_causes_in_its_pass(spark, landed, schema):
    report = run_gate(spark, GateConfig(landed, schema, ("s",), (), multiline=False))
    want = {}
    for _, cause, path in CASES:
        if cause:
            want[(cause, path)] = want.get((cause, path), 0) + 1
    assert {(r.cause, r.path): r.records for r in report.causes.collect()} == want
    parsed = read_json(spark, landed, schema, multiline=False)
    assert {(r.cause, r.path): r.records for r in C.reject_causes(parsed, schema).collect()} == want


def test_a_clean_source_has_no_causes(spark, folder, schema):
    with open(f"{folder}/a.json", "w") as f:
        f.write('{"s":"a"}\n')
    report = run_gate(spark, GateConfig(folder, schema, ("s",), (), multiline=False))
    assert report.causes.count() == 0


def failing(df):
    return df.withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")))


def test_a_failed_overwrite_of_a_managed_table_leaves_it(spark):
    table = name("managed")
    assert overwrite_table(spark.range(7), table) == (7, 7)
    with pytest.raises(Exception, match="no"):
        overwrite_table(failing(spark.range(5)), table)
    assert sorted(r.id for r in spark.table(table).collect()) == list(range(7))
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]
    assert overwrite_table(spark.table(table).filter("id > 4"), table) == (2, 2)
    assert overwrite_table(spark.range(3).withColumn("other", F.lit(1)), table) == (3, 3)
    spark.sql(f"DROP TABLE {table}")


LINES = '{"record_id":"1","trade_date":"2026-01-02","quantity":1.5}\n{"record_id":"2"}\n{"record_id":"3"\n'


def batches(spark, folder, file="a.json", text=LINES, cfg=None):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{file}", "w") as f:
        f.write(text)
    return cfg or LoadConfig(f"{folder}/in", name("trades"), table_path=f"{folder}/t", ledger=name("ledger"), audit_table=name("audit"))


def test_a_load_run_again_inserts_nothing(spark, folder):
    cfg = batches(spark, folder)
    first, second = run_load(spark, cfg), run_load(spark, cfg)
    assert (first.inserted, first.repeated, second.inserted, second.repeated) == (2, False, 0, True)
    assert spark.table(cfg.table).count() == 2 and spark.table(cfg.ledger).count() == 1
    assert sorted(r.inserted for r in spark.table(cfg.audit_table).collect()) == [0, 2]
    # Other files are another batch, whose rows come beside those of the first.
    batches(spark, folder, "b.json", '{"record_id":"4"}\n')
    third = run_load(spark, cfg)
    assert (third.inserted, spark.table(cfg.table).count()) == (3, 5)
    assert run_load(spark, cfg).repeated


def test_a_load_that_failed_before_the_ledger_leaves_one_copy(spark, folder, monkeypatch):
    cfg = batches(spark, folder)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(load_plan, "_enter", stop)
        with pytest.raises(RuntimeError, match="lost"):
            run_load(spark, cfg)
    assert spark.table(cfg.table).count() == 2 and not spark.catalog.tableExists(cfg.ledger)
    assert run_load(spark, cfg).inserted == 2
    assert spark.table(cfg.table).count() == 2
    assert run_load(spark, cfg).repeated


def test_batches_need_their_own_kind_of_table(spark, folder):
    cfg = batches(spark, folder)
    run_load(spark, LoadConfig(cfg.source, cfg.table, table_path=cfg.table_path))
    with pytest.raises(ValueError, match="by batches"):
        put_batch(spark.table(cfg.table), cfg.table, "x")
    with pytest.raises(ValueError, match="rejects"):
        run_load(spark, LoadConfig(cfg.source, cfg.table, ledger=cfg.ledger, invalid_table=name("r")))


def test_batch_identity_follows_the_files(spark, folder):
    cfg = batches(spark, folder)
    one = batch_identity(spark, cfg.source)
    assert batch_identity(spark, cfg.source) == one
    batches(spark, folder, "b.json")
    assert batch_identity(spark, cfg.source) != one
