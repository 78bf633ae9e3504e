import gzip
import json
import os
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.schemas import BILLING, CORRUPT, TRADE
from landgate.sources import documents, json_records
from landgate.sources.json_records import parse_documents, parse_records, read_json
from landgate.sources.landing import land, list_landing
from landgate.sources.text_lines import read_lines

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("q", T.DoubleType()),
        T.StructField("t", T.StructType([T.StructField("x", T.StringType())])),
        T.StructField(CORRUPT, T.StringType()),
    ]
)


def put(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)
    return folder


def verdicts(df):
    return sorted((r["id"], r[CORRUPT] is None) for r in df.collect())


LINES = "\n".join(
    [
        '{"id":"good","q":1.5}',
        '{"id":"wrong type","q":"abc"}',
        '{"id":"cut short"',
        '{"id":"null","q":null}',
        '{"id":"extra","z":1}',
        "",
        '{"id":7}',
        '[{"id":"in array 1"},{"id":"in array 2"}]',
        '{"id":"nested","t":{"x":"y"}}',
    ]
)
GOOD = ["7", "extra", "good", "in array 1", "in array 2", "nested", "null"]


def test_lines_keep_rejected_records(spark, folder):
    df = read_json(spark, put(folder, "a.json", LINES), SCHEMA, multiline=False)
    got = df.collect()
    assert sorted(r["id"] for r in got if r[CORRUPT] is None) == GOOD
    bad = sorted(r[CORRUPT] for r in got if r[CORRUPT])
    assert bad == ['{"id":"cut short"', '{"id":"wrong type","q":"abc"}']
    # The fields that could be read are kept.
    assert [r["id"] for r in got if r[CORRUPT] == '{"id":"wrong type","q":"abc"}'] == ["wrong type"]


def test_validity_does_not_depend_on_selected_columns(spark, folder):
    df = read_json(spark, put(folder, "a.json", LINES), SCHEMA, multiline=False)
    valid = df.filter(F.col(CORRUPT).isNull())
    assert sorted(r[0] for r in valid.select("id").collect()) == GOOD
    assert valid.count() == len(GOOD)
    assert valid.agg(F.count(F.lit(1))).first()[0] == len(GOOD)
    assert valid.select("t.x").count() == len(GOOD)


def test_corrupt_column_alone_can_be_queried(spark, folder):
    df = read_json(spark, put(folder, "a.json", LINES), SCHEMA, multiline=False)
    assert df.select(CORRUPT).filter(F.col(CORRUPT).isNotNull()).count() == 2
    assert df.agg(F.count_if(F.col(CORRUPT).isNotNull())).first()[0] == 2


def test_number_text_is_kept_in_lines(spark, folder):
    path = put(folder, "a.json", '{"cost":1.50}\n{"cost":1e-5}\n')
    got = read_json(spark, path, BILLING, multiline=False).select("cost").collect()
    assert sorted(r[0] for r in got) == ["1.50", "1e-5"]


def test_empty_file(spark, folder):
    path = put(folder, "a.json", "")
    assert read_json(spark, path, TRADE, multiline=False).count() == 0
    assert read_json(spark, path, TRADE, multiline=True).count() == 0


def test_document_elements_are_judged_one_by_one(spark, folder):
    path = put(folder, "a.json", '[{"id":"1"},\n {"id":"2","q":"abc"},\n {"id":"3"}]')
    assert verdicts(read_json(spark, path, SCHEMA)) == [("1", True), ("2", False), ("3", True)]
    whole = read_json(spark, path, SCHEMA, granularity="document")
    assert [v for _, v in verdicts(whole)] == [False] * 3 or whole.count() == 1
    assert whole.filter(F.col(CORRUPT).isNull()).count() == 0


@pytest.mark.parametrize(
    "text, good, bad",
    [
        ('{"id":"1"}', 1, []),
        ('[{"id":"1"}', 1, ["["]),
        ('[{"id":"1"},{"id":}]', 1, ['{"id":}']),
        ('[{"id":"1"},{"id":"2"', 1, ['{"id":"2"']),
        ('[{"id":"1"},{"id":"2"}', 2, ["["]),
        ('[{"id":"1"}] junk, more', 1, ["junk", "more"]),
        ('{"id":"1"}\n{"id":"2"}\r\n\n{"id":"3"}', 3, []),
        ('[{"id":"1"}]\n[{"id":"2"}]', 2, []),
        ('{"id":"1","q":12345678.9} {"id":"2","q":0.0001}', 2, []),
        ('{"id":"} \\" {","t":{"x":"]"}}', 1, []),
        ('[{"id":"1"},3,null]', 1, ["3", "null"]),
        ("[]", 0, []),
        (" \n ", 0, []),
        ("nonsense", 0, ["nonsense"]),
        ('{"id":"1"', 0, ['{"id":"1"']),
        ('{"id":"1","q":"x"}', 0, ['{"id":"1","q":"x"}']),
    ],
)
def test_document_forms(spark, folder, text, good, bad):
    got = read_json(spark, put(folder, "a.json", text), SCHEMA).collect()
    assert sum(r[CORRUPT] is None for r in got) == good
    assert sorted(r[CORRUPT] for r in got if r[CORRUPT] is not None) == bad


def test_unknown_granularity(spark, folder):
    with pytest.raises(ValueError):
        read_json(spark, folder, SCHEMA, granularity="file")


def hard_records(n, seed):
    rnd = random.Random(seed)
    texts = ["plain", 'quote " inside', "brace } and ] and {", "back\\slash", '\\"}', "\\\\", "é}日本"]
    out = []
    for i in range(n):
        record = {"id": f"r{i} {rnd.choice(texts)}", "q": rnd.random()}
        if rnd.random() < 0.3:
            record["t"] = {"x": rnd.choice(texts)}
        if rnd.random() < 0.2:
            record["q"] = "not a number"
        out.append(record)
    return out


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def texts_of(df):
    return Counter((r["id"], r["q"], r[CORRUPT]) for r in df.collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_documents_are_cut_alike_at_every_size(spark, folder, indent):
    for i in range(3):
        put(folder, f"{i}.json", json.dumps(hard_records(60, i), indent=indent, ensure_ascii=False))
    put(folder, "lines.json", "\n".join(json.dumps(r) for r in hard_records(90, 7)))
    put(folder, "scalars.json", '[1, {"id":"a"}, null, [{"id":"no"}], {"id":"b"}, 3, null]\n' + " " * 2000)
    put(folder, "single.json", json.dumps({"id": "s" * 3000, "t": {"x": "}"}}))
    put(folder, "deep.json", json.dumps([{"id": "d", "more": [{"x": ["{" * 900, {"y": "}" * 900}]}] * 9}] * 5))
    text = json.dumps(hard_records(100, 2))
    put(folder, "cut_after_record.json", text[: text.rindex("}")] + "}")
    put(folder, "no_value.json", text.replace('"q":', '"q"', 1))
    put(folder, "stray.json", text.replace("}, {", "}}, {", 1))
    put(folder, "numbers.json", '[{"id":"n1","q":12345678.9,"cost":12345678.9},{"id":"n2","q":0.0001}]' + "\n" * 3000)
    with gzip.open(f"{folder}/z.json.gz", "wt") as f:
        f.write(json.dumps(hard_records(100, 3)) + "\n")
    want = texts_of(read_json(spark, folder, SCHEMA))
    whole = spark.read.text(folder, wholetext=True)
    assert texts_of(parse_documents(whole, "value", SCHEMA)) == want
    for size in ("1001", "2500"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            assert texts_of(read_json(spark, folder, SCHEMA)) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_text_of_a_broken_document_is_lost(spark, folder, small_splits):
    text = json.dumps(hard_records(100, 2))
    cut = text[: text.index('"id": "r40') + 5]
    put(folder, "cut.json", cut + " no end " * 900)
    got = read_json(spark, folder, SCHEMA)
    rejects = [r[CORRUPT] for r in got.collect() if r[CORRUPT]]
    assert got.filter(F.col(CORRUPT).isNull()).count() + sum('"not a number"' in r for r in rejects) == 40
    assert sum(r.count("no end") for r in rejects) == 900


def faulty(records, form, faults):
    """A document of the records in which some are broken; returns it and the ids that must survive."""
    texts, broken = [json.dumps(r, **({"separators": (",", ":")} if form == "dense" else {})) for r in records], set()
    if form == "pretty":
        texts = ["  " + json.dumps(r, indent=2).replace("\n", "\n  ") for r in records]
    for at, fault in faults.items():
        text = texts[at]
        if fault == "unclosed":
            texts[at] = text[: text.rindex("}")].rstrip()
        elif fault == "unclosed inside":
            texts[at] = text[: text.index("]")] + text[text.index("]") + 1 :]
        elif fault == "cut off":
            texts[at] = text[: text.index('"y"')].rstrip()
        elif fault == "quote":
            texts[at] = text.replace('_end"', "_end", 1)
        elif fault == "stray":
            texts[at] = text + "}"
            continue
        broken.add(at)
    between = {"dense": ",", "lines": ",\n", "stream": "\n", "pretty": ",\n"}[form]
    whole = between.join(texts)
    whole = whole if form == "stream" else f"[{'' if form == 'dense' else chr(10)}{whole}]"
    return whole, [r["id"] for i, r in enumerate(records) if i not in broken]


FAULTS = [
    {7: "unclosed"}, {7: "unclosed inside", 20: "cut off"}, {7: "quote", 19: "stray"}, {0: "unclosed"},
    {0: "quote", 5: "unclosed", 6: "unclosed", 9: "quote"}, {3: "unclosed", 20: "stray"}, {4: "quote", 24: "quote"}, {29: "unclosed"},
    {}, {2: "cut off", 29: "quote"},
]


@pytest.mark.parametrize("form", ["dense", "lines", "stream", "pretty"])
def test_a_fault_costs_one_record_at_every_split_size(spark, folder, form):
    draw, want, rejects = random.Random(5), [], 0
    for n, faults in enumerate(FAULTS):
        records = [
            {"id": f"f{n}r{i}_end", "q": 1.5, "t": {"x": draw.choice(["a } b", "{ [", "plain, "]) * draw.randint(0, 9)},
             "more": [{"y": 1}, {"y": i}], "deep": {"z": {"w": "}"}}}
            for i in range(30)
        ]
        text, good = faulty(records, form, faults)
        with open(f"{folder}/{n // 4}.json", "a") as f:
            f.write(text + "\n")
        want += good
        rejects += len(faults)
    for size in (None, "5000", "1301"):
        if size:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            rows = read_json(spark, folder, SCHEMA).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted(r["id"] for r in rows if r[CORRUPT] is None) == sorted(want)
        assert sum(r[CORRUPT] is not None for r in rows) == rejects
        found = sorted(r[CORRUPT] for r in rows if r[CORRUPT] is not None)
        assert found == (first if size else (first := found))
    column = parse_documents(spark.read.text(folder, wholetext=True), "value", SCHEMA).collect()
    assert sorted(r[CORRUPT] for r in column if r[CORRUPT] is not None) == first
    assert sorted(r["id"] for r in column if r[CORRUPT] is None) == sorted(want)


def test_nested_objects_are_no_beginnings(spark, folder):
    """Nested objects that look like records: on lines of their own, or with the same first key."""
    flat = '[\n{\n"id":"a",\n"more":[\n{\n"id":"b"\n},\n{\n"id":"c"\n}\n]\n},\n{\n"id":"d"\n}\n]'
    put(folder, "flat.json", flat)
    put(folder, "same.json", json.dumps([{"id": f"s{i}", "more": [{"id": "x"}, {"id": "y"}]} for i in range(40)]))
    put(folder, "broken.json", json.dumps([{"id": f"t{i}", "more": [{"id": "x"}, {"id": "y"}]} for i in range(40)]) + '{"x')
    for size in ("100000", "300"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = read_json(spark, folder, SCHEMA).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        want = ["a", "d", *(f"s{i}" for i in range(40)), *(f"t{i}" for i in range(40))]
        assert sorted(r["id"] for r in rows if r[CORRUPT] is None) == sorted(want)
        assert [r[CORRUPT] for r in rows if r[CORRUPT] is not None] == ['{"x']


def test_files_without_beginnings_keep_to_the_first_rule(spark, folder, monkeypatch):
    monkeypatch.setattr(documents, "MAX_SEGMENT", 3000)
    text = json.dumps([{"q": i, "id": "x" * 90} if i else {"id": "0"} for i in range(100)])
    put(folder, "a.json", text[: text.rindex("}")] + ',"t":{')
    put(folder, "b.json", text.replace('"id": "x', '"id: "x', 1))
    found = []
    for size in ("100000", "2000", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = read_json(spark, folder, SCHEMA).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        found.append(sorted((r["id"] or "", r[CORRUPT] or "") for r in rows))
        assert sum(r[CORRUPT] is None for r in rows) >= 100
    assert found[0] == found[1] == found[2]


def test_number_tokens_of_documents_are_kept(spark, folder):
    put(folder, "a.json", '[{"cost":12345678.9},\n{"cost":0.0001},{"cost":1.50},{"cost":1e-5}]')
    got = read_json(spark, folder, BILLING)
    assert sorted(r.cost for r in got.collect()) == ["0.0001", "1.50", "12345678.9", "1e-5"]


def test_null_texts_are_rejected_and_counted(spark):
    df = spark.createDataFrame([(None,), ('{"id":"1"}',), ("",)], "raw string")
    for parse in (parse_records, parse_documents):
        got = parse(df, "raw", SCHEMA).collect()
        assert sorted((r["id"], r[CORRUPT]) for r in got if r["id"]) == [("1", None)]
        assert [r[CORRUPT] for r in got if not r["id"]] == ["null"]


def test_lines_are_numbered_per_file(spark, folder, small_splits):
    texts = {
        "a.txt": "one\n\nthree\n",
        "b.txt": "no newline at the end",
        "c.txt": "",
        "d.txt": "\n",
        "e.txt": "\n".join(f"line {i} " + "x" * (i % 90) for i in range(800)) + "\n\n",
    }
    want = []
    for name, text in texts.items():
        put(folder, name, text)
        lines = text.split("\n")
        if lines[-1] == "":
            lines.pop()
        want += [(name, i + 1, v) for i, v in enumerate(lines)]
    for limit in (10, 1000, 1 << 20):
        got = read_lines(spark, folder, whole_file_limit=limit).collect()
        assert sorted((r.file.rsplit("/", 1)[1], r.line_no, r.value) for r in got) == sorted(want)


def test_parse_records_from_a_column(spark):
    df = spark.createDataFrame([('{"id":"1"}',), ('{"id":"2","q":"x"}',), ("  ",)], "raw string")
    assert verdicts(parse_records(df, "raw", SCHEMA)) == [("1", True), ("2", False)]
    only = parse_records(df, "raw", SCHEMA).filter(F.col(CORRUPT).isNull()).select("id")
    assert [r[0] for r in only.collect()] == ["1"]
    nested = parse_documents(df, "raw", SCHEMA).filter(F.col(CORRUPT).isNull()).select("id")
    assert [r[0] for r in nested.collect()] == ["1"]


def test_landing_round_trip(spark, folder):
    path = f"{folder}/landed"
    df = spark.range(10).select(F.col("id").cast("string").alias("value"))
    manifest = land(df.coalesce(1), path, "text")
    assert manifest.columns == ["path", "length", "modified", "status"]
    assert [(r.length, r.status) for r in manifest.collect()] == [(20, "LANDED")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        land(df, path, "text", overwrite=False)
    land(df.coalesce(2), path, "text")
    assert spark.read.text(path).count() == 10
    assert list_landing(spark, path).count() == 2


class _Taken:
    """Stands for a DataFrame and gives the function that its workers would run."""

    def select(self, column):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_cut_documents_leave_a_worker_in_bounded_batches():
    texts = ["[" + ",".join(f'{{"a":"{"x" * 1000}{i}"}}' for i in range(1000)) + "]", None] * 8
    batch = pa.RecordBatch.from_pydict({"doc": texts})
    out = list(documents.cut_column(_Taken(), "doc")([batch]))
    assert sum(b.num_rows for b in out) == 8 * 1001
    assert max(b.nbytes for b in out) < 5 << 20
    assert [r["value"] for b in out for r in b.to_pylist()][1000] == "null"


def test_documents_are_handed_to_workers_in_bounded_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(key), []
    stored = json_records.stored
    monkeypatch.setattr(json_records, "stored", lambda df: (seen.append(int(spark.conf.get(key))), stored(df))[1])
    df = spark.createDataFrame([('[{"record_id":"T1"}]',)], "doc string")
    assert parse_documents(df, "doc", TRADE).count() == 1
    assert seen == [8 << 20] and spark.conf.get(key) == before


def test_pieces_taken_together_are_cut_as_one_by_one():
    dice = random.Random(11)
    signs = ["{", "}", '"', "\\", '\\"', "\n", "  ", ":", "[", ",", '"a":', "é", '{"cost":', '},\n  {"cost":"x{y}"', "}}"]
    for _ in range(1500):
        pieces = "".join(dice.choice(signs) for _ in range(dice.randrange(60))).split("{")
        opened, state = dice.random() < 0.5, (dice.randrange(2), dice.randrange(3))
        alone, together = documents.Cutter(*state), documents.Cutter(*state)
        marks = [documents.Beginnings(2, '"cost"', (2, ","), ()) for _ in range(2)]
        found, begins, held = [], [], []
        for i, piece in enumerate(pieces):
            if marks[0].piece(piece, opened or i > 0, not opened and i == 0):
                begins.append(i)
            if opened or i:
                held.append(alone.depth > 0 or bool(alone.inside))
            found += alone.piece(piece, opened or i > 0)
        got, inside = together.pieces(pieces, opened)
        assert (got, inside.tolist()) == (found, held)
        assert marks[1].pieces(pieces, opened, not opened) == begins
        assert marks[1].nested == marks[0].nested and marks[1].before == marks[0].before
        assert list(together.end()) == list(alone.end()) and together.brackets == alone.brackets


def test_documents_are_landed_by_all_tasks(spark):
    from workloads.gate_queries import _land_documents

    before = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        files = list_landing(spark, _land_documents(spark, "/root/testdata/sf0.01")).count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert files > 12
