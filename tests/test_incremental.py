import gzip
import os

import pytest

from landgate.plans import incremental
from landgate.plans.incremental import load_new, new_files


@pytest.fixture
def names(folder):
    tag = os.path.basename(folder).replace("-", "_")
    return {"table": f"new_{tag}", "ledger": f"files_{tag}"}


def put(folder, name, lines):
    os.makedirs(f"{folder}/in/sub", exist_ok=True)
    data = "".join(f"{x}\n" for x in lines).encode()
    with open(f"{folder}/in/{name}", "wb") as f:
        f.write(gzip.compress(data) if name.endswith(".gz") else data)


def run(spark, folder, names, **more):
    return load_new(spark, f"{folder}/in", names["table"], names["ledger"], spark.read.text, **more)


def held(spark, names):
    return sorted(r.value for r in spark.table(names["table"]).collect())


def test_only_new_and_changed_files_are_read(spark, folder, names):
    odd = ("a b+c%20.txt", "sub/[x]{y}*.txt", "é#?.txt", "empty.txt")
    for i, name in enumerate(odd):
        put(folder, name, [] if name == "empty.txt" else [f"{i}-{n}" for n in range(i + 2)])
    first = run(spark, folder, names)
    assert (first.landed, first.failed, first.rows) == (3, 0, 2 + 3 + 4)
    entered = {r.path.split("/in/")[1]: (r.rows, r.status) for r in spark.table(names["ledger"]).collect()}
    assert entered == {n: (i + 2, "LANDED") for i, n in enumerate(odd[:3])}
    assert run(spark, folder, names).landed == 0
    put(folder, "later.txt", ["x"])
    put(folder, "empty.txt", ["now filled"])
    second = run(spark, folder, names)
    assert (second.landed, second.rows) == (2, 2)
    assert held(spark, names) == sorted([f"{i}-{n}" for i in range(3) for n in range(i + 2)] + ["x", "now filled"])


def test_batches_of_bounded_size_load_everything(spark, folder, names):
    for i in range(7):
        put(folder, f"{i}.txt", [f"{i}"])
    report = run(spark, folder, names, max_files=3)
    assert (report.landed, len(report.batches)) == (7, 3)
    assert held(spark, names) == [str(i) for i in range(7)]


def test_a_broken_file_fails_alone(spark, folder, names):
    for i in range(5):
        put(folder, f"{i}.txt.gz", [f"{i}-{n}" for n in range(40)])
    with open(f"{folder}/in/2.txt.gz", "wb") as f:
        f.write(b"this is no archive")
    report = run(spark, folder, names)
    assert (report.landed, report.failed, report.rows) == (4, 1, 160)
    failed = [r for r in spark.table(names["ledger"]).collect() if r.status == "FAILED"]
    assert [r.path.endswith("2.txt.gz") for r in failed] == [True] and failed[0].cause and failed[0].rows == 0
    assert run(spark, folder, names).landed == 0
    put(folder, "2.txt.gz", ["mended"])
    assert run(spark, folder, names).rows == 1
    assert len(held(spark, names)) == 161


def test_a_run_that_died_before_the_ledger_is_repeated_once(spark, folder, names, monkeypatch):
    put(folder, "a.txt", ["1", "2"])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "_enter", die)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, folder, names)
    assert held(spark, names) == ["1", "2"]
    assert new_files(spark, f"{folder}/in", names["ledger"]).count() == 1
    run(spark, folder, names)
    assert held(spark, names) == ["1", "2"]


def test_an_empty_landing(spark, folder, names):
    os.makedirs(f"{folder}/in")
    assert run(spark, folder, names) == incremental.NewFiles(0, 0, 0, ())
