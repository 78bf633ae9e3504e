import pytest
from pyspark.sql import functions as F

from landgate.plans.results import Results
from landgate.plans.rollup import answer, build_rollup
from landgate.plans.semantic import Item, SemanticModel, query

MEASURES = {
    "n": ("count", "*"), "filled": ("count", "v"), "total": ("sum", "k"), "mean": ("avg", "v"), "low": ("min", "v"),
    "high": ("max", "d"), "ids": ("distinct", "id"),
}
MODEL = SemanticModel("m", "t", dimensions=(Item("a", "a"), Item("b", "`b`"), Item("yr", "year(d)"), Item("id", "id")))
for _name, _expr in (
    ("n", "count(*)"), ("filled", "count(v)"), ("total", "sum(k)"), ("mean", "avg(v)"), ("low", "min(v)"),
    ("high", "max(d)"), ("ids", "count(DISTINCT id)"),
):
    MODEL = MODEL.with_metric(_name, _expr)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("rollup") / "base")
    rows = spark.range(4000).select(
        F.when(F.col("id") % 9 != 0, F.col("id") % 3).alias("a"), (F.col("id") % 5).cast("string").alias("b"),
        F.expr("date_add(DATE'2024-11-01', CAST(id % 300 AS INT))").alias("d"), (F.col("id") * 7 % 31).alias("id"),
        F.when(F.col("id") % 4 != 0, F.col("id") / 8).alias("v"), F.col("id").cast("int").alias("k"),
    )
    rows.write.parquet(where)
    return spark.read.parquet(where)


@pytest.fixture(scope="module")
def rollup(base):
    return build_rollup(MODEL, base, ["a", "b", "YR"], MEASURES)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), sorted(df.inputFiles())


@pytest.mark.parametrize("dims, where", [
    (["a"], None), (["b", "yr"], None), (["A", "b", "yr"], None), ([], None), (["yr"], "b = '2' AND a IS NOT NULL"), ([], "b = 'none'"),
    (["a"], "b = 'none'"), (["a"], "column"),
])
def test_coarser_questions_come_from_the_rollup_and_agree(base, rollup, dims, where):
    metrics = list(MEASURES)
    where = F.col("b") > "1" if where == "column" else where
    got = answer(rollup, base, dims, metrics, where)
    want = query(MODEL, base, dims, metrics=metrics, where=where)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert not set(got.inputFiles()) & set(base.inputFiles())


def test_what_the_rollup_can_not_tell_comes_from_the_table(base, rollup):
    for dims, where in ((["id"], None), (["a"], "k > 100"), (["a"], "d < DATE'2025-01-01'"), (["a"], "yr = 2024")):
        if where == "yr = 2024":
            assert not rollup.answers(dims, ["n"], where)
            continue
        got = answer(rollup, base, dims, ["n", "ids"], where)
        assert set(got.inputFiles()) == set(base.inputFiles())
        assert sorted(map(str, got.collect())) == sorted(map(str, query(MODEL, base, dims, metrics=["n", "ids"], where=where).collect()))


def test_measures_that_mean_something_else_are_refused(base):
    for measures in ({"n": ("sum", "k")}, {"total": ("sum", "v")}, {"nothing": ("count", "*")}, {"n": ("median", "k")}):
        with pytest.raises(ValueError):
            build_rollup(MODEL, base, ["a"], measures)
    two = MODEL.with_metric("bs", "count(DISTINCT b)")
    with pytest.raises(ValueError, match="more than one"):
        build_rollup(two, base, ["a"], {"ids": ("distinct", "id"), "bs": ("distinct", "b")})


def test_an_empty_table(base):
    none = base.limit(0)
    rollup = build_rollup(MODEL, none, ["a"], MEASURES)
    assert answer(rollup, none, ["a"], ["n"]).count() == 0
    assert answer(rollup, none, [], ["n", "mean", "ids"]).first() == (0, None, 0)


def jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_result_is_computed_once(spark, base, folder):
    results = Results(spark, folder)

    def best(name):
        return base.groupBy("a").agg(F.max("v").alias(name))

    first, n = jobs(spark, "first", lambda: results.get(best("best")))
    again, none = jobs(spark, "again", lambda: results.get(best("other")))
    assert n > 0 and none == 0
    assert again.columns == ["a", "other"] and again.inputFiles() == first.inputFiles()
    assert sorted(map(str, again.toDF("a", "best").collect())) == sorted(map(str, best("best").collect()))
    top, n = jobs(spark, "top", lambda: results.scalar(first.agg(F.max("best"))))
    same, none = jobs(spark, "same", lambda: results.scalar(first.agg(F.max("best"))))
    assert n > 0 and none == 0 and top == same == base.agg(F.max("v")).first()[0]
    other = results.get(base.groupBy("a").agg(F.min("v").alias("best")))
    assert other.inputFiles() != first.inputFiles()
    results.forget(best("best"))
    assert results.get(best("best")).inputFiles() != first.inputFiles()


def test_scalars_of_no_row_and_of_many(spark, base, folder):
    results = Results(spark, folder)
    assert results.scalar(base.filter("false").select("k")) is None
    with pytest.raises(ValueError, match="one row"):
        results.scalar(base.select("k"))
