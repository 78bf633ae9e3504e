import collections
import hashlib
import random

from pyspark.sql import functions as F

from landgate.plans.semantic import draft_model
from landgate.plans.values import profile_values


def test_counts_frequent_values_and_samples_are_exact(spark):
    dice = random.Random(5)
    rows = [
        ("hot" if dice.random() < 0.4 else f"v{dice.randrange(400)}", dice.randrange(50), dice.choice([None, 1.5, -2.0]))
        for _ in range(5000)
    ]
    df = spark.createDataFrame(rows, "text string, n int, d double")
    got = {r.name: r for r in profile_values(df.repartition(7), 4, 5).collect()}
    for at, name in enumerate(("text", "n", "d")):
        seen = collections.Counter(str(r[at]) for r in rows if r[at] is not None)
        assert got[name].distinct == len(seen)
        assert got[name].frequent == [v for v, _ in sorted(seen.items(), key=lambda e: (-e[1], e[0]))[:4]]
        assert got[name].samples == sorted(seen, key=lambda v: (hashlib.md5(v.encode()).hexdigest(), v))[:5]
    again = {r.name: r for r in profile_values(df.repartition(2), 4, 5).collect()}
    assert again == got


def test_empty_tables_nulls_and_unordered_columns(spark):
    df = spark.createDataFrame([(None, [1, 2], {"a": 1}), (None, [1, 2], None)], "a string, l array<int>, m map<string,int>")
    got = {r.name: tuple(r)[1:] for r in profile_values(df).collect()}
    assert got == {"a": (0, [], []), "l": (1, ['{"l":[1,2]}'], ['{"l":[1,2]}'])}
    assert [tuple(r)[1:] for r in profile_values(df.limit(0)).collect()] == [(0, [], [])] * 2
    assert profile_values(df.select("m")).count() == 0


def test_a_draft_names_its_samples(spark):
    df = spark.range(10).select((F.col("id") % 3).cast("string").alias("a.b"), F.lit("x" * 90).alias("long"))
    model = draft_model(df, "m", "t", samples=2)
    comments = {i.name: i.comment for i in model.dimensions}
    assert comments["a.b"] == "string, 100.0% filled, 3 values from 0 to 2, frequent: 0, 1, samples: 1, 2"
    assert comments["long"].endswith(f"samples: {'x' * 40}")
    assert "frequent" not in draft_model(df, "m", "t").dimensions[0].comment
