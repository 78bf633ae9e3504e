"""Operations a Spark user writes in one line; the library adds nothing to them."""

import datetime
import decimal
import uuid

import pytest
from pyspark.sql import functions as F

from landgate.workspace import workspace


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "Alice", 25), (2, "Bob", 30), (3, "Charlie", 35)]).toDF(
        "id", "name", "age"
    )


def test_filter_average_and_union(spark, people):
    assert [r.id for r in people.filter(F.col("age") > 28).orderBy("id").collect()] == [2, 3]
    assert people.groupBy().avg("age").first()[0] == 30.0
    row = spark.sql(
        """SELECT 'x' AS platform, current_timestamp() AS query_time, 1 + 1 AS simple_calc,
             count(*) AS row_count
           FROM (SELECT 1 AS id UNION ALL SELECT 2 UNION ALL SELECT 3)"""
    ).first()
    assert (row.simple_calc, row.row_count) == (2, 3)
    assert people.unionByName(people.select("age", "id", "name")).count() == 6


def test_schemas_and_qualified_names(spark, people, folder):
    schema = f"s_{uuid.uuid4().hex}"
    for _ in range(2):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    people.write.option("path", f"{folder}/people").saveAsTable(f"{schema}.people")
    assert spark.table(f"{schema}.people").count() == 3
    spark.sql(f"USE {schema}")
    try:
        assert spark.table("people").select("id", "name").limit(2).count() == 2
    finally:
        spark.sql("USE default")


def test_earlier_results(spark, people):
    people.agg(F.max("age").alias("oldest")).createOrReplaceTempView("oldest_now")
    spark.sql("DECLARE OR REPLACE VARIABLE oldest INT")
    spark.sql("SET VAR oldest = (SELECT oldest FROM oldest_now)")
    assert spark.sql("SELECT oldest + 1").first()[0] == 36


def test_whole_file_as_text(spark, folder):
    with open(f"{folder}/m.yaml", "w") as f:
        f.write("a: 1\nb: 2\n")
    assert spark.read.text(folder, wholetext=True).first().value == "a: 1\nb: 2\n"


def test_scalar_functions(spark):
    row = spark.sql(
        """SELECT try_to_date('2026-13-45', 'yyyy-MM-dd') AS bad_date,
             try_to_date('2026-01-02', 'yyyy-MM-dd') AS date,
             try_cast(1.00005 AS decimal(18,4)) AS half_up,
             try_cast(1e20 AS decimal(18,4)) AS too_large,
             length('abc') AS n, substr('abcdef', 2, 3) AS cut, try_parse_json('{') AS broken"""
    ).first()
    assert row.bad_date is None and row.too_large is None and row.broken is None
    assert row.date == datetime.date(2026, 1, 2)
    assert row.half_up == decimal.Decimal("1.0001")
    assert (row.n, row.cut) == (3, "bcd")


def test_workspace_is_in_the_shared_folder(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark, "x").startswith(shared.rstrip("/"))
    assert workspace(spark, "x") != workspace(spark, "x")
    assert workspace(spark, "x", root=folder).startswith(folder)
