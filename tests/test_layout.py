import datetime

import pytest
from pyspark.sql import functions as F

from landgate.operators.layout import curve_key, files_touched, interleaved
from landgate.operators.tables import clustered

KEYS = ("file_name", "effective_end_date", "identifier_type", "asset_class")


@pytest.fixture(scope="module")
def rows(spark):
    # Four keys that do not follow from each other; one end date holds a third of the rows.
    mark = F.xxhash64("id")
    return spark.range(60000).select(
        F.col("id").alias("n"),
        F.format_string("landing/part-%05d.json", F.pmod(mark, F.lit(400))).alias("file_name"),
        F.when(F.col("id") % 3 == 0, F.lit(datetime.date(9999, 12, 31)))
        .otherwise(F.date_add(F.lit(datetime.date(2020, 1, 1)), F.pmod(F.shiftright(mark, 12), F.lit(900)).cast("int")))
        .alias("effective_end_date"),
        F.concat(F.lit("T"), F.pmod(F.shiftright(mark, 24), F.lit(16)).cast("string")).alias("identifier_type"),
        F.concat(F.lit("class "), F.pmod(F.shiftright(mark, 36), F.lit(16)).cast("string")).alias("asset_class"),
    )


def touched(spark, df, folder):
    df.write.parquet(folder)
    return {r.key: (r.files, r.touched) for r in files_touched(spark.read.parquet(folder), KEYS).collect()}


def test_all_keys_prune_where_range_order_prunes_one(spark, rows, folder):
    curve = touched(spark, interleaved(rows, KEYS, partitions=256), f"{folder}/curve")
    ranged = touched(spark, clustered(rows, KEYS, [], partitions=256), f"{folder}/range")
    for key in KEYS:
        files, n = curve[key]
        assert files > 200 and n < 0.5 * files, (key, curve)
    assert ranged["file_name"][1] < 8
    for key in KEYS[2:]:
        assert ranged[key][1] > 0.9 * ranged[key][0]
        assert curve[key][1] < 0.5 * ranged[key][1]


def test_layout_keeps_every_row_and_column(rows):
    out = interleaved(rows, KEYS, partitions=8)
    assert out.columns == rows.columns
    assert out.exceptAll(rows).count() == 0 and out.count() == 60000


def test_the_curve_follows_each_key_alone(spark):
    df = spark.createDataFrame([(i, f"ID{i:04d}", i / 7, i % 2 == 1) for i in range(500)], "i int, s string, d double, b boolean")
    for key in ("i", "s", "d"):
        places = [r[0] for r in df.select(curve_key(df, [key]).alias("p"), "i").orderBy("i").select("p").collect()]
        assert places == sorted(places) and len(set(places)) == 64
    assert len({r[0] for r in df.select(curve_key(df, ["b"])).collect()}) == 2


def test_crowds_nulls_and_empty_tables(spark):
    same = spark.range(4000).select(F.lit("x").alias("a"), F.lit(None).cast("date").alias("b"), F.col("id").alias("n"))
    sizes = [r[1] for r in interleaved(same, ["a", "b"], ["n"], partitions=8).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500
    empty = same.limit(0)
    assert interleaved(empty, ["a", "b"], ["n"], partitions=4).count() == 0
    clash = spark.range(9).select("id", F.col("id").alias("_place"), F.lit("x").alias("_Place_"))
    assert sorted(interleaved(clash, ["id"], partitions=2).collect()) == sorted(clash.collect())
    mixed = spark.createDataFrame([("é", 1), (None, 2), ("", 3), ("z" * 50, 4), ("z" * 50, 4)], "a string, n int")
    assert sorted(map(str, interleaved(mixed, ["a"], partitions=2).collect())) == sorted(map(str, mixed.collect()))


def test_what_has_no_order_is_refused(spark):
    df = spark.range(3).select(F.array("id").alias("a"))
    with pytest.raises(ValueError, match="no order"):
        curve_key(df, ["a"])
    with pytest.raises(ValueError, match="62 bits"):
        curve_key(spark.range(3), ["id"] * 11)
