"""What the columns of a table hold: exact distinct counts, frequent values and a sample of each.

Every column is brought to (column, value as text) and counted per value first. The counts per value are then
reduced per column, and what is kept of a column on the way is a few values, so the number of distinct values may grow
with the table without any task or the driver holding them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(type_: T.DataType) -> bool:
    """Whether values have an order and a hash."""
    if isinstance(type_, T.ArrayType):
        return comparable(type_.elementType)
    if isinstance(type_, T.StructType):
        return all(comparable(f.dataType) for f in type_.fields)
    return not isinstance(type_, (T.VariantType, T.MapType))


def _as_text(name: str, type_: T.DataType):
    c = F.col(f"`{name}`")
    return F.to_json(F.struct(c)) if isinstance(type_, (T.StructType, T.ArrayType)) else c.cast("string")


def count_values(df: DataFrame) -> DataFrame:
    """(name, value, n) of every value of every comparable column, nulls left out; values as text."""
    entries = [
        F.struct(F.lit(f.name).alias("name"), _as_text(f.name, f.dataType).alias("value"))
        for f in df.schema.fields
        if comparable(f.dataType)
    ]
    if not entries:
        return df.select(F.lit("").alias("name"), F.lit("").alias("value"), F.lit(0).cast("bigint").alias("n")).limit(0)
    return (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _firsts(counts: DataFrame, k: int, order: list, into: str) -> DataFrame:
    """The first ``k`` values per column; each task passes on no more than ``k`` of a column."""
    ranked = counts.withColumn("_at", F.row_number().over(Window.partitionBy("name").orderBy(*order)))
    kept = ranked.filter(F.col("_at") <= k).groupBy("name").agg(F.sort_array(F.collect_list(F.struct("_at", "value"))).alias("_kept"))
    return kept.select("name", F.col("_kept.value").alias(into))


def profile_values(df: DataFrame, frequent: int = 3, samples: int = 3) -> DataFrame:
    """Per comparable column: ``distinct`` (exact), its most ``frequent`` values, and ``samples`` of its values.

    Equally frequent values come in their own order. The sample is the values with the smallest md5, so it is
    the same however the table is split, takes rare values as readily as frequent ones, and that of two tables
    follows from the samples of both. A column of nulls has 0 values and empty lists. Values are told apart by
    their text.
    """
    counts = count_values(df)
    names = [f.name for f in df.schema.fields if comparable(f.dataType)]
    known = df.sparkSession.createDataFrame([(n,) for n in names], "name string")
    sizes = counts.groupBy("name").agg(F.count(F.lit(1)).alias("distinct"))
    common = _firsts(counts, frequent, [F.desc("n"), F.asc("value")], "frequent")
    sample = _firsts(counts, samples, [F.md5("value"), F.asc("value")], "samples")
    none = F.array().cast("array<string>")
    return (
        known.join(sizes, "name", "left")
        .join(common, "name", "left")
        .join(sample, "name", "left")
        .select(
            "name",
            F.coalesce("distinct", F.lit(0)).cast("bigint").alias("distinct"),
            F.coalesce("frequent", none).alias("frequent"),
            F.coalesce("samples", none).alias("samples"),
        )
    )
