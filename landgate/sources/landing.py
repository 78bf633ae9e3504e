"""Landed file sets: writing one, and listing what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of every landed file; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def largest_file(spark: SparkSession, path: str) -> int:
    return list_landing(spark, path).agg(F.max("length")).first()[0] or 0


def batch_identity(spark: SparkSession, path: str) -> str:
    """A name for exactly these landed files: the same for the same paths, lengths and times of change,
    whatever order they are listed in."""
    marks = list_landing(spark, path).select(F.sha2(F.concat_ws("\n", "path", "length", F.unix_micros("modified")), 256).alias("mark"))
    # Sums of four 64-bit pieces of the marks, so one row is gathered and not one per file.
    pieces = [F.conv(F.substring("mark", 16 * i + 1, 16), 16, 10).cast("decimal(38,0)") for i in range(4)]
    row = marks.agg(F.count(F.lit(1)), *[F.sum(p) for p in pieces]).first()
    return "-".join(f"{int(v or 0):x}" for v in row)


def land(
    df: DataFrame, path: str, fmt: str, overwrite: bool = True, compression: str = "none"
) -> DataFrame:
    """Write ``df`` as landed files; returns their listing, each with its status.

    An existing landing is replaced, or kept and reported as an error.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.format(fmt).mode(mode).option("compression", compression).save(path)
    return list_landing(df.sparkSession, path).withColumn("status", F.lit("LANDED"))
