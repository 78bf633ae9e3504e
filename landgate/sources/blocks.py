"""Order-preserving reads of text files that are too large for one task.

Spark cuts a large file into splits and hands each to a task. ``read_pieces`` keeps, next to every
piece of text, the split it came from and its place there, which is enough to rebuild any running
value over the file in two levels: inside a split, then over the short list of splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landgate.workspace import workspace

# Files up to this size are read whole by one task; larger ones are read in splits.
WHOLE_FILE_LIMIT = 64 << 20

BLOCK = ("file", "block")


def read_pieces(
    spark: SparkSession, path: str, separator: str, larger_than: int
) -> DataFrame:
    """(file, block, id, file_size, value): the pieces between separators.

    ``id`` counts up inside a block without gaps. It depends on how the scan is planned, so a result
    read more than once has to be ``stored`` first.
    """
    return (
        spark.read.option("lineSep", separator)
        .text(path)
        .filter(F.col("_metadata.file_size") > larger_than)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            F.col("_metadata.file_size").alias("file_size"),
            "value",
        )
    )


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, the same for every later pass."""
    path = workspace(df.sparkSession, "pieces")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_files(spark: SparkSession, path: str, up_to: int) -> DataFrame:
    """(file, value): small files, each as one value."""
    return (
        spark.read.text(path, wholetext=True)
        .filter(F.col("_metadata.file_size") <= up_to)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )


def before(total: str | Column) -> Column:
    """Sum of ``total`` over the earlier blocks of the same file; for tables of one row per block."""
    earlier = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(total).over(earlier), F.lit(0))
