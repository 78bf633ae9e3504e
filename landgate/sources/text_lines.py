"""Text files as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgate.sources.blocks import (
    BLOCK,
    WHOLE_FILE_LIMIT,
    before,
    read_pieces,
    stored,
    whole_files,
)
from landgate.sources.landing import largest_file


def read_lines(
    spark: SparkSession, path: str, whole_file_limit: int = WHOLE_FILE_LIMIT
) -> DataFrame:
    """(file, line_no, value), numbered from 1 in each file; a closing newline adds no line."""
    lines = _lines_of_small_files(spark, path, whole_file_limit)
    if largest_file(spark, path) > whole_file_limit:
        lines = lines.unionByName(_lines_of_large_files(spark, path, whole_file_limit))
    return lines


def _lines_of_small_files(spark: SparkSession, path: str, limit: int) -> DataFrame:
    text = F.when(F.col("value") != "", F.regexp_replace("value", r"\n\z", ""))
    return whole_files(spark, path, limit).select(
        "file", F.posexplode(F.split(text, "\n")).alias("pos", "value")
    ).select("file", (F.col("pos") + 1).cast("bigint").alias("line_no"), "value")


def _lines_of_large_files(spark: SparkSession, path: str, limit: int) -> DataFrame:
    pieces = stored(read_pieces(spark, path, "\n", limit))
    # Ids are consecutive inside a block, so the number of a line follows from the first id of its
    # block and the lines in the blocks before: only one row per block is shuffled.
    blocks = (
        pieces.groupBy(*BLOCK)
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("lines"))
        .select(*BLOCK, (before("lines") - F.col("first_id") + 1).alias("shift"))
    )
    return pieces.join(blocks, list(BLOCK)).select(
        "file", (F.col("id") + F.col("shift")).alias("line_no"), "value"
    )
