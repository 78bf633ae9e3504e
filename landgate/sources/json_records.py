"""JSON records against a declared schema, rejected records kept.

All readers return the columns of the schema; its corrupt-record column is NULL for a good record
and holds the text of a rejected one. A missing or null field is good, an extra field is ignored, a
value of the wrong type or broken syntax rejects the record.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.schemas import CORRUPT
from landgate.sources.blocks import stored
from landgate.sources.documents import DOCUMENT_BYTES, cut_column, cut_documents
from landgate.workspace import workspace


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = True,
    granularity: str = "element",
    corrupt: str = CORRUPT,
) -> DataFrame:
    """Read line-delimited JSON, or files of JSON documents.

    Line-delimited files are split by Spark. Document files hold records, one after the other or in
    arrays, over any number of lines; ``granularity="element"`` judges each record by itself, and
    reads files of any size in splits. ``"document"`` rejects all records of a file together when
    one of them is bad; it takes a file as one array or record and reads it in one task.
    """
    if granularity not in ("element", "document"):
        raise ValueError(f"unknown granularity {granularity!r}")
    if multiline and granularity == "element":
        return _read_cut(cut_documents(spark, path), schema, corrupt)
    scan = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .option("multiLine", multiline)
        .json(path)
    )
    return _keep_all_columns_parsed(scan, corrupt)


def _read_cut(cut: DataFrame, schema: T.StructType, corrupt: str) -> DataFrame:
    """Judge cut texts (value, is_record), which are read twice.

    Records are written as lines, their line breaks as spaces, and read again: of Spark's JSON parsers
    only that of lines keeps number tokens in text fields as they are. The others are rejected as they are.
    """
    path = workspace(cut.sparkSession, "records")
    lines = cut.filter("is_record").select(F.translate("value", "\r\n", "  ").alias("value"))
    lines.write.text(path)
    records = read_json(cut.sparkSession, path, schema, multiline=False, corrupt=corrupt)
    columns = [F.col("value") if f.name == corrupt else F.lit(None).cast(f.dataType) for f in schema.fields]
    named = [c.alias(f.name) for c, f in zip(columns, schema.fields, strict=True)]
    return records.union(cut.filter("NOT is_record").select(*named))


def _keep_all_columns_parsed(scan: DataFrame, corrupt: str) -> DataFrame:
    """Tie the corrupt-record column to every other column.

    Spark parses only the columns a query uses, and a column that is not parsed cannot fail: the
    verdict on a record would change with the select list, and a query over the corrupt column
    alone is refused. The sum of null flags is never negative, so the condition always holds, but
    the optimizer has to keep its inputs.
    """
    nulls = sum((F.col(f"`{c}`").isNull().cast("int") for c in scan.columns if c != corrupt), F.lit(0))
    return scan.withColumn(corrupt, F.when(nulls >= 0, F.col(corrupt)))


def _judge(texts: DataFrame, column: str, schema: T.StructType, corrupt: str) -> DataFrame:
    """Parse one record per text. JSON null is no record and comes back rejected."""
    # With options given, the optimizer leaves the parsed schema whole.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_json(F.col(column), schema, options)
    # inline() is a border for the optimizer: a filter on the verdict stays above it, where pushing
    # it below a plain select would parse every record once to filter and again to read.
    rows = texts.select(F.col(column).alias("_text"), F.inline(F.array(parsed)))
    rejected = F.when(F.trim("_text") == "null", F.col("_text")).otherwise(F.col(corrupt))
    return rows.withColumn(corrupt, rejected).drop("_text")


def parse_records(
    df: DataFrame, column: str, schema: T.StructType, corrupt: str = CORRUPT
) -> DataFrame:
    """Parse a text column holding one JSON record per row.

    Blank text yields no record; NULL text a rejected record ``null``.
    """
    texts = df.select(F.coalesce(column, F.lit("null")).alias("_record"))
    return _judge(texts.filter(F.trim("_record") != ""), "_record", schema, corrupt)


def parse_documents(
    df: DataFrame, column: str, schema: T.StructType, corrupt: str = CORRUPT
) -> DataFrame:
    """Parse a text column holding JSON documents, cut and judged as document files are.

    NULL text is a rejected record ``null``.
    """
    with _document_batches(df.sparkSession):
        cut = stored(cut_column(df, column))
    return _read_cut(cut, schema, corrupt)


@contextmanager
def _document_batches(spark: SparkSession):
    """Hand Python workers batches bounded by their bytes, as documents may be of any length."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(DOCUMENT_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
