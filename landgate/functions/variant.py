"""Semi-structured values: structs into VARIANT, typed leaves out of VARIANT or JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_variant(df: DataFrame, column: str) -> DataFrame:
    """Turn a struct, array or map column into VARIANT; a missing value stays NULL."""
    return df.withColumn(column, F.to_variant_object(column))


def variant_leaf(column: str | Column, path: str, type_: str) -> Column:
    """Typed value at ``path``; NULL where the path is missing or the value has another type."""
    column = F.col(column) if isinstance(column, str) else column
    return F.try_variant_get(column, path, type_)


def variant_fields(
    df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Select ``keep`` columns and, per ``fields`` entry ``name: (path, type)``, one typed leaf."""
    leaves = [variant_leaf(column, path, type_).alias(n) for n, (path, type_) in fields.items()]
    return df.select(*keep, *leaves)


def json_fields(
    df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], keep: tuple[str, ...] = ()
) -> DataFrame:
    """``variant_fields`` over JSON text; text that is no JSON gives NULL leaves.

    The text is parsed once per row, whatever the number of leaves.
    """
    parsed = df.select(*keep, F.try_parse_json(column).alias("_v"))
    return variant_fields(parsed, "_v", fields, keep)


def response_problems(df: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Warnings, error code and message out of service responses kept as JSON text."""
    fields = {
        "warnings": ("$.json_proto.warnings", "string"),
        "error_code": ("$.error_code", "string"),
        "error_message": ("$.message", "string"),
    }
    return json_fields(df, column, fields, keep)
