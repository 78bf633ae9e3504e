"""Parsed records retyped and renamed to a target table's columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.schemas import TargetColumn


def conform(
    df: DataFrame, target: Sequence[TargetColumn], enforce_required: bool = True
) -> DataFrame:
    """Select exactly the target's columns, in its order.

    A value that does not fit its target type (a bad date, a number too large) becomes NULL; it
    does not fail the load, and ``nulled_metrics`` counts it. A missing required value does, before anything is committed: Spark
    keeps NOT NULL of a file table as a note only. Load stamps of one query are all equal.
    """
    return df.select(*[_fill(df, c, enforce_required).alias(c.name) for c in target])


def nulled_metrics(df: DataFrame, target: Sequence[TargetColumn]) -> list[Column]:
    """Aggregates: per target column that is retyped, the values that become NULL in it."""
    return [
        F.count_if(F.col(c.source).isNotNull() & _retype(df, c).isNull()).alias(f"nulled_{i}")
        for i, c in enumerate(target)
        if not c.is_stamp and c.type not in ("string", "variant")
    ]


def nulled_counts(metrics: dict[str, int], target: Sequence[TargetColumn]) -> dict[str, int]:
    """What ``nulled_metrics`` found, by column name."""
    found = {c.name: metrics.get(f"nulled_{i}") for i, c in enumerate(target)}
    return {name: n for name, n in found.items() if n is not None}


def _fill(df: DataFrame, column: TargetColumn, enforce_required: bool) -> Column:
    value = _retype(df, column)
    if column.required and enforce_required:
        missing = F.raise_error(F.lit(f"required column {column.name} is NULL"))
        return F.when(value.isNull(), missing.cast(column.type)).otherwise(value)
    return value


def _retype(df: DataFrame, column: TargetColumn) -> Column:
    if column.is_stamp:
        return F.current_timestamp().cast(column.type)
    value = F.col(column.source)
    if column.pattern is not None:
        return F.try_to_date(value, column.pattern)
    if column.type == "variant":
        kind = df.select(value).schema[0].dataType
        return value if isinstance(kind, T.VariantType) else F.to_variant_object(value)
    return value.try_cast(column.type)
