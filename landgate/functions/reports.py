"""What a DataFrame looks like: one row per field, nested ones included."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _walk(schema: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[tuple]:
    for f in schema.fields:
        path = (*prefix, f.name)
        yield path, f.dataType.simpleString(), f.nullable
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(inner, T.StructType):
            yield from _walk(inner, path)


def schema_report(df: DataFrame) -> DataFrame:
    """(path, type, nullable) of every field."""
    rows = [(".".join(p), t, n) for p, t, n in _walk(df.schema)]
    return df.sparkSession.createDataFrame(rows, "path string, type string, nullable boolean")


def field_profile(df: DataFrame) -> DataFrame:
    """``schema_report`` with the number of rows in which each field has a value.

    The declared nullability says little for file sources, the counts do. All fields are counted
    in one pass; a field inside an array counts the rows with at least one element holding it.
    """
    fields = list(_walk(df.schema))
    counts = df.agg(
        *[F.count_if(_present(df.schema, p)).alias(f"c{i}") for i, (p, _, _) in enumerate(fields)]
    )
    rows = [
        F.struct(
            F.lit(".".join(p)).alias("path"),
            F.lit(t).alias("type"),
            F.lit(n).alias("nullable"),
            F.col(f"c{i}").alias("present"),
        )
        for i, (p, t, n) in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _present(schema: T.StructType, path: tuple[str, ...]) -> Column:
    return _present_in(F.col(f"`{path[0]}`"), schema[path[0]].dataType, path[1:])


def _present_in(value: Column, kind: T.DataType, path: tuple[str, ...]) -> Column:
    if not path:
        return value.isNotNull()
    if isinstance(kind, T.ArrayType):
        return F.coalesce(
            F.exists(value, lambda e: _present_in(e, kind.elementType, path)), F.lit(False)
        )
    return _present_in(value.getField(path[0]), kind[path[0]].dataType, path[1:])
