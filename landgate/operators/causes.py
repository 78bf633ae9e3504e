"""Why a record was rejected: the first fault of its text against the declared schema.

A cause is an expression over the rejected text on built-in functions, evaluated for rejected rows only, so
it can be counted in the pass that judges the records. The causes of a schema are a fixed list: ``STRAY`` (the
text is no object), ``SYNTAX`` (it starts as one but is no JSON, or holds a key twice), ``TYPE`` with the path
of the first field, in the schema's order, whose value can't be of the declared type, and ``OTHER`` for what
this strict reading finds nothing against. Elements of arrays share the path ``field[]``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.schemas import CORRUPT

STRAY, SYNTAX, TYPE, OTHER = "stray text", "syntax", "wrong type", "other"
#: Texts that the JSON reader takes for floating-point numbers.
NUMBER_TEXTS = ("NaN", "Infinity", "+Infinity", "-Infinity", "+INF", "-INF", "INF")
_NUMBERS = "BIGINT|DECIMAL.*|DOUBLE|FLOAT"
_BITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31}


def _unlike(value: str, kinds: str) -> str:
    """SQL: whether a value is there, is not null, and is of none of these types."""
    return f"NOT coalesce(schema_of_variant({value}), 'VOID') RLIKE '^(VOID|{kinds})$'"


def _faults(root: str, at: str, fields: list[T.StructField], path: str, depth: int) -> Iterator[tuple[str, str]]:
    """(SQL that is true for a value at fault, path) for all fields that can be, in the schema's order. ``at`` is
    the place of the object under the VARIANT ``root``."""
    for field in fields:
        if set(field.name) & set("'\"\\"):
            raise ValueError(f"a quoted field name has no path: {field.name}")
        yield from _fault(root, f'{at}["{field.name}"]', field.dataType, f"{path}{field.name}", depth)


def _fault(root: str, at: str, kind: T.DataType, path: str, depth: int) -> Iterator[tuple[str, str]]:
    def read(as_type: str) -> str:
        return f"try_variant_get({root}, '{at}', '{as_type}')"

    value = read("variant")
    if isinstance(kind, T.StructType):
        yield _unlike(value, "OBJECT.*"), path
        yield from _faults(root, at, kind.fields, f"{path}.", depth)
    elif isinstance(kind, T.ArrayType):
        yield _unlike(value, "ARRAY.*"), path
        element = f"e{depth}"
        for fault, own in _fault(element, "$", kind.elementType, f"{path}[]", depth + 1):
            yield f"coalesce(exists({read('array<variant>')}, {element} -> {fault}), false)", own
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        texts = ", ".join(f"'{t}'" for t in NUMBER_TEXTS)
        text = f"schema_of_variant({value}) = 'STRING' AND {read('string')} IN ({texts})"
        yield f"({_unlike(value, _NUMBERS)} AND NOT coalesce({text}, false))", path
    elif type(kind) in _BITS:
        least = -(1 << _BITS[type(kind)])
        yield f"({_unlike(value, 'BIGINT')} OR NOT coalesce({read('bigint')}, 0) BETWEEN {least} AND {-least - 1})", path
    elif isinstance(kind, T.LongType):
        yield _unlike(value, "BIGINT"), path
    elif isinstance(kind, T.DecimalType):
        yield _unlike(value, f"{_NUMBERS}|STRING"), path
    elif isinstance(kind, T.BooleanType):
        yield _unlike(value, "BOOLEAN"), path


def _declared(schema: T.StructType, corrupt: str) -> list[T.StructField]:
    return [f for f in schema.fields if f.name != corrupt]


def cause_numbers(schema: T.StructType, corrupt: str = CORRUPT) -> list[tuple[str, str | None]]:
    """(cause, path) of every cause that a record of the schema can have; the place is its number."""
    paths = [path for _, path in _faults("v", "$", _declared(schema, corrupt), "", 0)]
    return [(STRAY, None), (SYNTAX, None), (OTHER, None), *((TYPE, path) for path in paths)]


def cause_number(schema: T.StructType, corrupt: str = CORRUPT) -> Column:
    """The number of a rejected row's cause, NULL for good rows."""
    faults = [fault for fault, _ in _faults("v", "$", _declared(schema, corrupt), "", 0)]
    judged = " ".join(f"WHEN {fault} THEN {3 + i}" for i, fault in enumerate(faults))
    # The lambda's variable stands for the parsed text, which is so parsed once and not once a field.
    parsed = f"transform(array(try_parse_json(`{corrupt}`)), v -> CASE WHEN v IS NULL THEN 1 {judged} ELSE 2 END)[0]"
    return F.expr(f"CASE WHEN `{corrupt}` IS NULL THEN NULL WHEN NOT startswith(ltrim(translate(`{corrupt}`, '\t\r\n', '   ')), '{{') THEN 0 ELSE {parsed} END")


def cause_metrics(schema: T.StructType, numbered: str) -> list[Column]:
    """Aggregates: the rejected rows of every cause, whose number stands in column ``numbered``."""
    return [F.count_if(F.col(numbered) == i).alias(f"cause_{i}") for i in range(len(cause_numbers(schema)))]


def cause_entries(schema: T.StructType, metrics: dict[str, int]) -> list[tuple[str, str | None, int]]:
    """(cause, path, records) from the metrics, causes without records left out."""
    names = cause_numbers(schema)
    return [(*name, metrics[f"cause_{i}"]) for i, name in enumerate(names) if metrics.get(f"cause_{i}")]


def reject_causes(parsed: DataFrame, schema: T.StructType, corrupt: str = CORRUPT) -> DataFrame:
    """(cause, path, records): how many records each cause rejected; causes without any are left out."""
    numbered = parsed.filter(F.col(corrupt).isNotNull()).select(cause_number(schema, corrupt).alias("number"))
    named = F.array(*[F.struct(F.lit(c).alias("cause"), F.lit(p).cast("string").alias("path")) for c, p in cause_numbers(schema, corrupt)])
    counted = numbered.groupBy("number").agg(F.count(F.lit(1)).alias("records"))
    return counted.select(F.get(named, F.col("number")).alias("named"), "records").select("named.*", "records")


def explained(invalid: DataFrame, schema: T.StructType, corrupt: str = CORRUPT) -> DataFrame:
    """Rejected rows with (cause, path, place): the place is the character, from 0, at which a text that is no
    JSON stops to be any; NULL otherwise."""

    @F.pandas_udf("int")
    def place(texts: pd.Series) -> pd.Series:
        return texts.map(_first_fault).astype("Int32")

    names = cause_numbers(schema, corrupt)
    named = F.array(*[F.struct(F.lit(c).alias("cause"), F.lit(p).cast("string").alias("path")) for c, p in names])
    found = invalid.withColumn("_named", F.get(named, cause_number(schema, corrupt)))
    broken = F.when(F.col("_named.cause").isin(STRAY, SYNTAX), place(corrupt))
    return found.select(*invalid.columns, "_named.cause", "_named.path", broken.alias("place"))


def _first_fault(text: str | None) -> int | None:
    try:
        json.loads(text or "")
    except json.JSONDecodeError as fault:
        return fault.pos
    except RecursionError:
        return None
    return None
