"""Where raw JSON records depart from a declared schema: which types each field is found with, and how often.

A record is reduced to its shape, the nested types of all its fields, inside the scan, and equal shapes are counted before
anything is shuffled. Only shapes, not records, are then taken apart into fields.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT, BROKEN = "$", "broken"
#: The kinds of JSON values that fit a declared type, as the gate judges them: text takes everything.
FITS = {
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType),
    "number": (T.FloatType, T.DoubleType, T.DecimalType, T.StringType),
    "string": (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType, T.StringType),
    "object": (T.StructType, T.MapType, T.StringType),
    "array": (T.ArrayType, T.StringType),
}
#: Everything up to the next fraction of a number: what stands outside of strings without a point, and whole strings.
FRACTION = r'\G((?:[^".]++|"(?:[^"\\]++|\\.)*+")*+)\.[0-9]++'
_TOKEN = re.compile(r"`(?:[^`]|``)*`|DECIMAL\(\d+,\s*\d+\)|[<>,]|: |[^<>,:`\s]+(?::(?! )[^<>,:`\s]+)*|\s+")


def _kind(name: str) -> str:
    if name.startswith("DECIMAL"):
        return "integer" if re.search(r",\s*0\)$", name) else "number"
    known = {
        "BIGINT": "integer", "TINYINT": "integer", "SMALLINT": "integer", "INT": "integer", "DOUBLE": "number",
        "FLOAT": "number", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "VARIANT": "mixed",
    }
    return known.get(name, name.lower())


def shape_fields(shape: str) -> list[tuple[str, str]]:
    """(path, kind) of every field of a shape such as ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``; elements are ``b[]``."""
    found, open_, at, names = [], [], ROOT, []
    tokens = [t for t in _TOKEN.findall(shape) if not t.isspace()]
    i = 0
    while i < len(tokens):
        token = tokens[i]
        if token in ("OBJECT", "ARRAY") and i + 1 < len(tokens) and tokens[i + 1] == "<":
            found.append((at, token.lower()))
            open_.append((token, at))
            at = f"{at}[]" if token == "ARRAY" else at
            i += 2
            continue
        if token == ">":
            _, at = open_.pop()
        elif token == ",":
            at = open_[-1][1]
        elif i + 1 < len(tokens) and tokens[i + 1] == ": ":
            base = open_[-1][1]
            at = token if base == ROOT else f"{base}.{token}"
            i += 2
            continue
        else:
            found.append((at, _kind(token)))
        i += 1
    return found


def declared_types(schema: T.DataType, path: str = ROOT, skip: str | None = None) -> dict[str, T.DataType]:
    """The paths of a schema with their types, named as those of the records."""
    own = {path: schema}
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            if f.name != skip:
                name = f.name if re.fullmatch(r"[A-Za-z_]\w*", f.name) else "`" + f.name.replace("`", "``") + "`"
                own |= declared_types(f.dataType, name if path == ROOT else f"{path}.{name}")
    elif isinstance(schema, T.ArrayType):
        own |= declared_types(schema.elementType, f"{path}[]")
    return own


def found_types(raw: DataFrame, text: str = "value") -> DataFrame:
    """(path, found, records): in how many records each field has each kind of value.

    Kinds are object, array, string, integer, number, boolean, null, and mixed for the elements of an array that are not all
    alike. The path of a record itself is ``$``; a text that is no JSON, or that names a field twice, is ``broken``
    there, as is a null. A number written with a fraction or an exponent is no integer, whatever its value, as for
    the reader; integers beyond 38 digits are numbers.
    """
    # The parser drops a fraction of zeros, so every fraction is made one that it keeps.
    kept = F.regexp_replace(F.col(f"`{text}`"), FRACTION, "$1.5")
    shapes = raw.select(
        F.coalesce(F.schema_of_variant(F.try_parse_json(kept)), F.lit(BROKEN)).alias("shape")
    ).groupBy("shape").agg(F.count(F.lit(1)).alias("n"))

    def fields(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [
                (path, kind, int(n))
                for shape, n in zip(part["shape"], part["n"], strict=True)
                for path, kind in ([(ROOT, BROKEN)] if shape == BROKEN else shape_fields(shape))
            ]
            yield pd.DataFrame(rows, columns=["path", "found", "n"])

    pieces = shapes.mapInPandas(fields, "path string, found string, n bigint")
    return pieces.groupBy("path", "found").agg(F.sum("n").alias("records"))


def schema_drift(raw: DataFrame, schema: T.StructType, text: str = "value", skip: str | None = None) -> DataFrame:
    """(path, declared, found, records, verdict) of raw records against their declared schema.

    Verdicts: ``fits``, ``null``, ``wrong type``, ``undeclared`` (also what lies inside of text or maps),
    ``broken``, and ``never seen`` for a declared field that no record has, with 0 records. ``skip`` names a top
    column that is none of the records.
    """
    declared = declared_types(schema, skip=skip)
    fitting = [(p, k) for p, t in declared.items() for k, types in FITS.items() if isinstance(t, types)]
    spark = raw.sparkSession
    names = spark.createDataFrame([(p, t.simpleString()) for p, t in declared.items()], "path string, declared string")
    fits = spark.createDataFrame(fitting, "path string, found string").withColumn("_fits", F.lit(True))
    judged = found_types(raw, text).join(names, "path", "full").join(fits, ["path", "found"], "left")
    verdict = (
        F.when(F.col("found").isNull(), "never seen")
        .when(F.col("found") == BROKEN, BROKEN)
        .when(F.col("declared").isNull(), "undeclared")
        .when(F.col("found") == "null", "null")
        .when(F.col("_fits"), "fits")
        .otherwise("wrong type")
    )
    return judged.select("path", "declared", "found", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"), verdict.alias("verdict"))


def common_types(found: DataFrame) -> DataFrame:
    """(path, type, records): the narrowest type that takes all that ``found_types`` has of a field.

    Integers widen to doubles, nulls to anything; kinds with nothing in common need VARIANT.
    """
    kinds = F.collect_set(F.when(~F.col("found").isin("null", BROKEN), F.col("found")))
    sole = F.element_at(F.sort_array("_kinds"), 1)
    type_ = (
        F.when(F.size("_kinds") == 0, "void")
        .when(F.size(F.array_except("_kinds", F.array(F.lit("integer"), F.lit("number")))) == 0,
              F.when(F.array_contains("_kinds", "number"), "double").otherwise("bigint"))
        .when((F.size("_kinds") > 1) | (sole == "mixed"), "variant")
        .otherwise(F.when(sole == "object", "struct").otherwise(sole))
    )
    one = found.groupBy("path").agg(kinds.alias("_kinds"), F.sum("records").alias("records"))
    return one.select("path", type_.alias("type"), "records")
