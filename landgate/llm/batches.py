"""Per-text measures over a table: Arrow batches in, Arrow batches out, nothing shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def measured(
    df: DataFrame,
    measure: Callable[[pa.Array], dict],
    schema: str,
    column: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` and those that ``measure`` finds for the texts of ``column``.

    Only these columns are read, so others may have any names. ``schema`` names the measures.
    """
    own = StructType.fromDDL(schema)
    out = StructType([*df.select(*keep).schema.fields, *own.fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            found = measure(batch.column(len(keep)))
            kept = [batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
            got = [pa.array(found[f.name], type=arrow.field(f.name).type) for f in own.fields]
            yield pa.RecordBatch.from_arrays([*kept, *got], schema=arrow)

    text = df[column].cast("string").alias("_text")
    return df.select(*keep, text).mapInArrow(run, out)


def kept_rows(df: DataFrame, verdict: Callable[[pa.Array], list], column: str = "text") -> DataFrame:
    """The rows of ``df`` for whose texts ``verdict`` is true, with all their columns."""
    place = df.columns.index(column)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(verdict(batch.column(place)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def in_groups(column: pa.Array, texts: int = 256, characters: int = 1 << 20) -> Iterator[list[str]]:
    """The texts of a column, null as empty, in lists of bounded size; a longer text is alone in its list."""
    group, size = [], 0
    for text in column:
        text = text.as_py() or ""
        if group and (size + len(text) > characters or len(group) >= texts):
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group
