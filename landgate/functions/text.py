"""Long texts cut into rows and put together again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_text(df: DataFrame, column: str, size: int = 4000) -> DataFrame:
    """One row per ``size`` characters: ``chunk_no`` from 1 and ``chunk``; other columns repeat.

    An empty text is one empty chunk, a NULL text one NULL chunk.
    """
    if size < 1:
        raise ValueError("size must be positive")
    text = F.col(column)
    last = F.greatest(F.lit(0), F.ceil(F.length(text) / size).cast("int") - 1)
    chunks = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * size + 1, F.lit(size))
    )
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.posexplode(chunks).alias("_i", "chunk")).select(
        *others, (F.col("_i") + 1).alias("chunk_no"), "chunk"
    )


def join_lines(
    df: DataFrame,
    by: str = "file",
    order: str = "line_no",
    value: str = "value",
    separator: str = "\n",
) -> DataFrame:
    """(by, text): the values of each group joined in order.

    The joined text is one value of the result, so a group is as large as that value may be.
    """
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    joined = F.expr(f"listagg(`{value}`, '{quoted}') WITHIN GROUP (ORDER BY `{order}`)")
    return df.groupBy(by).agg(joined.alias("text"))
