"""Results that later questions of a session use again instead of computing them anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgate.workspace import workspace


class Results:
    """Keeps results as files, found by what they compute and not by how they are named.

    A result asked for again is read, with the names of the new question. What is kept is a finished file in the
    shared folder, so an executor that is lost takes none of it along. Plans that read the same paths mean the
    same here: ``forget`` a result when its source has changed.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root
        self._kept: dict[int, list[tuple[DataFrame, DataFrame]]] = {}
        self._scalars: dict[int, list[tuple[DataFrame, object]]] = {}

    def get(self, df: DataFrame) -> DataFrame:
        """The rows of ``df``: computed and stored the first time, read after that."""
        found = _find(self._kept, df)
        if found is None:
            where = workspace(self.spark, "result", self.root)
            df.write.parquet(where)
            found = self.spark.read.schema(df.schema).parquet(where)
            self._kept.setdefault(df.semanticHash(), []).append((df, found))
        return found.toDF(*df.columns)

    def scalar(self, df: DataFrame):
        """The one value of a result of one column and at most one row, None without a row."""
        found = _find(self._scalars, df)
        if found is None:
            rows = df.limit(2).collect()
            if len(df.columns) != 1 or len(rows) > 1:
                raise ValueError("a scalar has one column and at most one row")
            found = (rows[0][0] if rows else None,)
            self._scalars.setdefault(df.semanticHash(), []).append((df, found))
        return found[0]

    def forget(self, df: DataFrame) -> None:
        """Compute ``df`` anew when it is asked for next; files of an earlier result stay for its readers."""
        for kept in (self._kept, self._scalars):
            own = kept.get(df.semanticHash(), [])
            own[:] = [(known, value) for known, value in own if not known.sameSemantics(df)]


def _find(kept: dict, df: DataFrame):
    # The hash has 32 bits, so it only finds candidates.
    return next((value for known, value in kept.get(df.semanticHash(), []) if known.sameSemantics(df)), None)
