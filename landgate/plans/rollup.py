"""Answers of a semantic model from partial aggregates, wherever these give the same figures.

A roll-up holds, per combination of the finest dimensions, what can be merged: counts, sums, smallest and largest values. One
counted-distinct column becomes a further key, so its values are kept and counted exactly at any coarser grain. A
question is answered from it if all its dimensions, metrics and the columns of its filter are there, and from the table
otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.plans.semantic import SemanticModel, query
from landgate.workspace import workspace

#: How the measures are written as metrics of a model.
WRITTEN = {
    "count": "count({})", "sum": "sum({})", "avg": "avg({})", "min": "min({})", "max": "max({})",
    "distinct": "count(DISTINCT {})",
}


@dataclass(frozen=True)
class Rollup:
    """``rows`` are the partial aggregates; ``measures`` maps metrics to (kind, expression)."""

    model: SemanticModel
    rows: DataFrame
    dimensions: tuple[str, ...]
    filters: tuple[str, ...]
    measures: Mapping[str, tuple[str, str]]
    types: Mapping[str, str]

    def answers(self, dimensions: Sequence[str], metrics: Sequence[str], where: str | Column | None) -> bool:
        known = {d.lower() for d in self.dimensions}
        return (
            {d.lower() for d in dimensions} <= known
            and bool(metrics)
            and {m.lower() for m in metrics} <= {m.lower() for m in self.measures}
            and (where is None or self._can_filter(where))
        )

    def _can_filter(self, where: str | Column) -> bool:
        # Only dimensions that are columns of the table mean the same in a filter on either. A select
        # would not do: filters may also name what it leaves out.
        plain = T.StructType([self.rows.schema[c] for c in self.filters])
        try:
            self.rows.sparkSession.createDataFrame([], plain).filter(where)
        except AnalysisException:
            return False
        return True


def _parts(name: str, kind: str, expr: str) -> list[Column]:
    c = F.expr(expr)
    return {
        "count": [F.count(c).alias(f"{name}__n")],
        "sum": [F.sum(c).alias(f"{name}__sum")],
        "avg": [F.sum(c).alias(f"{name}__sum"), F.count(c).alias(f"{name}__n")],
        "min": [F.min(c).alias(f"{name}__min")],
        "max": [F.max(c).alias(f"{name}__max")],
        "distinct": [],
    }[kind]


def _merged(name: str, kind: str, type_: str) -> Column:
    n, total = F.sum(f"`{name}__n`"), F.sum(f"`{name}__sum`")
    value = {
        "count": lambda: F.coalesce(n, F.lit(0)),
        "sum": lambda: total,
        "avg": lambda: F.try_divide(total, n),
        "min": lambda: F.min(f"`{name}__min`"),
        "max": lambda: F.max(f"`{name}__max`"),
        "distinct": lambda: F.count_distinct(F.col("_distinct")),
    }[kind]()
    return value.cast(type_).alias(name)


def build_rollup(
    model: SemanticModel,
    df: DataFrame,
    dimensions: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
    path: str | None = None,
) -> Rollup:
    """Aggregate ``df`` once by ``dimensions`` and store it, in ``path`` or the shared folder.

    ``measures`` says of metrics of the model what they measure, as (kind, expression) with a kind of ``WRITTEN``. One that
    does not mean what the model's metric means is refused, as are two expressions to be
    counted distinct, whose combinations could be as many as the rows. Sums of fractions are added in
    another order than over the table, as they are from one run of Spark to the next.
    """
    metrics = {m.name: m for m in model.metrics}
    types = {}
    for name, (kind, expr) in measures.items():
        if kind not in WRITTEN or name not in metrics:
            raise ValueError(f"{name}: no metric of {model.name}, or {kind!r} can't be merged")
        asked = df.agg(metrics[name].column())
        if not asked.sameSemantics(df.agg(F.expr(WRITTEN[kind].format(expr)))):
            raise ValueError(f"{name}: {metrics[name].expr} is not {WRITTEN[kind].format(expr)}")
        types[name] = asked.dtypes[0][1]
    counted = {expr for kind, expr in measures.values() if kind == "distinct"}
    if len(counted) > 1:
        raise ValueError(f"more than one expression counted distinct: {sorted(counted)}")
    keys = model.pick(dimensions, model.dimensions) + [F.expr(e).alias("_distinct") for e in counted]
    parts = [c for name, (kind, expr) in measures.items() for c in _parts(name, kind, expr)]
    where = path or workspace(df.sparkSession, "rollup")
    grouped = df.groupBy(*keys)
    (grouped.agg(*parts) if parts else df.select(*keys).distinct()).write.parquet(where)
    items = {i.name.lower(): i for i in model.dimensions}
    own = [items[d.lower()] for d in dimensions]
    plain = tuple(i.name for i in own if i.expr.strip("`").lower() == i.name.lower() and i.name in df.columns)
    return Rollup(
        model, df.sparkSession.read.parquet(where), tuple(i.name for i in own), plain, dict(measures), types
    )


def answer(
    rollup: Rollup,
    df: DataFrame,
    dimensions: Sequence[str],
    metrics: Sequence[str],
    where: str | Column | None = None,
) -> DataFrame:
    """Metrics per distinct combination of dimensions, from the roll-up if it can tell, else from ``df``."""
    if not rollup.answers(dimensions, metrics, where):
        return query(rollup.model, df, dimensions, metrics=metrics, where=where)
    rows = rollup.rows if where is None else rollup.rows.filter(where)
    names = {m.lower(): m for m in rollup.measures}
    dims = {d.lower(): d for d in rollup.dimensions}
    merged = [_merged(names[m.lower()], rollup.measures[names[m.lower()]][0], rollup.types[names[m.lower()]]) for m in metrics]
    return rows.groupBy(*[F.col(f"`{dims[d.lower()]}`") for d in dimensions]).agg(*merged)
