"""A small semantic model: named dimensions, facts and metrics over one table.

A model only names expressions; asking it for something builds an ordinary select or aggregation.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.plans.values import comparable, profile_values

DIMENSION, TIME_DIMENSION, FACT, METRIC = "dimension", "time_dimension", "fact", "metric"
LISTING = "name string, kind string, expression string, comment string"


@dataclass(frozen=True)
class Item:
    """``expr`` is SQL over the table's columns; a metric's is an aggregate."""

    name: str
    expr: str
    comment: str = ""
    kind: str = DIMENSION

    def column(self) -> Column:
        return F.expr(self.expr).alias(self.name)


@dataclass(frozen=True)
class VerifiedQuery:
    """A question the model is known to answer, and the SQL that answers it."""

    question: str
    sql: str


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str
    description: str = ""
    dimensions: tuple[Item, ...] = ()
    facts: tuple[Item, ...] = ()
    metrics: tuple[Item, ...] = ()
    verified: tuple[VerifiedQuery, ...] = field(default=())

    def __post_init__(self):
        names = [i.name for i in self.items()]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise ValueError(f"{self.name}: defined more than once: {sorted(twice)}")

    def items(self) -> tuple[Item, ...]:
        return (*self.dimensions, *self.facts, *self.metrics)

    def with_metric(self, name: str, expr: str, comment: str = "") -> SemanticModel:
        return replace(self, metrics=(*self.metrics, Item(name, expr, comment, METRIC)))

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2)

    @classmethod
    def from_json(cls, text: str) -> SemanticModel:
        raw = json.loads(text)
        for part in ("dimensions", "facts", "metrics"):
            raw[part] = tuple(Item(**i) for i in raw.get(part, ()))
        raw["verified"] = tuple(VerifiedQuery(**v) for v in raw.get("verified", ()))
        return cls(**raw)

    def validate(self, df: DataFrame) -> None:
        """Raise ``ValueError`` naming the first item that does not fit the table."""
        for item in self.items():
            try:
                if item.kind == METRIC:
                    df.agg(item.column())
                else:
                    df.select(item.column())
            except AnalysisException as e:
                raise ValueError(f"{self.name}.{item.name}: {e}") from e

    def pick(self, names: Sequence[str], among: Sequence[Item]) -> list[Column]:
        known = {i.name.lower(): i for i in among}
        missing = [n for n in names if n.lower() not in known]
        if missing:
            raise ValueError(f"{self.name} has no {missing}; known: {sorted(known)}")
        return [known[n.lower()].column() for n in names]


def _list(spark: SparkSession, items: Sequence[Item]) -> DataFrame:
    return spark.createDataFrame([(i.name, i.kind, i.expr, i.comment) for i in items], LISTING)


def list_dimensions(spark: SparkSession, model: SemanticModel) -> DataFrame:
    return _list(spark, model.dimensions)


def list_facts(spark: SparkSession, model: SemanticModel) -> DataFrame:
    return _list(spark, model.facts)


def list_metrics(spark: SparkSession, model: SemanticModel) -> DataFrame:
    return _list(spark, model.metrics)


def list_models(spark: SparkSession, models: Mapping[str, SemanticModel]) -> DataFrame:
    rows = [(m.name, m.table, m.description) for m in models.values()]
    return spark.createDataFrame(rows, "name string, table string, description string")


def query(
    model: SemanticModel,
    df: DataFrame,
    dimensions: Sequence[str],
    facts: Sequence[str] = (),
    metrics: Sequence[str] = (),
    where: str | Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows of dimensions and facts, or metrics per distinct combination of dimensions."""
    if facts and metrics:
        raise ValueError("ask for facts (rows) or for metrics (groups), not both")
    rows = df if where is None else df.filter(where)
    by = model.pick(dimensions, model.dimensions)
    if metrics:
        answer = rows.groupBy(*by).agg(*model.pick(metrics, model.metrics))
    else:
        answer = rows.select(*by, *model.pick(facts, model.facts))
    return answer if limit is None else answer.limit(limit)


# --- drafting a model -----------------------------------------------------------------------


def kind_of(type_: T.DataType) -> str:
    if isinstance(type_, T.NumericType):
        return FACT
    if isinstance(type_, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return TIME_DIMENSION
    return DIMENSION


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: kind, type, rows, nulls, approximate distinct count, smallest and largest value.

    One aggregation over the table for all columns. Values without an order or a hash (VARIANT,
    maps) are only checked for nulls.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggregates.append(F.count_if(c.isNull()).alias(f"nulls_{i}"))
        if comparable(f.dataType):
            aggregates += [
                F.approx_count_distinct(c).alias(f"distinct_{i}"),
                F.min(c).cast("string").alias(f"low_{i}"),
                F.max(c).cast("string").alias(f"high_{i}"),
            ]
    one = df.agg(*aggregates)
    entries = []
    for i, f in enumerate(df.schema.fields):
        known = comparable(f.dataType)
        entries.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(kind_of(f.dataType)).alias("kind"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("rows"),
                F.col(f"nulls_{i}").alias("nulls"),
                (F.col(f"distinct_{i}") if known else F.lit(None).cast("bigint")).alias(
                    "approx_distinct"
                ),
                (F.col(f"low_{i}") if known else F.lit(None).cast("string")).alias("low"),
                (F.col(f"high_{i}") if known else F.lit(None).cast("string")).alias("high"),
            )
        )
    return one.select(F.inline(F.array(*entries)))


def draft_model(
    df: DataFrame,
    name: str,
    table: str,
    description: str = "",
    verified: Sequence[VerifiedQuery] = (),
    samples: int = 0,
) -> SemanticModel:
    """A first model of a table, one item per column, commented from ``profile_columns``.

    With ``samples`` the comments hold the exact number of values, that many frequent ones and as many samples
    (``profile_values``), each cut to 40 characters; that is a second aggregation, with a shuffle of
    all values, so it is asked for. The profiles have one row per column, so they are read on the driver whatever
    the table's size.
    """
    items: dict[str, list[Item]] = {DIMENSION: [], FACT: []}
    values = {r["name"]: r for r in profile_values(df, samples, samples).collect()} if samples else {}
    for row in profile_columns(df).collect():
        filled = 100.0 * (row["rows"] - row["nulls"]) / row["rows"] if row["rows"] else 0.0
        comment = f"{row['type']}, {filled:.1f}% filled"
        if row["name"] in values:
            seen = values[row["name"]]
            comment += f", {seen['distinct']} values from {row['low']} to {row['high']}"
            for what in ("frequent", "samples"):
                comment += f", {what}: {', '.join(v[:40] for v in seen[what])}"
        elif row["approx_distinct"]:
            comment += (
                f", about {row['approx_distinct']} values from {row['low']} to {row['high']}"
            )
        side = FACT if row["kind"] == FACT else DIMENSION
        items[side].append(Item(row["name"], f"`{row['name']}`", comment, row["kind"]))
    model = SemanticModel(
        name, table, description, tuple(items[DIMENSION]), tuple(items[FACT]), (), tuple(verified)
    )
    model.validate(df)
    return model
