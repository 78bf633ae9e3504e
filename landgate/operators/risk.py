"""Questions over a versioned (SCD2) table of scenario risk metrics.

Every operator that aggregates or compares looks at current rows only, unless ``history=True``.
All of them are plain filters and aggregations, so date literals and id lists reach the scan and
each shuffle carries partial aggregates, not rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgate.schemas import OPEN_END

# Names of the metric, scenarios, percentiles and horizons as the data states them.
PHYSICAL_RISK = "phys_risk_score"
WORST_SCENARIO, WORST_PERCENTILE = "RCP 8.5", "P95"
BEST_SCENARIOS, BEST_PERCENTILE = ("RCP 4.5", "SSP1-2.6"), "P5"
HORIZONS = ("2030", "2050", "2100")

# Parts of a group that are ranked apart first.
SALTS = 64

# An IN list of this many literals still becomes one hash-set test pushed to the scan; a longer one
# would bloat the plan, so it turns into a semi join.
MAX_IN_LIST = 1000
# A longer list is broadcast only up to this many bytes of key text, counted on the driver where
# the list already lives; beyond it the join shuffles.
MAX_BROADCAST_BYTES = 32 << 20


def current(df: DataFrame) -> DataFrame:
    """Rows whose version is still open."""
    return df.filter(F.col("effective_end_date") == F.lit(OPEN_END).cast("date"))


def _scope(df: DataFrame, history: bool) -> DataFrame:
    return df if history else current(df)


def as_of(df: DataFrame, date: str) -> DataFrame:
    """Rows in force on ``date``; both effective dates count as in force."""
    day = F.lit(date).cast("date")
    return df.filter((F.col("effective_start_date") <= day) & (day <= F.col("effective_end_date")))


def history(df: DataFrame, identifier: str) -> DataFrame:
    """Version history of one instrument, oldest first.

    Dates and version repeat a lot; the further sort keys let the rows of one date be spread over
    several tasks of the range-partitioned sort.
    """
    shown = ("effective_start_date", "effective_end_date", "version")
    further = (
        "scenario_name", "scenario_year", "scenario_percentile", "metric_name_internal",
        "metric_value",
    )
    return (
        df.filter(F.col("identifier") == identifier)
        .orderBy(*shown, *[c for c in further if c in df.columns])
        .select("identifier", *shown)
    )


def latest(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Current rows at the newest as-of date, overall or per ``keys``.

    The newest dates come from a partial aggregation (one row per key) and are semi-joined back, so
    a key that owns a large share of the rows is never sorted in one task as a window would.
    """
    rows = current(df)
    if not keys:
        newest = rows.agg(F.max("as_of_date").alias("_newest"))
        return rows.filter(F.col("as_of_date") == newest.scalar())
    newest = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max("as_of_date").alias("_newest")
    )
    same = F.col("as_of_date") == F.col("_newest")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(newest, same, "left_semi")


def lookup(
    df: DataFrame, id_type: str, ids: Iterable[str] | DataFrame, history: bool = False
) -> DataFrame:
    """Batch lookup: rows of the given instruments.

    ``ids`` is a list, or a DataFrame whose first column holds the identifiers when they live in a
    table; then the join strategy is left to the size statistics.
    """
    rows = _scope(df, history).filter(F.col("identifier_type") == id_type)
    if not isinstance(ids, DataFrame):
        wanted = sorted({i for i in ids if i is not None})
        if len(wanted) <= MAX_IN_LIST:
            return rows.filter(F.col("identifier").isin(wanted))
        keys = df.sparkSession.createDataFrame([(i,) for i in wanted], "_id string")
        if sum(len(i.encode()) for i in wanted) <= MAX_BROADCAST_BYTES:
            keys = F.broadcast(keys)
    else:
        keys = ids.select(F.col(ids.columns[0]).alias("_id"))
    return rows.join(keys, F.col("identifier") == F.col("_id"), "left_semi")


def is_proxied() -> Column:
    return F.col("is_proxied") == "Y"


def proxied(df: DataFrame, history: bool = False) -> DataFrame:
    """Rows that are estimates rather than modelled values."""
    return _scope(df, history).filter(is_proxied())


def flag_proxied(df: DataFrame) -> DataFrame:
    """Add ``proxied_flag``; rows with no statement count as not proxied."""
    return df.withColumn("proxied_flag", F.coalesce(is_proxied(), F.lit(False)))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, over all versions."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count"))


def _exposure(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg("metric_value").alias("avg_risk"),
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("identifier").alias("instrument_count"),
    )


def of_metric(df: DataFrame, metric: str | None) -> DataFrame:
    return df if metric is None else df.filter(F.col("metric_name_internal") == metric)


def avg_by(
    df: DataFrame, keys: Sequence[str], metric: str | None = None, history: bool = False
) -> DataFrame:
    """Average value per keys, of one metric or of all, highest first, with record and instrument
    counts."""
    rows = of_metric(_scope(df, history), metric)
    return _exposure(rows, keys).orderBy(F.desc("avg_risk"), *keys)


def exposure_by(
    df: DataFrame, key: str, metric: str | None = None, history: bool = False
) -> DataFrame:
    """Number of instruments and average value per key."""
    return _exposure(of_metric(_scope(df, history), metric), [key])


def metric_breakdown(df: DataFrame, history: bool = False) -> DataFrame:
    """Counts, average and maximum per displayed metric name."""
    return (
        _scope(df, history)
        .groupBy("metric_name")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count_distinct("identifier").alias("instrument_count"),
            F.avg("metric_value").alias("avg_risk"),
            F.max("metric_value").alias("max_risk"),
        )
    )


def proxied_split(df: DataFrame, history: bool = False) -> DataFrame:
    """Modelled against proxied rows: counts, share of all rows in percent, average."""
    groups = _exposure(_scope(df, history), ["is_proxied"])
    # The window runs over one row per flag value, not over the table.
    total = F.sum("record_count").over(Window.partitionBy())
    return groups.withColumn("share_pct", 100.0 * F.col("record_count") / total)


def worst_case(df: DataFrame, history: bool = False) -> DataFrame:
    return _scope(df, history).filter(
        (F.col("scenario_name") == WORST_SCENARIO)
        & (F.col("scenario_percentile") == WORST_PERCENTILE)
    )


def best_case(
    df: DataFrame, scenarios: Sequence[str] = BEST_SCENARIOS, history: bool = False
) -> DataFrame:
    return _scope(df, history).filter(
        F.col("scenario_name").isin(list(scenarios))
        & (F.col("scenario_percentile") == BEST_PERCENTILE)
    )


def _column_name(prefix: str, value: str) -> str:
    return prefix + re.sub(r"[^0-9a-z]+", "_", value.lower()).strip("_")


def _side_by_side(
    df: DataFrame, column: str, values: Sequence[str], prefix: str = ""
) -> DataFrame:
    # Conditional maxima need one shuffle on the instrument; pivot() would first aggregate by
    # instrument and value and shuffle twice.
    return df.groupBy("identifier_type", "identifier").agg(
        *[
            F.max(F.when(F.col(column) == v, F.col("metric_value"))).alias(_column_name(prefix, v))
            for v in values
        ]
    )


def _one_below_the_other(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy("identifier_type", "identifier", column).agg(
        F.max("metric_value").alias("metric_value")
    )


def compare_scenarios(
    df: DataFrame,
    year: str,
    percentile: str,
    metric: str | None = None,
    scenarios: Sequence[str] | None = None,
    history: bool = False,
) -> DataFrame:
    """Instruments under several scenarios, at one year and one percentile.

    Named scenarios are columns, one row per instrument; without names every scenario is a row.
    """
    rows = of_metric(_scope(df, history), metric).filter(
        (F.col("scenario_year") == year) & (F.col("scenario_percentile") == percentile)
    )
    if scenarios is None:
        return _one_below_the_other(rows, "scenario_name")
    rows = rows.filter(F.col("scenario_name").isin(list(scenarios)))
    return _side_by_side(rows, "scenario_name", scenarios)


def compare_horizons(
    df: DataFrame,
    scenario: str,
    percentile: str,
    metric: str | None = None,
    years: Sequence[str] | None = None,
    history: bool = False,
) -> DataFrame:
    """Instruments over several years, under one scenario and one percentile.

    Named years are columns, one row per instrument; without names every year is a row.
    """
    rows = of_metric(_scope(df, history), metric).filter(
        (F.col("scenario_name") == scenario) & (F.col("scenario_percentile") == percentile)
    )
    if years is None:
        return _one_below_the_other(rows, "scenario_year")
    rows = rows.filter(F.col("scenario_year").isin(list(years)))
    return _side_by_side(rows, "scenario_year", years, prefix="y")


def top_risk(
    df: DataFrame,
    by: str,
    k: int,
    ties: Sequence[str] = ("identifier", "metric_name"),
    history: bool = False,
) -> DataFrame:
    """The ``k`` instruments with the highest values per group, ranked, each with its highest row.

    An instrument's best row is found by an aggregation that combines before the shuffle. Then the
    instruments of a group are ranked in SALTS parts, of which at most ``k`` rows go on to the
    group's ranking, so no task sorts a large group, whatever ``k`` is. ``ties`` should make the
    order unique.
    """
    low = F.struct(
        F.col("metric_value").isNull(), (-F.col("metric_value")).alias("v"), *(F.col(t) for t in ties)
    )
    rows = _scope(df, history).select(
        F.col(by).alias("_by"), F.col("identifier_type").alias("_type"), F.col("identifier").alias("_id"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), low.alias("_low"),
    )
    best = rows.groupBy("_by", "_type", "_id").agg(
        F.min_by("_row", "_low").alias("_row"), F.min("_low").alias("_low")
    )
    salt = F.pmod(F.xxhash64("_type", "_id"), F.lit(SALTS))
    part = Window.partitionBy("_by", salt).orderBy("_low")
    few = best.withColumn("_n", F.row_number().over(part)).filter(F.col("_n") <= k)
    rank = F.row_number().over(Window.partitionBy("_by").orderBy("_low"))
    return few.withColumn("risk_rank", rank).filter(F.col("risk_rank") <= k).select("_row.*", "risk_rank")


def instrument_profile(df: DataFrame, id_type: str, identifier: str) -> DataFrame:
    """All metrics of one instrument across scenarios and years."""
    return (
        lookup(df, id_type, [identifier])
        .select(
            "identifier", "scenario_name", "scenario_year", "scenario_percentile", "metric_name",
            "metric_value",
        )
        .orderBy("scenario_name", "scenario_year", "scenario_percentile", "metric_name")
    )


def instrument_question(
    df: DataFrame, id_type: str, identifier: str, scenario: str, year: str
) -> DataFrame:
    """All metrics of one instrument under one scenario and year; every percentile comes back."""
    return lookup(df, id_type, [identifier]).filter(
        (F.col("scenario_name") == scenario) & (F.col("scenario_year") == year)
    )


def proxied_report(df: DataFrame) -> DataFrame:
    return proxied(df).select(
        "identifier_type", "identifier", "metric_name", "metric_value", "is_proxied"
    )


def present(df: DataFrame, *columns: str, digits: int = 3) -> DataFrame:
    """Round scores for display; keep full precision everywhere before that."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
