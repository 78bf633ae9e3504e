"""Versions in force at many instants at once.

``as_of`` answers one date with one filter. For a table of (identifier, date) a join on the identifier with the
two date comparisons as its rest would compare each asked date with every version of its instrument. Here a
version is cut into the aligned blocks of 1, 2, 4, .. days that make up its span, at most two of a size, and a
date looks up the one block of each size that holds it: a plain equi-join on identifier, size and block, in
which each matching pair meets exactly once, since the blocks of a span do not overlap.

Blocks multiply both sides, so they are for instruments of more than ``FEW_ROWS`` versions. A date of any other
instrument is compared with all its versions: a bounded number, and each row is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.operators.risk import MAX_IN_LIST

#: Versions in one block of one instrument from which on they are spread over several join keys.
SPREAD_ROWS = 100_000
#: Versions of one instrument up to which it is not cut into blocks.
FEW_ROWS = 1000
#: Instruments, or blocks, that are listed on the driver and sent to every task; of more the join is left to Spark.
LISTED = 50_000

_KEY = ("_id", "_size", "_block")
# The size of what is not cut into blocks, and a number above all sizes.
_WHOLE, _SIZES = -1, 64


def _days(date: Column, first) -> Column:
    return F.datediff(date.cast("date"), F.lit(first))


def _blocks(first: Column, last: Column, sizes: int) -> Column:
    """The aligned blocks (size as a power of two, number) that make up the days ``first`` to ``last``.

    At each size the blocks that lie in the span run from ``low`` to ``high``; those at an end that are no half
    of a larger block in the span belong to the cover.
    """

    def at(size: Column) -> Column:
        width = F.pow(F.lit(2.0), size).cast("long")
        low = F.ceil(first / width).cast("long")
        high = F.floor((last + 1) / width).cast("long")  # the first block that is not in the span
        left = F.when((low < high) & (low % 2 == 1), low)
        right = F.when((low < high) & (high % 2 == 1), high - 1)
        return F.array(*[F.struct(size.alias("size"), n.alias("block")) for n in (left, right)])

    cover = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(sizes)), at))
    return F.filter(cover, lambda b: b["block"].isNotNull())


def _listed(rows: DataFrame) -> DataFrame | None:
    """``rows`` as a list for every task, or as they are if there are many; None if there are none."""
    found = rows.take(LISTED + 1)
    if len(found) > LISTED:
        return rows
    return F.broadcast(rows.sparkSession.createDataFrame(found, rows.schema)) if found else None


def _known(rows: DataFrame, listed: DataFrame | None, keys: tuple[str, ...], value: str) -> DataFrame:
    if listed is None:
        return rows.withColumn(value, F.lit(None))
    return rows.join(listed, list(keys), "left")


def as_of_pairs(
    df: DataFrame,
    asked: DataFrame,
    identifier: str = "identifier",
    date: str = "date",
    spread_rows: int = SPREAD_ROWS,
) -> DataFrame:
    """Each row of ``asked`` with every row of ``df`` in force on its date; both effective dates count.

    ``asked`` holds an identifier and a date; its columns come out with ``asked_`` before their names, then
    those of ``df``. Repeated rows on either side pair as in any join; rows without identifier or date, and
    versions without a start or end, are in no pair. Versions are cut to the asked time first, so an open end
    costs no more than a closed one. Where a block of one instrument holds more than ``spread_rows`` versions
    they are dealt to several keys by their plain columns, so that a task run again deals them alike, and only
    the dates asked for that block are copied to each. Instruments of many versions and crowded blocks are counted
    at once; the pairs are found when the result is read.
    """
    span = asked.agg(F.min(F.col(date).cast("date")), F.max(F.col(date).cast("date"))).first()
    first, last = span
    named = asked.select(*[F.col(c).alias(f"asked_{c}") for c in asked.columns])
    if first is None:  # nothing to look up
        return named.limit(0).join(df.limit(0), F.col(f"asked_{identifier}") == F.col(identifier))
    days = (last - first).days
    sizes = days.bit_length()

    # Counted without the ends, which a table may have to compute; a number too high does no harm.
    starts, ends = F.col("effective_start_date"), F.col("effective_end_date")
    begun = df.filter(F.col(identifier).isNotNull() & (starts <= F.lit(last)))
    many = _listed(
        begun.groupBy(F.col(identifier).alias("_id"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > min(FEW_ROWS, spread_rows))
    )

    plain = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)
    ]
    # The mark needs all plain columns; it is only read, and they only shuffled, where there are crowded blocks.
    versions = begun.filter((ends >= F.lit(first)) & (starts <= ends)).select(
        F.col(identifier).alias("_id"),
        F.greatest(_days(starts, first), F.lit(0)).alias("_from"),
        F.least(_days(ends, first), F.lit(days)).alias("_to"),
        F.xxhash64(*plain).alias("_mark"),
        *[F.col(f"`{c}`").alias(f"_v{i}") for i, c in enumerate(df.columns)],
    )
    cover = _blocks(F.col("_from").cast("long"), F.col("_to").cast("long"), sizes)
    whole = F.array(F.struct(F.lit(_WHOLE).alias("size"), F.lit(0).cast("long").alias("block")))

    def cut(rows: DataFrame) -> DataFrame:
        return (
            _known(rows, many, ("_id",), "_n")
            .withColumn("_b", F.explode(F.when(F.col("_n").isNull(), whole).otherwise(cover)))
            .select("*", F.col("_b.size").alias("_size"), F.col("_b.block").alias("_block"))
        )

    # The few blocks with very many versions, which only instruments with as many can have; counted with partial
    # sums, from the narrow columns.
    crowded = None
    if many is not None:
        most = many.filter(F.col("_n") > spread_rows).select("_id")
        ids = [r["_id"] for r in most.take(MAX_IN_LIST + 1)]
        if ids:
            listed = len(ids) <= MAX_IN_LIST
            some = versions.filter(F.col("_id").isin(ids)) if listed else versions.join(most, "_id", "left_semi")
            crowded = _listed(
                cut(some)
                .groupBy(*_KEY)
                .agg(F.count(F.lit(1)).alias("_held"))
                .filter(F.col("_held") > spread_rows)
                .select(*_KEY, F.ceil(F.col("_held") / spread_rows).cast("int").alias("_parts"))
            )

    day = _days(F.col(f"asked_{date}"), first)
    lookups = named.filter(F.col(f"asked_{identifier}").isNotNull() & F.col(f"asked_{date}").isNotNull()).select(
        F.col(f"asked_{identifier}").alias("_id"),
        day.alias("_day"),
        *[F.col(f"`{c}`").alias(f"_a{i}") for i, c in enumerate(named.columns)],
    )
    levels = F.when(F.col("_n").isNull(), F.array(F.lit(_WHOLE))).otherwise(F.sequence(F.lit(0), F.lit(sizes)))
    block = F.floor(F.col("_day") / F.pow(F.lit(2.0), F.col("_size"))).cast("long")
    copied = (
        _known(lookups, many, ("_id",), "_n")
        .withColumn("_size", F.explode(levels))
        .withColumn("_block", F.when(F.col("_size") == _WHOLE, F.lit(0)).otherwise(block))
    )
    dealt = cut(versions)
    part = F.col("_size")  # which of the block's keys, and its size
    if crowded is not None:
        parts = F.coalesce("_parts", F.lit(1))
        dealt = _known(dealt, crowded, _KEY, "_parts").withColumn("_deal", F.pmod("_mark", parts).cast("int"))
        copied = _known(copied, crowded, _KEY, "_parts").withColumn("_deal", F.explode(F.sequence(F.lit(0), parts - 1)))
        part = part + F.col("_deal") * _SIZES
    # What is exploded is more than the planner's sizes say: left alone it could send the lookups whole through
    # the driver to every executor.
    return (
        copied.withColumn("_part", part)
        .join(dealt.withColumn("_part", part).hint("merge"), ["_id", "_part", "_block"])
        .filter(F.col("_day").between(F.col("_from"), F.col("_to")))
        .select(
            *[F.col(f"_a{i}").alias(c) for i, c in enumerate(named.columns)],
            *[F.col(f"_v{i}").alias(c) for i, c in enumerate(df.columns)],
        )
    )
