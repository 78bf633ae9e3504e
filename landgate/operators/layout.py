"""A file layout that lets a filter on any of several keys skip files.

Range order serves its first key alone: within one value of it the second key is sorted, but every file of a
table holds nearly all values of the third. Here each key is turned into its rank among a few hundred
quantiles of itself, and the bits of the ranks are interleaved along a Z-order curve, so that a file is
a narrow box in all keys. Ranks come from data, so a value that fills a third of the table takes a third of the
ranks and the others keep theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each key is cut into 2 ** BITS ranges of equally many rows.
BITS = 6
#: Bytes of a string behind the beginning that all its values share; as many as fit a positive long.
STRING_BYTES = 7


def _is_text(type_: T.DataType) -> bool:
    return isinstance(type_, (T.StringType, T.BinaryType))


def _number(name: str, type_: T.DataType, shared: int) -> Column:
    """A number in the order of the values; strings by the bytes that follow the shared ones."""
    c = F.col(f"`{name}`")
    if _is_text(type_):
        head = F.substring(F.hex(c), 2 * shared + 1, 2 * STRING_BYTES)
        return F.conv(F.rpad(head, 2 * STRING_BYTES, "0"), 16, 10).cast("bigint")
    if isinstance(type_, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(type_, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(type_, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(type_, T.BooleanType):
        return c.cast("int")
    if isinstance(type_, T.NumericType):
        return c.cast("double") if isinstance(type_, (T.DecimalType, T.FractionalType)) else c.cast("bigint")
    raise ValueError(f"column {name} of type {type_.simpleString()} has no order to lay rows out by")


def _shared_bytes(low: bytes | None, high: bytes | None) -> int:
    """All values between two lie under their common beginning."""
    n = 0
    for a, b in zip(low or b"", high or b"", strict=False):
        if a != b:
            break
        n += 1
    return n


def _rank(value: Column, cuts: Sequence[float], lo: int = 0, hi: int | None = None) -> Column:
    """How many cuts are at most the value, by halving; nulls, which ask for no range, come first."""
    hi = len(cuts) if hi is None else hi
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(value >= F.lit(cuts[mid]), _rank(value, cuts, mid + 1, hi)).otherwise(_rank(value, cuts, lo, mid))


def curve_key(df: DataFrame, by: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on the Z-order curve through the quantile ranks of ``by``.

    The quantiles come from sketches that are merged over the tasks; two small rows reach the driver,
    whatever the size of the table. An empty table and a column of nulls have one rank.
    """
    if not by or len(by) * bits > 62:
        raise ValueError("from one key to 62 bits of all keys together")
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [n for n in by if _is_text(types[n])]
    shared = dict.fromkeys(by, 0)
    if texts:
        ends = df.agg(*[
            f(F.col(f"`{n}`").cast("binary")).alias(f"{f.__name__}_{i}") for i, n in enumerate(texts) for f in (F.min, F.max)
        ]).first()
        shared |= {n: _shared_bytes(ends[f"min_{i}"], ends[f"max_{i}"]) for i, n in enumerate(texts)}
    numbers = [_number(n, types[n], shared[n]) for n in by]
    steps = [i / 2**bits for i in range(1, 2**bits)]
    sketches = df.agg(*[F.percentile_approx(c, steps, 100 * 2**bits).alias(f"q{i}") for i, c in enumerate(numbers)]).first()
    ranks = [_rank(c, sketches[i] or []) for i, c in enumerate(numbers)]
    place = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for rank in ranks:
            place = place * 2 + F.shiftright(rank, bit).bitwiseAND(1)
    return place


def interleaved(
    df: DataFrame, by: Sequence[str], spread: Sequence[str] = (), partitions: int | None = None, bits: int = BITS
) -> DataFrame:
    """``df`` partitioned and sorted along the curve through ``by``, ready to be written.

    ``spread`` are further range keys that cut a crowd of rows at one place of the curve, which would else be one
    task; without them the keys themselves serve. The input is read for the string ends, the sketches, the
    sample of the ranges and the rows.
    """
    taken, place = {c.lower() for c in df.columns}, "_place"
    while place in taken:
        place += "_"
    rows = df.withColumn(place, curve_key(df, by, bits))
    keys = [place, *by, *[c for c in spread if c not in by]]
    count = () if partitions is None else (partitions,)
    return rows.repartitionByRange(*count, *keys).sortWithinPartitions(*keys).drop(place)


def files_touched(written: DataFrame, by: Sequence[str], probes: int = 32) -> DataFrame:
    """How far a layout prunes: per key its files, and the mean number of them whose range holds a value.

    ``written`` is read from files. The values looked up are up to ``probes`` quantiles of each key, strings
    by their order above. What a reader skips by the smallest and largest value that parquet
    keeps per file is counted from the rows themselves.
    """
    types = {f.name: f.dataType for f in written.schema.fields}
    numbers = [_number(n, types[n], 0) for n in by]
    steps = [(i + 0.5) / probes for i in range(probes)]
    asked = written.agg(*[F.percentile_approx(c, steps, 100 * probes).alias(f"q{i}") for i, c in enumerate(numbers)]).first()
    files = written.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
        *[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(numbers) for f in (F.min, F.max)]
    )
    counts = [F.count(F.lit(1)).alias("files")]
    for i in range(len(by)):
        values = sorted(set(asked[i] or []))
        inside = [F.count_if(F.lit(v).between(F.col(f"min_{i}"), F.col(f"max_{i}"))) for v in values]
        counts.append((sum(inside, F.lit(0)) / F.lit(max(1, len(values)))).cast("double").alias(f"touched_{i}"))
    one = files.agg(*counts)
    entries = [F.struct(F.lit(n).alias("key"), "files", F.col(f"touched_{i}").alias("touched")) for i, n in enumerate(by)]
    return one.select(F.inline(F.array(*entries)))
