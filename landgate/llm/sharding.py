"""Shards by a keyed permutation of the row numbers: a Feistel network with cycle walking.

Rows are numbered 0..n-1 in the order of (doc_id, text_crc32, size). A Feistel network over pairs
(left, right) with left < a, right < b and a * b a little above n permutes 0..a*b-1; a result of n or
more is permuted again until it is below n (cycle walking). That gives a permutation of 0..n-1 that
any worker can compute for any row alone. Row p of the shuffle lies in shard p % k at slot p // k, so
shard sizes differ by one row at most and slots have no gaps.

Everything is built of DataFrame functions. The text is read once; what is ordered are rows of three
numbers, and what is broadcast or gathered is one row per partition of that order.

Defined results: a null text counts as no bytes (size 8, crc 0); a null doc_id sorts first; equal
rows get different slots, and which of them gets which makes no difference; an empty table gives no
rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgate.llm.tables import stored, table

#: One word per round; other words give another permutation.
ROUND_KEYS = ("shuffle-0", "shuffle-1", "shuffle-2", "shuffle-3", "shuffle-4", "shuffle-5")
#: Steps of a walk. Fewer than sqrt(n) + 1 numbers lie outside, so 64 steps end every walk for n up
#: to 3900; beyond that one in more than 60**64 would not end, and raises an error.
WALK = 64


def domain(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def scrambled(v: Column, key: str) -> Column:
    """The first 48 bits of the MD5 of a number and a round's key."""
    digest = F.md5(F.concat(v.cast("string"), F.lit(f":{key}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def feistel(x: Column, n: int, keys: tuple[str, ...] = ROUND_KEYS) -> Column:
    """One pass of the network over 0..a*b-1."""
    a, b = (F.lit(v).cast("long") for v in domain(n))
    right = x % b
    left = F.call_function("div", x, b)
    for i, key in enumerate(keys):
        if i % 2:
            right = (right + scrambled(left, key)) % b
        else:
            left = (left + scrambled(right, key)) % a
    return left * b + right


def shuffled_position(x: Column, n: int, keys: tuple[str, ...] = ROUND_KEYS) -> Column:
    """The place of row ``x`` of 0..n-1 in the shuffle."""
    first, end = feistel(x, n, keys), F.lit(n).cast("long")
    steps = F.sequence(F.lit(2), F.lit(WALK))
    walked = F.reduce(steps, first, lambda p, _: F.when(p < end, p).otherwise(feistel(p, n, keys)))
    done = F.when(walked < end, walked).otherwise(F.raise_error(F.lit("a walk has not ended")))
    return F.when(first < end, first).otherwise(done)


def row_numbered(rows: DataFrame, order: list[str], number: str = "row_number") -> DataFrame:
    """Gapless numbers from 0 in the given order, without one task seeing all rows.

    The rows are range-partitioned, sorted and stored with their place in their partition; the
    partitions' sizes, one row each, then give every partition its first number.
    """
    place = F.monotonically_increasing_id()
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("_place", place), "row-numbers")
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit(2**33 - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    starts = sizes.select("_part", before.alias("_start"))
    numbered = ordered.withColumn("_part", part).join(starts, "_part")
    return numbered.withColumn(number, F.col("_start") + inside).drop("_place", "_part", "_start")


def sharded(docs: DataFrame, n_shards: int = 24, keys: tuple[str, ...] = ROUND_KEYS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 8).cast("long")
    thin = docs.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    thin = stored(thin, "shard-rows")
    n = thin.count()
    numbered = row_numbered(thin, ["doc_id", "text_crc32", "size"])
    placed = numbered.withColumn("_place", shuffled_position(F.col("row_number"), n, keys))
    shard = F.col("_place") % n_shards
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        F.call_function("div", F.col("_place"), F.lit(n_shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_feistel_shards(spark, sf_dir):
    return sharded(table(spark, sf_dir, "documents"))


def _sql_round(v: str, key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({v} AS VARCHAR) || ':{key}'), 1, 12) AS BIGINT)"


def _sql_rounds(source: str) -> str:
    """The network as one nested SELECT per round over (x, l, r) rows with a, b in table dims."""
    sql = f"SELECT k, x // b AS l, x % b AS r FROM {source}, dims"
    for i, key in enumerate(ROUND_KEYS):
        if i % 2:
            sql = f"SELECT k, l, (r + {_sql_round('l', key)}) % b AS r FROM ({sql}), dims"
        else:
            sql = f"SELECT k, (l + {_sql_round('r', key)}) % a AS l, r FROM ({sql}), dims"
    return f"SELECT k, l * b + r AS x FROM ({sql}), dims"


#: CRC-32 (polynomial 0xEDB88320) byte by byte, from its definition; the walk as a recursive query.
SQL = f"""
WITH RECURSIVE
bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, j: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
hexed AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
thin AS (SELECT doc_id, CAST(strlen(text) + 8 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
        range(CAST(length(h) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda c, y: xor(c // 256, t[1 + (xor(c, y) % 256)]))) AS text_crc32
  FROM hexed, bits),
n AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM thin),
dims AS (SELECT n, a, (n + a - 1) // a AS b FROM n),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS k FROM thin),
walk AS (
  SELECT * FROM ({_sql_rounds('(SELECT k, k AS x FROM numbered)')})
  UNION ALL
  SELECT * FROM ({_sql_rounds('(SELECT k, x FROM walk, n WHERE x >= n)')}))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % 24 AS INTEGER) AS shard, x // 24 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM walk JOIN numbered USING (k), n WHERE x < n
"""

QUERIES = {"op8_feistel_shards": (op8_feistel_shards, SQL)}
