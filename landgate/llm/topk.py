"""Exact top-k inner products with block-at-a-time pruning.

Vectors of whole numbers are sorted by a coarse cell and their id, and every BLOCK of them in that order is a
block: its forward index (the vectors themselves) with each term's largest and smallest value. A query's
bound for a block is the sum over its terms of the largest product possible. Per query, blocks are taken in
the order of their bounds and scored through their forward index until the next bound is below the k-th best
score so far; equal bounds are still scored, as ties go to smaller ids. A query starts with the k-th
best score in its own block, so most blocks fall below from the start.

Groups of queries meet groups of blocks, each of bounded size, in one task per pair of groups; at most k
rows per query leave it. Cells are only an order that makes bounds tight: they are fitted on a bounded
sample, and any cells give the same result.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors
are filled up with zeros; rows with null ids take no part; repeated rows are rows of their own, and a repeated query has every candidate as often; a query never meets
rows of its own id; queries with fewer than k candidates get them all; an empty table gives no rows. Products are
exact at any size: as floating-point numbers where all sums stay below 2**53, else as 64-bit integers, else as
Python's; a score of the result beyond 64 bits, or a component beyond 2**62, is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgate.llm.tables import stored, table

BLOCK = 128
#: Blocks, and queries, that meet in one task.
GROUP_BLOCKS, GROUP_QUERIES = 64, 1024
CELLS, SAMPLE, ROUNDS = 32, 4096, 5
SCALE = 256


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of the rows of two matrices of whole numbers, as 64-bit integers."""
    largest = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (a, b)]
    bound = largest[0] * largest[1] * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    return (a.astype(object) @ b.T.astype(object)).astype(np.int64)


def upper_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For every query and block no less than the largest product possible."""
    q, low, high = (m.astype(np.float64) for m in (q, low, high))
    slack = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T * (q.shape[1] + 4) * 2.0**-50
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T + slack


def whole_numbers(column: pa.Array, dims: int, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors as whole numbers)."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    value = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    fine = np.asarray(column.is_valid())
    fine[row[~np.isfinite(value)]] = False
    dense = np.zeros((len(column), dims), np.int64)
    use = fine[row]
    dense[row[use], place[use]] = np.floor(scale * value[use])
    return np.flatnonzero(fine), dense[fine]


def cells(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.argmax(vectors @ pivots.T, axis=1)


def fitted_pivots(sample: np.ndarray, n: int = CELLS, rounds: int = ROUNDS) -> np.ndarray:
    """Directions of ``n`` groups of the sample."""
    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1)
    pivots = unit[np.linspace(0, len(unit) - 1, min(n, len(unit))).astype(int)]
    for _ in range(rounds):
        own = cells(unit, pivots)
        sums = np.stack([np.bincount(own, unit[:, d], len(pivots)) for d in range(unit.shape[1])], 1)
        pivots = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return pivots


def better(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` best scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:k]


def block_rows(ids: np.ndarray, vectors: np.ndarray, is_query: np.ndarray, k: int, kind: str) -> dict:
    """A block: its vectors, its terms' extremes, and its queries with their k-th best score in it."""
    own = []
    for i in np.flatnonzero(is_query):
        scores = exact_products(vectors, vectors[i : i + 1])[ids != ids[i], 0]
        floor = int(np.partition(scores, -k)[-k]) if len(scores) >= k else None
        own.append({"query_id": int(ids[i]), "vector": vectors[i].astype(kind).tobytes(), "floor": floor})
    return {
        "ids": ids.astype("<i8").tobytes(),
        "vectors": vectors.astype(kind).tobytes(),
        "high": vectors.max(axis=0).astype(kind).tobytes(),
        "low": vectors.min(axis=0).astype(kind).tobytes(),
        "queries": own,
    }


BLOCK_SCHEMA = (
    "ids binary, vectors binary, high binary, low binary, "
    "queries array<struct<query_id: bigint, vector: binary, floor: bigint>>"
)
BLOCK_ARROW = pa.schema([
    ("ids", pa.binary()), ("vectors", pa.binary()), ("high", pa.binary()), ("low", pa.binary()),
    ("queries", pa.list_(pa.struct([("query_id", pa.int64()), ("vector", pa.binary()), ("floor", pa.int64())]))),
])


def blocks(
    vectors: DataFrame, dims: int, k: int, pivots: np.ndarray, id_: str, query: Column, kind: str
) -> DataFrame:
    """One row per block of the vectors (``id_``, ``vector``), in the order of cell and id; ``kind`` is the type
    in which whole numbers are kept."""

    def quantised(batches):
        for batch in batches:
            rows, found = whole_numbers(batch.column(1), dims)
            cell = cells(found, pivots) if len(rows) else np.zeros(0, np.int64)
            kept = batch.take(pa.array(rows))
            data = pa.array([v.astype(kind).tobytes() for v in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), pa.array(cell.astype(np.int32)), kept.column(2), data],
                names=["id", "cell", "query", "v"],
            )

    def blocked(batches):
        held: list[tuple] = []

        def block():
            ids, is_query, data = zip(*held, strict=True)
            matrix = np.frombuffer(b"".join(data), kind).reshape(len(ids), dims)
            return block_rows(np.array(ids, np.int64), matrix, np.array(is_query, bool), k, kind)

        for batch in batches:
            out = []
            for row in zip(*(batch.column(n).to_pylist() for n in ("id", "query", "v")), strict=True):
                held.append(row)
                if len(held) == BLOCK:
                    out.append(block())
                    held = []
            yield pa.RecordBatch.from_pylist(out, schema=BLOCK_ARROW)
        if held:
            yield pa.RecordBatch.from_pylist([block()], schema=BLOCK_ARROW)

    rows = vectors.filter(F.col(id_).isNotNull())
    rows = rows.select(F.col(id_).cast("long").alias("id"), F.col("vector"), query.alias("query"))
    rows = stored(rows.mapInArrow(quantised, "id long, cell int, query boolean, v binary"), "topk-vectors")
    ordered = rows.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id", "v")
    return stored(ordered.mapInArrow(blocked, BLOCK_SCHEMA), "topk-blocks")


def search(queries: list[tuple], group: list[tuple], dims: int, k: int, kind: str = "<i4") -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score): each query's best ``k`` in a group of blocks, as far as they can count.

    queries: (query_id, vector bytes, floor or None); group: (ids, vectors, high, low) as bytes.
    """
    q = np.stack([np.frombuffer(v, kind) for _, v, _ in queries])
    low, high = (np.stack([np.frombuffer(b[i], kind) for b in group]) for i in (3, 2))
    ids = [np.frombuffer(b[0], "<i8") for b in group]
    vectors = [np.frombuffer(b[1], kind).reshape(-1, dims) for b in group]
    bounds = upper_bounds(q, low, high)
    order = np.argsort(-bounds, axis=1, kind="stable")
    least = np.array([np.iinfo(np.int64).min if f is None else f for _, _, f in queries], np.int64)
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
    active = np.arange(len(queries))
    for rank in range(len(group)):
        block = order[active, rank]
        active = active[bounds[active, block] >= least[active]]
        if not len(active):
            break
        block = order[active, rank]
        for b in np.unique(block):
            some = active[block == b]
            scores = exact_products(q[some], vectors[b])
            near = scores >= least[some][:, None]
            for i in np.flatnonzero(near.any(axis=1)):
                own = near[i] & (ids[b] != queries[some[i]][0])
                s = np.concatenate((best[some[i]][0], scores[i][own]))
                n = np.concatenate((best[some[i]][1], ids[b][own]))
                top = better(s, n, k)
                best[some[i]] = s[top], n[top]
                if len(top) == k:
                    least[some[i]] = max(least[some[i]], s[top[-1]])
    return [
        (query[0], int(n), int(s)) for query, own in zip(queries, best, strict=True) for s, n in zip(*own, strict=True)
    ]


def top_k(vectors: DataFrame, id_: str, vector: str, query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` for which ``query`` holds."""
    rows = vectors.select(F.col(id_), F.col(vector).cast("array<double>").alias("vector"), query.alias("_query"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    sizes = F.when(finite, F.array_max(F.transform("vector", F.abs)))
    dims, largest = rows.agg(F.max(F.size("vector")), F.max(sizes)).first()
    dims, largest = max(1, dims or 1), SCALE * (largest or 0) + 1
    if largest > 1 << 62:
        raise ValueError(f"components of up to {largest / SCALE} are beyond 64-bit integers")
    kind = "<i4" if largest < 1 << 31 else "<i8"
    few = rows.filter(F.col(id_).isNotNull() & F.col("vector").isNotNull())
    few = few.orderBy(F.xxhash64(id_), id_).limit(SAMPLE).select("vector").toArrow().column(0)
    _, sample = whole_numbers(few.combine_chunks(), dims)
    pivots = fitted_pivots(sample.astype(np.float64)) if len(sample) else np.zeros((1, dims))
    built = blocks(rows, dims, k, pivots, id_, F.coalesce(F.col("_query"), F.lit(False)), kind)
    asked = built.select(F.explode("queries").alias("q")).select("q.*")
    n_blocks, n_queries = built.count(), asked.count()
    shards, groups = max(1, -(-n_blocks // GROUP_BLOCKS)), max(1, -(-n_queries // GROUP_QUERIES))

    def numbers(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    shard, group = F.pmod(F.xxhash64("ids"), F.lit(shards)), F.pmod(F.xxhash64("query_id"), F.lit(groups))
    left = asked.withColumn("grp", group.cast("int")).withColumn("shard", numbers(shards))
    right = built.drop("queries").withColumn("shard", shard.cast("int")).withColumn("grp", numbers(groups))

    def meet(some: pd.DataFrame, blocks_: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(some) and len(blocks_):
            floors = [None if pd.isna(f) else int(f) for f in some["floor"]]
            queries = list(zip(some["query_id"].tolist(), some["vector"], floors, strict=True))
            own = list(zip(*(blocks_[c] for c in ("ids", "vectors", "high", "low")), strict=True))
            found = search(queries, own, dims, k, kind)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    met = left.groupBy("grp", "shard").cogroup(right.groupBy("grp", "shard"))
    met = met.applyInPandas(meet, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_block_pruning(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
QUERIES = {"op4_block_pruning": (op4_block_pruning, SQL)}
