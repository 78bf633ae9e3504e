"""Ranked lexical search by NRA: posting lists sorted by impact, read in order, without random access.

Texts are cut into terms once; of every row the terms that some item asks for are stored with their counts.
Tasks then read the stored rows in shards of a bounded number of postings. Within a shard every term has its
list of (document, impact), highest impacts first, and an item's lists are read side by side, a stretch of
growing depth at a time. A document's lower bound is what was read of it; its upper bound adds the next unread
impact of each list it was not met in. Reading goes on

1. until a document not met at all could not reach the k-th lower bound, not even with an equal score; then
2. of the documents that still can, until no interval is open: an interval closes when all lists that the
   document was not met in are at their end, or at impact 0. Ties are then settled by the doc_id.

A task carries its k best scores of every item from shard to shard as a bound from which reading starts, and
hands on k rows an item; a window with Spark's group limit leaves the k best of all.

Items are taken in blocks whose texts are bounded in bytes, and each block is searched in one run over all
rows. What a task is sent grows with a block's terms only, and so does what the driver collects.

Defined results: a null or wordless text is no document and no item; rows that share a doc_id are documents of
their own, and benchmark rows that share an item_id are items of their own; a null doc_id comes last among equal
scores; an empty table on either side gives no rows; a text of any length is counted whole, in blocks; only
doc_id, text and item_id, text are read.
"""

from __future__ import annotations

import collections
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from landgate.llm import words as W
from landgate.llm.batches import in_groups
from landgate.llm.tables import stored, table

#: How many documents an item gets.
K = 10
#: Bytes of item texts searched together, and items.
BLOCK_BYTES, BLOCK_ITEMS = 2 << 20, 2048
#: Postings, and documents, of a shard.
SHARD_POSTINGS, SHARD_DOCUMENTS = 1 << 20, 1 << 16
#: How deep lists are read at first; each next stretch ends twice as deep.
DEPTH = 128
#: Bytes of a text counted together.
COUNTED = 1 << 20
#: Bytes of terms lower-cased, all other bytes as spaces.
TERMS = bytes(int(W.LOWER[b]) if W.ALNUM[W.LOWER[b]] else 0x20 for b in range(256))
#: Fixed values of the contract.
SCALE, STEP, FLAT, SLOPE = 1_000_000_000, 1000, 100 - 75, 75
STATISTICS = {"documents": -1, "terms": -2}


def counted(text: str) -> collections.Counter:
    """How often each term occurs in a text."""
    data, out, at = text.encode().translate(TERMS), collections.Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + COUNTED)
        end = len(data) if end < 0 else end
        out.update(data[at:end].split())
        at = end
    return out


POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"


def postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): the number of terms of every text that has any, and its terms of
    ``number``."""
    arrow = to_arrow_schema(StructType.fromDDL(POSTINGS))

    def run(batches):
        for batch in batches:
            ids = iter(batch.column(0).cast(pa.int64()).to_pylist())
            for texts in in_groups(batch.column(1)):
                rows = []
                for text, doc_id in zip(texts, ids, strict=False):
                    counts = counted(text)
                    if counts:
                        held = counts.keys() & number.keys()
                        rows.append((doc_id, counts.total(), [number[t] for t in held], [counts[t] for t in held]))
                columns = zip(*rows, strict=True) if rows else [[]] * 4
                arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, POSTINGS)


def statistics(found: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """The number of documents, of all their terms, and of the documents that hold each term."""

    def run(batches):
        holders, documents, terms = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            documents += batch.num_rows
            terms += sum(batch.column(0).to_pylist())
            holders += np.bincount(batch.column(1).flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(holders)
        names, values = [*STATISTICS.values(), *held.tolist()], [documents, terms, *holders[held].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.int64())], names=["name", "n"])

    parts = found.select("n", "terms").mapInArrow(run, "name long, n long")
    total = {r.name: r.n for r in parts.groupBy("name").agg(F.sum("n").alias("n")).collect()}
    holders = np.array([total.get(t, 0) for t in range(n_terms)], np.int64)
    return total.get(STATISTICS["documents"], 0), total.get(STATISTICS["terms"], 0), holders


def term_weights(n_documents: int, holders: np.ndarray) -> list[int]:
    return [math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1))) for df in holders.tolist()]


class Shard:
    """Some documents, and of every term its impacts on them in falling order."""

    def __init__(self, rows: list[tuple], n_documents: int, n_terms: int):
        ids, sizes, terms, counts = zip(*rows, strict=True)
        self.no_id = np.array([i is None for i in ids])
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        slack = np.array([FLAT + (SLOPE * n * n_documents) // n_terms for n in sizes], np.int64)
        term, tf = np.concatenate(terms), np.concatenate(counts).astype(np.int64)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), list(map(len, terms)))
        impact = (SCALE * tf) // (STEP * tf + 8 * slack[doc])
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.place = dict(zip(self.terms.tolist(), zip(first, [*first[1:], len(term)], strict=True), strict=True))

    def lists(self, item: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For the (term, weight) of an item the lists of (document, weighted impact)."""
        spans = [(self.place[t], w) for t, w in item if w and t in self.place]
        return [(self.doc[a:b], self.impact[a:b] * w) for (a, b), w in spans]


def heads(lists, depth: int) -> list[int]:
    """The next unread impact of each list, 0 at its end."""
    return [int(impact[depth]) if depth < len(impact) else 0 for _, impact in lists]


def resolved(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents of a shard that have one of its ``k`` highest scores, equal ones included, and at
    least ``least``, with these scores. All scores are above 0."""
    lower, at, depth = np.zeros(n, np.int64), 0, DEPTH
    while True:
        for doc, impact in lists:
            lower[doc[at:depth]] += impact[at:depth]
        at, left = depth, heads(lists, depth)
        kth = max(least, int(np.partition(lower, n - k)[n - k]) if n > k else 0)
        if sum(left) < kth or not any(left):
            break
        depth *= 2
    candidates, low = np.flatnonzero(lower), lower[lower > 0]
    place = np.full(n, -1, np.int32)
    while True:
        place[:] = -1
        place[candidates] = np.arange(len(candidates))
        met = np.zeros(len(candidates), np.int64)
        for (doc, _), head in zip(lists, left, strict=True):
            if head:
                own = place[doc[:at]]
                met[own[own >= 0]] += head
        upper = low + sum(left) - met
        if len(low) > k:
            kth = max(kth, int(np.partition(low, len(low) - k)[len(low) - k]))
        stay = upper >= kth
        closed = (upper == low)[stay].all()
        candidates, low = candidates[stay], low[stay]
        if closed:
            return candidates, low
        place[:] = -1
        place[candidates] = np.arange(len(candidates))
        for doc, impact in lists:
            own = place[doc[at : 2 * at]]
            hit = own >= 0
            low[own[hit]] += impact[at : 2 * at][hit]
        at *= 2
        left = heads(lists, at)


class Best:
    """The k best documents of every item so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, {}

    def least(self, item: int) -> int:
        own = self.rows.get(item)
        return int(own[0][-1]) if own is not None and len(own[0]) == self.k else 0

    def add(self, item: int, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        own = (score, no_id, ids)
        if item in self.rows:
            own = tuple(map(np.concatenate, zip(self.rows[item], own, strict=True)))
        order = np.lexsort((own[2], own[1], -own[0]))[: self.k]
        self.rows[item] = tuple(column[order] for column in own)


def _shards(batches) -> Iterator[list[tuple]]:
    rows, held = [], 0
    for batch in batches:
        ids, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, (doc_id, n) in enumerate(zip(ids, sizes, strict=True)):
            terms = batch.column(2)[i].values
            if len(terms):
                rows.append((doc_id, n, terms.to_numpy(), batch.column(3)[i].values.to_numpy()))
                held += len(terms)
            if held >= SHARD_POSTINGS or len(rows) >= SHARD_DOCUMENTS:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


FOUND = "item long, doc_id long, score long"


def best_of_shards(found: DataFrame, items: list, n_documents: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of every task for every item."""

    def run(batches):
        best = Best(k)
        for rows in _shards(batches):
            shard = Shard(rows, n_documents, n_terms)
            for item, own in enumerate(items):
                if lists := shard.lists(own):
                    at, score = resolved(lists, len(rows), k, best.least(item))
                    best.add(item, score, shard.no_id[at], shard.ids[at])
        for item, (score, no_id, ids) in best.rows.items():
            columns = [pa.array(np.full(len(ids), item)), pa.array(ids, mask=no_id), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return found.mapInArrow(run, FOUND)


def item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(item_id, text) in blocks of bounded bytes; a longer text is a block of its own."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        n = len((row.text or "").encode())
        if block and (size + n > BLOCK_BYTES or len(block) >= BLOCK_ITEMS):
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text or ""))
        size += n
    if block:
        yield block


def search_block(docs: DataFrame, block: list[tuple], k: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items of a block, numbered from 0."""
    wanted = [counted(text) for _, text in block]
    number = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    found = stored(postings(docs, number), "search-postings")
    n_documents, n_terms, holders = statistics(found, len(number))
    weight = term_weights(n_documents, holders)
    items = [[(number[t], weight[number[t]] * times) for t, times in sorted(own.items())] for own in wanted]
    rows = best_of_shards(found, items, n_documents, n_terms, k)
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = rows.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("item", "rank", "doc_id", "score")


def searched(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for every item."""
    spark, id_type = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    for block in item_blocks(items):
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item long, item_id {id_type}")
        found = search_block(docs, block, k).join(F.broadcast(ids), "item")
        out = out.union(found.select("item_id", "rank", "doc_id", "score"))
    return out


def op12_impact_intervals(spark, sf_dir):
    return searched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT i, item_id, t, count(*) AS times FROM b GROUP BY ALL),
s AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
p AS (SELECT r, doc_id, t, count(*) AS tf FROM (SELECT r, doc_id, unnest(w) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
m AS (SELECT r, 100 - 75 + ((75 * len(w) * nn) // ll) AS m FROM d, s WHERE len(w) > 0),
x AS (SELECT i, item_id, r, doc_id,
    CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (t) JOIN f USING (t) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

QUERIES = {"op12_impact_intervals": (op12_impact_intervals, SQL)}
