"""Importance resampling towards a target: documents drawn by how alike their words are to other texts.

The tokenizers library cuts an ASCII-lowered text with an untrained regular-expression Split and says where
every word starts and ends. Runs of non-word characters are one space by then, so the bytes between the
start of a word and the end of a later one are the run of these words joined by one space: pairs of offsets
give all runs of one to three words. A run's CRC-32 modulo the number of buckets is its bucket. Histograms of
documents and target give every bucket a gain, the log of its share in the target over its share in the
documents, and a document's weight is the sum of the gains of its runs. Weights with Gumbel noise drawn from
the doc_id are the scores whose highest are a sample without replacement.

Texts are cut once: each row's buckets are stored, two bytes a run, and read for the histogram and for the
weights. The histograms are combined per task before they are shuffled and have ``BUCKETS`` rows at the
end, whatever the input; only these and a few totals reach the driver. For the ranks an approximate
quantile leaves little more than the rows to be drawn; these are range-partitioned and numbered in order.

Defined results: null, empty and wordless texts have no runs, weight 0 and no rank; a null doc_id draws the
noise of ``42:`` and comes after other ids of its score; rows that share a doc_id are documents of their own,
and of equal rows any may come first; an empty table gives no rows, an empty target gains from its smoothing
alone; only doc_id and text are read. A long text is cut in blocks, so memory grows with its runs alone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from landgate.llm import words as W
from landgate.llm.batches import in_groups
from landgate.llm.sharding import row_numbered
from landgate.llm.tables import stored, table

#: Fixed values of the contract.
LONGEST, BUCKETS, SEED = 3, 10_000, 42
LEAST_WORDS, PERCENT = 20, 5
OTHERS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Bytes of a text cut together.
BLOCK = 1 << 16
#: Accuracy of the quantile below which no row is drawn: its rank is off by at most one in so many.
ACCURACY = 10_000
LOWER = W.LOWER.tobytes()
FEATURES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary())])

_others = re.compile(OTHERS)
_split = Split(Regex(WORD), "removed", invert=True)


def word_offsets(data: bytes) -> Iterator[list[tuple[int, int]]]:
    """(start, end) of the words of lowered bytes, block by block. The Split is given every byte as one
    character, so its offsets count bytes; all bytes of characters beyond ASCII belong to words."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + BLOCK)
        end = len(data) if end < 0 else end
        yield [(at + a, at + b) for _, (a, b) in _split.pre_tokenize_str(data[at:end].decode("latin-1"))]
        at = end


def buckets_of(text: str, n_buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the bucket of each of its runs."""
    data = _others.sub(b" ", text.encode().translate(LOWER))
    n, before, crcs = 0, [], []
    for block in word_offsets(data):
        n += len(block)
        known = len(before)
        starts, ends = zip(*before, *block, strict=True) if known or block else ((), ())
        for more in range(LONGEST):
            first = max(known, more)
            windows = zip(starts[first - more :], ends[first:], strict=False)
            crcs.append(np.array([zlib.crc32(data[a:b]) for a, b in windows], np.uint32))
        before = [*before, *block][-(LONGEST - 1) :]
    return n, (np.concatenate(crcs) % n_buckets if crcs else np.zeros(0)).astype("<u2")


def features(docs: DataFrame, n_buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, buckets): the buckets of a text's runs of words, two bytes each."""
    if n_buckets > 1 << 16:
        raise ValueError("a bucket has two bytes")

    def run(batches):
        for batch in batches:
            ids, at = batch.column(0).cast(pa.int64()), 0
            for texts in in_groups(batch.column(1)):
                found = [buckets_of(t, n_buckets) for t in texts]
                columns = [
                    ids.slice(at, len(texts)),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([b.tobytes() for _, b in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=FEATURES)
                at += len(texts)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, "doc_id long, n_words long, buckets binary")


def histogram(found: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """How many runs fall in each bucket; every task hands on one row a bucket at most."""

    def run(batches):
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += np.bincount(np.frombuffer(cell.as_buffer(), "<u2"), minlength=n_buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    parts = found.select("buckets").mapInArrow(run, "bucket long, n long")
    out = np.zeros(n_buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of a bucket's smoothed share in the target over that in the source, floored."""
    n, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    shares = [(t + 1.0) * (all_s + n) / ((s + 1.0) * (all_t + n)) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(share)) for share in shares], np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight)."""

    def run(batches):
        for batch in batches:
            own = [np.frombuffer(cell.as_buffer(), "<u2") for cell in batch.column(2)]
            sizes = pa.array(map(len, own), pa.int64())
            sums = pa.array([int(gain[x].sum()) for x in own], pa.int64())
            names = ["doc_id", "n_words", "n_features", "weight"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, sums], names=names)

    return found.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel number made from the doc_id, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def with_ranks(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``scored`` with the rank of the highest scores among texts of enough words, null for the others."""
    may = F.col("n_words") >= least_words
    level = max(0.0, 1 - percent / 100 - 2 / ACCURACY)
    low, n = scored.filter(may).agg(F.percentile_approx("score", level, ACCURACY), F.count("*")).first()
    drawn = percent * n // 100
    near = may & (F.col("score") >= low) if low is not None else F.lit(False)
    if low is not None and scored.filter(near).count() < drawn:
        near = may
    order = [(-F.col("score")).alias("_down"), F.col("doc_id").isNull().alias("_no_id")]
    numbered = row_numbered(scored.filter(near).select("*", *order), ["_down", "_no_id", "doc_id"], "_number")
    rank = F.when(F.col("_number") < drawn, F.col("_number") + 1).cast("long")
    rest = scored.filter(~near).withColumn("rank", F.lit(None).cast("long"))
    return numbered.select(*scored.columns, rank.alias("rank")).union(rest)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    n_buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text); ``target`` has text."""
    found = stored(features(docs, n_buckets), "importance-features")
    aim = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    gain = gains(histogram(found, n_buckets), histogram(features(aim, n_buckets), n_buckets))
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    scored = stored(weighted(found, gain).withColumn("score", score), "importance-scores")
    return with_ranks(scored, least_words, percent).select("doc_id", "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark, sf_dir):
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op13_importance_resampling": (op13_importance_resampling, None)}
