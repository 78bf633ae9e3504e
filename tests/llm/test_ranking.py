"""Ranked lexical search and importance resampling, next to brute-force versions."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from cases import LOWER, TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from landgate.llm import importance, ranked_search
from landgate.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "the quick brown fox jumps"),
    (2, "THE the the lazy same"),
    (2, "word5 und3 nothere"),
    (3, None),
    (4, " .,- "),
    (None, "same Ünïcödé 😀"),
]


def ranked(docs, items, k=10):
    """Every item's k best by scoring all documents."""
    counts = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = collections.Counter()
    for item, text in items:
        wanted = collections.Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, c in counts:
            m = 25 + (75 * c.total() * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in wanted.items()
                if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(scores)[:k], 1):
            out[(item, rank, None if null else i, -score)] += 1
    return out


def item_table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, score long, doc_id string")


def found(docs, items, k=10):
    return collections.Counter(tuple(r) for r in ranked_search.searched(docs, items, k).collect())


def test_search_of_odd_rows(spark):
    rows = [*TEXTS, *[(50 + i, "same fox the") for i in range(25)]]
    for k in (1, 3, 10, 100):
        assert found(documents(spark, rows), item_table(spark, ITEMS), k) == ranked(rows, ITEMS, k)
    assert not found(documents(spark, []), item_table(spark, ITEMS))
    assert not found(documents(spark), item_table(spark, []))
    assert not found(documents(spark, [(1, None), (2, "..")]), item_table(spark, ITEMS))


def test_search_in_small_blocks_and_shards(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = ranked(docs, items)
    rows = REGISTRY["op12_impact_intervals"][0](spark, SF).collect()
    assert collections.Counter(map(tuple, rows)) == want
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 1500)
    assert len(list(ranked_search.item_blocks(item_table(spark, items)))) > 2
    assert found(documents(spark, docs), item_table(spark, items)) == want


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 60), st.integers(1, 6), st.integers(1, 5), st.integers(0, 400))
def test_intervals_close_on_the_best_scores(seed, n, n_lists, k, least):
    """Shallow first stretches, many ties, zero impacts, and a bound brought along."""
    draw, lists = np.random.default_rng(seed), []
    for _ in range(n_lists):
        doc = draw.permutation(n)[: draw.integers(1, n + 1)].astype(np.int32)
        lists.append((doc, np.sort(draw.integers(0, 40, len(doc)) * 5)[::-1].astype(np.int64)))
    depth, ranked_search.DEPTH = ranked_search.DEPTH, 2
    try:
        at, got = ranked_search.resolved(lists, n, k, least)
    finally:
        ranked_search.DEPTH = depth
    score = np.zeros(n, np.int64)
    for doc, impact in lists:
        score[doc] += impact
    kth = max(least, np.sort(score)[-k] if n >= k else 0)
    must = {int(i): int(score[i]) for i in np.flatnonzero((score >= kth) & (score > 0))}
    given_ = dict(zip(at.tolist(), got.tolist(), strict=True))
    assert must.items() <= given_.items()
    assert all(score[i] == s for i, s in given_.items())


def test_terms_of_long_texts(monkeypatch):
    text = "Ab1 é-中x " * 500
    want = collections.Counter(t.encode() for t in TERM.findall(text.translate(LOWER)))
    monkeypatch.setattr(ranked_search, "COUNTED", 7)
    assert ranked_search.counted(text) == want


# --- importance resampling


def runs(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(docs, target, least=20, percent=5):
    """(doc_id, n_features, weight, score) of every row, and the drawn rows in order."""
    source, aim = collections.Counter(), collections.Counter()
    for rows, into in ((docs, source), (target, aim)):
        for _, text in rows:
            into.update(zlib.crc32(f.encode()) % 10000 for f in runs(text)[1])
    all_s, all_t, rows, may = source.total(), aim.total(), [], []
    for i, text in docs:
        n, own = runs(text)
        b = [zlib.crc32(f.encode()) % 10000 for f in own]
        weight = sum(math.floor(1000 * math.log((aim[x] + 1) * (all_s + 10000) / ((source[x] + 1) * (all_t + 10000)))) for x in b)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(own), weight, score))
        if n >= least:
            may.append((-score, i is None, i or 0, len(own), weight))
    drawn = sorted(may)[: percent * len(may) // 100]
    return collections.Counter(rows), [(None if null else i, n, w, -s, r) for r, (s, null, i, n, w) in enumerate(drawn, 1)]


def check_resampling(got, docs, target, **more):
    rows, drawn = resampled(docs, target, **more)
    assert collections.Counter(tuple(r)[:4] for r in got) == rows
    assert sorted((tuple(r) for r in got if r.rank is not None), key=lambda r: r[4]) == drawn


def test_resampling_of_odd_rows(spark):
    ties = [(60 + i % 3, "the quick brown fox jumps over the dog again") for i in range(9)]
    docs, target = [*TEXTS, *ties], [(1, "the quick brown fox"), (2, None), (3, "word5 und3")]
    for least, percent in ((20, 5), (5, 50), (0, 100), (5, 0)):
        got = importance.resampled(documents(spark, docs), item_table(spark, target), least_words=least, percent=percent)
        check_resampling(got.collect(), docs, target, least=least, percent=percent)
    check_resampling(importance.resampled(documents(spark, docs), item_table(spark, [])).collect(), docs, [])
    assert importance.resampled(documents(spark, []), item_table(spark, target)).count() == 0
    nothing = [(1, None), (2, "")]
    check_resampling(importance.resampled(documents(spark, nothing), item_table(spark, target)).collect(), nothing, target)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60), st.sampled_from([1, 3, 1 << 16]))
def test_buckets_of_any_text(text, block):
    own, importance.BLOCK = importance.BLOCK, block
    try:
        n, got = importance.buckets_of(text)
    finally:
        importance.BLOCK = own
    words, want = runs(text)
    assert n == words
    assert sorted(got.tolist()) == sorted(zlib.crc32(f.encode()) % 10000 for f in want)


def test_resampling_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    check_resampling(REGISTRY["op13_importance_resampling"][0](spark, SF).collect(), docs, target)


def test_too_many_buckets(spark):
    with pytest.raises(ValueError):
        importance.features(documents(spark), 1 << 17)
