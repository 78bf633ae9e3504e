"""Operators on whole tables: top-k search, Jaccard groups, URL rules, shards, packing, the pipeline."""

import collections
import math
import operator
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents, groups
from pyspark.sql import functions as F

import corpus_pipeline
from landgate.llm import components as C
from landgate.llm import jaccard, packing, sharding, signature_tree, topk, urls
from landgate.llm.queries import REGISTRY
from landgate.llm.tables import stored

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- components


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1200)]
    edges = [*chain, *star, (5, 5), (None, 3), (3, -4), (-4, 3), (3, -4)]
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(1000, 1200)} == {7} and got[7] == 7
    assert got[5] == 5 and got[3] == got[-4] == -4 and len(got) == 61 + 201 + 1 + 2
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- top-k


def best(rows, k=5):
    """Every query's candidates row by row, repeated rows as often as they stand."""
    found = collections.defaultdict(list)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    whole = [(i, v + [0] * (max(len(v) for _, v in whole) - len(v))) for i, v in whole]
    for q, own in whole:
        if q % 50 == 0:
            found[q] += [(-sum(map(operator.mul, own, v)), i) for i, v in whole if i != q]
    ranked = ((q, sorted(pairs)[:k]) for q, pairs in found.items())
    return collections.Counter((q, n, i, -s) for q, pairs in ranked for n, (s, i) in enumerate(pairs, 1))


@pytest.mark.parametrize("n, hot", [(3, 0), (700, 0), (900, 400)])
def test_top_k_against_all_pairs(spark, n, hot, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 8)
    draw = np.random.default_rng(n)
    rows = [(i, [float(x) for x in draw.normal(size=6) * (0.1 + i % 3)]) for i in range(n)]
    rows[:hot] = [(i, [0.5] * 6) for i, _ in rows[:hot]]
    odd = [(50_000, None), (50_050, [1.0, None, 0.0]), (50_100, [float("nan")] * 6), (None, [1.0] * 6), rows[0]]
    frame = spark.createDataFrame([(*r, 1, 2) for r in [*rows, *odd]], "vec_id long, embedding array<float>, shard int, score int")
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in [*rows, rows[0]]]
    got = topk.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect()
    assert collections.Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == best(rows)


@pytest.mark.parametrize("large, others", [(30_000.0, 3e4), (1e6, 1e6), (1e9, 1e4), (1e12, 10.0)])
def test_top_k_of_large_components(spark, large, others):
    """Beyond what floating-point sums, 32-bit components and 64-bit products hold."""
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.integers(-9, 9, 8)]) for i in range(300)]
    rows += [(i, [float(round(x)) for x in draw.normal(size=8) * others]) for i in range(300, 420)]
    rows += [(501, [large, -1.0, 0.5, 0.0, 0.0, 0.0, 0.0, 3.0]), rows[7], rows[50]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect()
    assert collections.Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == best(rows)


def test_components_beyond_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64-bit"):
        topk.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 50 == 0)


def test_products_are_exact():
    draw = np.random.default_rng(4)
    for bits in (10, 24, 28, 40):
        a, b = draw.integers(-(1 << bits), 1 << bits, (5, 64)), draw.integers(-(1 << bits), 1 << bits, (7, 64))
        want = a.astype(object) @ b.T.astype(object)
        if abs(want).max() < 1 << 63:
            assert (topk.exact_products(a, b) == want).all()
        else:
            with pytest.raises(OverflowError):
                topk.exact_products(a, b)
        high, low = b.max(axis=0)[None], b.min(axis=0)[None]
        assert (topk.upper_bounds(a, low, high)[:, 0] >= want.max(axis=1).astype(float)).all()


def test_top_k_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 50 == 0).count() == 0


def test_blocks_are_pruned():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(20, 16)) * 100
    group = []
    for c in centres:
        v = (c + draw.normal(size=(topk.BLOCK, 16))).astype("<i4")
        ids = np.arange(topk.BLOCK) + 1000 * len(group)
        group.append(tuple(topk.block_rows(ids, v, np.zeros(len(ids), bool), 5, "<i4")[k] for k in ("ids", "vectors", "high", "low")))
    q = centres[3].astype("<i4")
    got = topk.search([(-1, q.tobytes(), None)], group, 16, 5)
    every = np.concatenate([np.frombuffer(b[1], "<i4").reshape(-1, 16) for b in group]).astype(int) @ q.astype(int)
    assert sorted(s for _, _, s in got) == sorted(every)[-5:]


# --- Jaccard groups


def test_jaccard_of_odd_rows(spark):
    got = jaccard.jaccard_groups(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    want = groups(TEXTS)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {(i, *v) for i, v in want.items()}
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert jaccard.jaccard_groups(documents(spark, [])).count() == 0


def near_copies(n, spread, seed=5):
    """Chains of near copies, a passage in many texts, and texts of their own."""
    draw, rows = np.random.default_rng(seed), []
    passage = [f"p{i}" for i in range(60)]
    base = [f"b{i}" for i in range(80)]
    for i in range(n):
        if i % 3 == 0:
            own = list(base)
            for at in draw.integers(0, 80, spread):
                own[at] = f"x{draw.integers(0, 10**6)}"
        elif i % 3 == 1:
            own = [*passage, *(f"y{draw.integers(0, 10**6)}" for _ in range(int(draw.integers(10, 60))))]
        else:
            own = [f"z{draw.integers(0, 10**6)}" for _ in range(int(draw.integers(1, 40)))]
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("chunk", [2048, 16])
def test_jaccard_against_all_pairs(spark, chunk, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", chunk)
    rows = near_copies(360, 2)
    got = jaccard.jaccard_groups(documents(spark, rows)).collect()
    want = groups(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, *v) for i, v in want.items()}
    assert len({c for _, c in want.values()}) > 100


def test_jaccard_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = REGISTRY["op6_signature_tree"][0](spark, SF).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, *v) for i, v in groups(rows).items()}


@pytest.mark.parametrize("seed", range(8))
def test_tree_links_against_all_pairs(seed):
    draw, sets = np.random.default_rng(seed), []
    for _ in range(int(draw.integers(1, 12))):
        base = draw.integers(0, 2**62, int(draw.integers(1, 300))).astype(np.uint64)
        for _ in range(int(draw.integers(1, 14))):
            kept = base[draw.random(len(base)) > 0.25 * draw.random()]
            more = draw.integers(0, 2**62, int(draw.integers(0, 1 + len(base) // 5))).astype(np.uint64)
            sets.append(np.unique(np.concatenate((kept, more, base[:1]))))
    n, half = len(sets), len(sets) // 2

    def roots(pairs):
        made = signature_tree.Groups(list(range(n)))
        for i, j in pairs:
            made.join(i, j)
        return made.roots().tolist()

    every = [(i, j) for i in range(n) for j in range(i) if signature_tree.similar(sets[i], sets[j])]
    assert roots(signature_tree.links(sets)) == roots(every)
    across = [(i, j) for i, j in every if (i < half) != (j < half)]
    assert roots(signature_tree.links(sets[:half], None, sets[half:])) == roots(across)


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    ids = sorted((r.doc_id for r in left.collect()), key=lambda i: -1 if i is None else i)
    assert ids == [None, None, 1, 4, 5, 6, 7, 8, 9, 11, 12]


def test_one_of_each_group_stays_when_ids_repeat(spark):
    x, y, z, w = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyzw")
    rows = [(3, x), (5, x + " more"), (5, y), (8, y + " more"), (20, z), (20, w), (20, z + " more"), (20, w), (30, w)]
    rows += [(21, None), (21, ""), (21, "alone"), (None, x)]
    left = [(r.doc_id, r.text) for r in jaccard.one_of_each(documents(spark, rows)).collect()]
    assert sorted(t for i, t in left if i == 20 and t.startswith("z")) in ([z], [z + " more"])
    rest = [(i, t) for i, t in left if not (i == 20 and t.startswith("z"))]
    want = [(3, x), (5, y), (20, w), (21, None), (21, ""), (21, "alone"), (None, x)]
    assert sorted(rest, key=str) == sorted(want, key=str)


# --- URLs

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("bad.org", "/", "block"))


def verdicts(spark, rows, links=None):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, verdict string, node string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged_urls(pages, RULES, links).collect()}


def canonical(to):
    return f"<html><head><LINK href='{to}' rel=\"canonical\"></head></html>"


def test_rules_and_parts(spark):
    got = verdicts(spark, [
        (1, "HTTP://WWW.Example.NET/en/a?x#y", None), (2, "http://example.net/En/", ""), (3, "http://a.net", None),
        (4, None, None), (5, "no url", None), (6, "x://notnet/", None), (7, "a://b.net/p://q", None),
    ])
    assert got[1] == ("www.example.net", "/en/a", "example.net/en/", "allow")
    assert got[2] == ("example.net", "/En/", "net/", "block")
    assert got[3] == ("a.net", "", None, "allow")
    assert got[4] == got[5] == ("", "", None, "allow")
    assert got[6] == ("notnet", "/", None, "allow")
    assert got[7] == ("b.net", "/p://q", "net/", "block")


@pytest.mark.parametrize(
    "html",
    [
        "<link rel=canonical href=" + "x" * 1_000_000 + ">", '<link rel="canonical" href="' + "x" * 1_000_000 + '">',
        "<link " + "y" * 1_000_000, '<link "' * 150_000, "<meta '\"" * 120_000, "<!--" * 250_000, "<script>" * 120_000,
        "<link " + 'a="b" ' * 160_000 + ">", "<link rel=canonical href=/a " + "x" * 5_000, "<" * 1_000_000,
    ],
    ids=range(10),
)
def test_pages_of_broken_tags(spark, html):
    start = time.time()
    assert len(verdicts(spark, [(1, "http://a.org/1", html)])) == 1
    assert time.time() - start < 60


def test_no_links_from_comments_and_scripts(spark):
    blocked = canonical("http://x.net/1")
    for page in (f"<!-- {blocked} -->", f"<script>var a = '{blocked}'</script>", f"<!-- {blocked}", f"<SCRIPT>{blocked}"):
        got = verdicts(spark, [(1, "http://a.org/1", page), (8, "http://x.net/1", None)])
        assert got[1][-1] == "allow" and got[8][-1] == "block"
    got = verdicts(spark, [(1, "http://a.org/1", f"<!-- > --><script>1</script>{blocked}"), (8, "http://x.net/1", None)])
    assert got[1][-1] == "block"


def test_blocks_reach_aliases_and_allow_wins(spark):
    got = verdicts(spark, [
        (1, "http://a.org/1", canonical("http://b.org/2?utm_source=x")),
        (2, "http://b.org/2", '<meta http-equiv="refresh" content="0; URL=http://bad.org/z">'),
        (3, "http://c.org/3", canonical("/4")), (4, "https://c.org/4#f", None),
        (5, "http://d.org/5", canonical("http://x.net/1")), (6, "http://e.org/6", canonical("http://d.org/5")),
        (7, "http://example.net/en/7", canonical("http://d.org/5")), (8, "http://x.net/1", None),
        (8, "http://x.net/1", None),
    ])
    assert [got[i][3] for i in (1, 2, 3, 4)] == ["block", "block", "allow", "allow"]
    assert [got[i][3] for i in (5, 6, 7, 8)] == ["allow", "allow", "allow", "block"]
    log = spark.createDataFrame([("http://c.org/3", "http://bad.org/")], "from_url string, to_url string")
    again = verdicts(spark, [(3, "http://c.org/3", canonical("/4")), (4, "https://c.org/4#f", None)], log)
    assert [again[i][3] for i in (3, 4)] == ["block", "block"]
    assert verdicts(spark, []) == {}


# --- shards


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(spark, n):
    got = [r.p for r in spark.range(n).select(sharding.shuffled_position(F.col("id"), n).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    if n > 90:
        assert sum(abs(a - b) == 1 for a, b in zip(got, got[1:])) < n / 10


def test_shards_of_odd_rows(spark):
    docs = documents(spark)
    rows = sharding.sharded(docs, 4).collect()
    assert len(rows) == len(TEXTS)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    again = sharding.sharded(docs.repartition(5), 4).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert sharding.sharded(documents(spark, [])).count() == 0


# --- packing


def check_packing(rows, texts, sequence):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter()
    for i, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for k in range(0, len(ids), sequence):
            cut = ids[k : k + sequence]
            want[(i, k, len(cut), zlib.crc32(cut.tobytes()), len(ids))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    windows = collections.defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for own in windows.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= sequence
    return sum(r.length for r in rows) / (sequence * len(windows))


def test_packing_of_odd_rows(spark):
    for sequence, most in ((64, 2), (4096, 64)):
        rows = packing.packed(documents(spark), TOKENIZER, sequence, most).collect()
        check_packing(rows, TEXTS, sequence)
    assert packing.packed(documents(spark, []), TOKENIZER).count() == 0


def test_packing_of_added_tokens_and_unspaced_texts(spark):
    rows = [(1, "x <|endoftext|> y"), (2, "x<|endoftext|>y <|ENDOFTEXT|>, <|startoftext|>"), (3, "ab1é中" * 5000), (4, "a" * 9000)]
    check_packing(packing.packed(documents(spark, rows), TOKENIZER).collect(), rows, 4096)


def test_packing_query(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = REGISTRY["op9_bounded_packing"][0](spark, SF).collect()
    assert check_packing(rows, texts, 4096) > 0.95


def test_number_of_open_windows_is_kept():
    draw = np.random.default_rng(2)
    rows = [(i, 0, int(n)) for i, n in enumerate(draw.integers(1, 100, 500))]
    placed = list(packing.pack(iter(rows), 100, 4))
    assert sorted(r for r, *_ in placed) == rows
    assert len({w for _, w, _, still in placed if still}) <= 4
    used = collections.Counter()
    for row, window, offset, _ in placed:
        assert offset == used[window]
        used[window] += row[2]
    assert max(used.values()) <= 100


# --- the pipeline


def test_pipeline_stages(spark):
    docs, counts = documents(spark, [*TEXTS, *[(100 + i, t) for i, t in near_copies(60, 1)]]), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stored(stage(spark, docs, SF), name)
        assert left.columns == docs.columns
        assert left.exceptAll(docs).isEmpty()
        docs = left
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    own = {i: t for i, t in texts if i is not None}
    assert groups(own.items()) == {i: (n, i) for i, (n, _) in groups(own.items()).items()}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packing(rows, texts, 4096)


def test_pipeline_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "packing"]
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 100
