"""Operators that look at every text alone: licences, quality, language, byte-level BPE, HTML."""

import base64
import hashlib
import html.parser
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import LONG, SENTENCE, TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landgate.llm import byte_bpe, html_text, language, licenses, quality, words
from landgate.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tiktoken_ids():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def texts_of(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=6))
def test_word_spans_and_hashes(column):
    pattern = re.compile(r"[^\x20\x09-\x0D]+")
    got, hashes = [], {}
    for texts in words.slices(pa.array(column, pa.string()), size=16):
        found = words.spans(texts, words.NOT_SPACE[texts.data])
        for a, b, h in zip(found.start, found.end, words.span_hashes(texts.data, found), strict=True):
            word = texts.data[a:b].tobytes()
            got.append(word.decode())
            assert hashes.setdefault(word, h) == h
    assert got == [w for t in column for w in pattern.findall(t or "")]
    assert len(set(hashes.values())) == len(hashes)


# --- licences


def places(text):
    w = licenses.split(text or "")
    return w, sorted(
        (i, label)
        for phrase, label in licenses.BASE.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    )


def matching_statistics(sequences, stream):
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    return [max((n for n in range(i + 2) if n == 0 or tuple(stream[i + 1 - n : i + 1]) in runs)) for i in range(len(stream))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=8), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=20))
def test_matching_statistics_against_all_runs(sequences, stream):
    automaton = licenses.SuffixAutomaton(sequences)
    got = [length for _, length in automaton.statistics(stream)]
    assert got == matching_statistics(sequences, stream)
    for i, (state, length) in enumerate(automaton.statistics(stream)):
        ends = {(k, at): n for k, at, n in automaton.endings(state, length)}
        for k, s in enumerate(sequences):
            for at in range(len(s)):
                n = 0
                while n <= min(i, at) and s[at - n] == stream[i - n]:
                    n += 1
                assert ends.get((k, at), 0) == n


def test_licence_base_places(spark):
    for rows, docs in ((TEXTS, documents(spark)), (texts_of(spark, SF), spark.read.parquet(f"{SF}/documents.parquet"))):
        got = licenses.license_spans(docs).collect()
        assert len(got) == len(rows)
        want = sorted((str(i), len(places(t)[0]), places(t)[1]) for i, t in rows)
        assert sorted((str(r.doc_id), r.n_words, sorted((b.start, b.label) for b in r.base)) for r in got) == want


def test_licence_spans():
    mit = licenses.TEMPLATES[0][1].split()
    broken = " ".join([*mit[:20], "oddly", *mit[20:30], *mit[34:]])
    got = licenses.Scanner().measure(pa.array([f"x {broken} y", " ".join(mit[:20]), "gnu general public license version"]))
    assert [[s["label"] for s in own] for own in got["spans"]] == [["mit"], [], []]
    span = got["spans"][0][0]
    assert (span["start"], span["end"]) == (1, 1 + len(mit) - 3)
    assert 0.75 <= span["covered"] < 1


@pytest.mark.parametrize("k", range(1, 6))
def test_licence_spans_without_a_short_phrase(k):
    mit = licenses.TEMPLATES[0][1].split()
    texts = [" ".join([*mit[:i], *mit[i + k :]]) for i in range(len(mit) - k + 1)]
    for text, own in zip(texts, licenses.Scanner().measure(pa.array(texts))["spans"], strict=True):
        assert [s["label"] for s in own] == ["mit"], text
        assert own[0]["covered"] <= (len(mit) - k) / len(mit) + 1e-9


def test_every_notice_gets_its_own_label_alone():
    others = "some other words stand here"
    for label, text in licenses.TEMPLATES:
        words_ = text.split()
        cases = [text, f"{others} {text} {others}"]
        if len(words_) > 2 * licenses.SHORT:
            cases.append(" ".join([*words_[:8], "oddly", *words_[8:]]))
            cases.append(" ".join([*words_[:-4]]))
        for case, own in zip(cases, licenses.Scanner().measure(pa.array(cases))["spans"], strict=True):
            assert {s["label"] for s in own} == {label}, case


@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"cc-by-sa"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", {"cc-by-nc"}),
    ("licensed under a Creative Commons Attribution 3.0 Unported License, code under the BSD or GNU Lesser General Public License",
     {"cc-by", "lgpl"}),
    ("CC BY-NC-ND 4.0", {"cc-by-nc-nd"}),
    ("the GNU Affero General Public License version 3", {"agpl"}),
    ("licensed under a creative writing course of the general public", set()),
])
def test_notices_as_they_are_written(text, labels):
    assert {s["label"] for s in licenses.Scanner().measure(pa.array([text]))["spans"][0]} == labels


def test_very_many_notices_in_one_text():
    text = "code licensed under the mit license and texts licensed under a creative commons attribution sharealike license so " * 20000
    start = time.time()
    spans = licenses.Scanner().measure(pa.array([text]))["spans"][0]
    assert len(spans) == 40000 and {s["label"] for s in spans} == {"mit", "cc-by-sa"}
    assert time.time() - start < 60


def longest_runs(sequences, stream, least):
    """(sequence, text start, place, words) of all common runs that go on to neither side."""
    found = set()
    for k, s in enumerate(sequences):
        for i in range(len(stream)):
            for j in range(len(s)):
                if i and j and stream[i - 1] == s[j - 1]:
                    continue
                n = 0
                while i + n < len(stream) and j + n < len(s) and stream[i + n] == s[j + n]:
                    n += 1
                if n >= least:
                    found.add((k, i, j, n))
    return found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=3, max_size=9), min_size=1, max_size=4), st.text("abcd", max_size=25))
def test_runs_against_all_common_runs(templates, text):
    scanner = licenses.Scanner((), tuple((str(k), " ".join(t)) for k, t in enumerate(templates)))
    _, runs = scanner.scan(scanner.numbers(np.array([], np.uint64)).tolist())
    assert runs == {}
    known = {w: i for i, w in enumerate(sorted({w for t in templates for w in t}))}
    _, runs = scanner.scan([known.get(w, len(known)) for w in text])
    got = {(k, *run) for k, own in runs.items() for run in own}
    assert got == longest_runs(templates, text, licenses.MIN_RUN)


def test_licence_query(spark):
    rows = REGISTRY["op1_suffix_automaton"][0](spark, SF).collect()
    text = dict(texts_of(spark, SF))
    for r in rows:
        _, base = places(text[r.doc_id])
        assert r.n_base == len(base)
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


# --- quality


def test_quality_of_odd_texts(spark):
    got = {(r.doc_id, r.n_words): r for r in quality.quality_measures(documents(spark)).collect()}
    assert got[(4, 0)].base_failed and not got[(5, 0)].kept and not got[(6, 0)].kept
    assert got[(7, 60_000)].word_chars == len(LONG.replace(" ", ""))
    assert got[(8, 4)].word_chars == 11
    assert got[(1, 20)].kept
    assert quality.quality_measures(documents(spark, [])).count() == 0
    kept = quality.keep_good(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 7]


def test_lines_are_judged_first():
    good = SENTENCE + "."
    junk = "home | about | news | contact |"
    text = "\n".join([good, junk, "Accept cookies to go on", "*** ### $$$", good, "short line", ""])
    got = quality.measure(pa.array([text]))
    assert (got["n_lines"][0], got["n_bad_lines"][0], got["n_dup_lines"][0]) == (6, 4, 1)
    assert quality.clean_lines(pa.array([text, None, "\n\n"])).to_pylist() == [f"{good}\nshort line\n", None, "\n\n"]
    lost = quality.measure(pa.array([SENTENCE + "\n" + " | ".join(f"item{i}" for i in range(30))]))
    assert not lost["kept"][0] and not lost["base_failed"][0]


# --- language


@pytest.mark.parametrize("group", [1, 2, 3, 100])
def test_sums_in_groups_of_blocks_are_those_of_all_words(group):
    draw = np.random.default_rng(group)
    text = np.repeat([0, 2, 3, 4, 7], [1, 700, 64, 65, 3])
    emission, word = draw.normal(size=(40, 4)) * 3, draw.integers(0, 40, len(text))
    transition = draw.normal(size=(4, 4))
    p, _ = language.marginals(emission[word], transition, text, 9)
    want = np.stack([np.bincount(text, weights=p[:, k], minlength=9) for k in range(4)], axis=1)
    got = language.label_sums(emission, word, transition, text, 9, group)
    assert np.allclose(got, want) and np.allclose(got.sum(axis=1), np.bincount(text, minlength=9))


def test_a_very_long_text_is_labelled_in_bounded_memory():
    draw = np.random.default_rng(1)
    field = language.Field(list("abcdef"), draw.normal(size=(1 << language.TABLE_BITS, 6)), draw.normal(size=(6, 6)))
    some = ["".join(draw.choice(list("abcdefghij"), 5)) for _ in range(2000)]
    text = pa.array([" ".join(some[i] for i in draw.integers(0, 2000, 500_000))])
    tracemalloc.start()
    try:
        found = field.measure(text)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found["lang_pred"]) == 1 and peak < 150e6


def test_forward_backward_against_steps():
    draw = np.random.default_rng(3)
    emission, text = draw.normal(size=(260, 3)), np.repeat([0, 2, 3], [1, 195, 64])
    transition = draw.normal(size=(3, 3))
    p, pairs = language.marginals(emission, transition, text, 4)
    a, total = np.exp(transition), np.zeros((3, 3))
    for t in (0, 2, 3):
        e = np.exp(emission[text == t])
        forward, backward = [], [np.ones(3)]
        before = np.ones(3)
        for row in e:
            forward.append(before)
            before = (before @ a) * row
            before /= before.sum()
        for row in e[:0:-1]:
            backward.append(a @ (row * backward[-1]) / (row * backward[-1]).sum())
        backward.reverse()
        for f, row, b, got in zip(forward, e, backward, p[text == t], strict=True):
            joint = f[:, None] * a * (row * b)[None, :]
            total += joint / joint.sum()
            assert np.allclose(joint.sum(axis=0) / joint.sum(), got)
    assert np.allclose(total, pairs)


def test_language_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = REGISTRY["op5_crf_language"][0](spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert 150 < len(held) < 350
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_code_switched_words():
    draw = np.random.default_rng(0)
    vocabulary = {"xx": [f"za{i}q" for i in range(40)], "yy": [f"mo{i}w" for i in range(40)]}
    pieces = [(k, list(draw.choice(v, 12))) for k, v in vocabulary.items() for _ in range(60)]
    field = language.fitted(sorted(pieces))
    mixed = " ".join([*vocabulary["xx"][:30], *vocabulary["yy"][:10]])
    got = field.measure(pa.array([mixed, "zaq moq", None, "12 + 3", "😀"]))
    assert got["lang_pred"][0] == "xx" and abs(got["score"][0] - 0.75) < 0.1
    assert got["lang_pred"][2:] == ["und"] * 3 and got["score"][2:] == [0.0] * 3


def test_every_labelled_language_is_learned(spark):
    """Unspaced scripts, texts of one or two words, and far more rows of one language than are sampled."""
    draw = np.random.default_rng(1)
    signs = {"zh": "的一是不了人我在有他这中大来上国", "th": "กขคงจฉชซญฐณดตถทธนบปผฝ", "xx": "abcdefg"}
    rows = [(i, "".join(draw.choice(list(signs[k]), 30)) + "。", k) for i, k in enumerate(["zh", "th", "xx"] * 60)]
    rows += [(1000 + i, "una casa en el campo y la playa", "es") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {lang for lang, _ in language.sample(docs)} == {"zh", "th", "xx", "es"}
    got = {r.doc_id: r.lang_pred for r in language.identified(docs).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.98 * len(rows)


def test_language_of_odd_rows(spark):
    got = {r.doc_id: r for r in language.identified(documents(spark)).collect()}
    assert got[4].lang_pred == got[5].lang_pred == "und"
    assert got[1].lang_pred == "en"
    assert language.identified(documents(spark, [])).count() == 0
    unlabelled = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identified(unlabelled).collect()} == {"und"}


# --- byte-level BPE

BYTE_TEXTS = [t for _, t in TEXTS] + [" ", "  ", "x ", "a\x1cb", "日本語 テキスト", "aaaa" * 500, "don't IT'S 123 456!!", "\u0085 a", "e\u0301 ́"]


def test_bpe_equals_the_library(spark, tiktoken_ids):
    rows = [(i, t) for i, t in enumerate(BYTE_TEXTS)]
    got = {r.doc_id: r for r in byte_bpe.encoded(documents(spark, rows), RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in rows:
        assert got[i].ids == tiktoken_ids(text or "")
        assert bytes(got[i].decoded) == (text or "").encode()


def test_bpe_query(spark, tiktoken_ids):
    text = dict(texts_of(spark, SF))
    for r in REGISTRY["op10_two_tier_bpe"][0](spark, SF).collect():
        ids = np.array(tiktoken_ids(text[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_bpe_of_any_text(tiktoken_ids, text):
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    ids = codec.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == tiktoken_ids(text)
    assert codec.decode(ids) == text.encode()


def test_bpe_of_unspaced_and_no_texts(spark, tiktoken_ids):
    text = "ab1é中.x" * 3000
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    before = codec.known_pieces.lasting
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == tiktoken_ids(text)
    assert codec.known_pieces.lasting == before
    assert byte_bpe.digests(documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_perfect_hash_is_perfect():
    keys = [f"key{i}".encode() for i in range(3000)]
    table = byte_bpe.PerfectHash(keys)
    assert table.find(keys).tolist() == list(range(3000))
    assert sorted(table.key_at.tolist()) == list(range(3000))
    assert set(table.find([b"other", b"none"]).tolist()) <= set(range(3000))


# --- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p></div>
<article><h1>A &amp; B</h1><p><b>First   par&shy;t<br>goes&nbsp;on<p>Second <i>one</i>.
<aside>Related</aside><div class="ad">Buy</div><script>var t="</p>";</script><p>End.
<section id="comments"><p>Nice!</p></section></article>
<form><p>Mail</p></form><footer>&copy; us</footer></body></html>"""


def test_article_of_a_page():
    assert html_text.main_text(PAGE) == "A & B\nFirst par\u00adt goes on\nSecond one.\nEnd."


def test_pages_without_a_marked_article():
    body = "some words of the story that go on for quite a while and then end. " * 4
    page = f"<body><div><a href=x>One</a><a href=y>Two</a></div><h2>Head</h2><p>{body}<p>Short.<p>{body}</p>"
    page += "<div>.</div>" * 5 + "<ul><li><a href=z>Next page</a></li></ul>"
    assert html_text.main_text(page).split("\n")[:2] == ["Head", body.strip()]
    assert "Short." in html_text.main_text(page) and "Next" not in html_text.main_text(page)
    assert html_text.main_text("just text") == "just text"


def test_short_and_linked_blocks_between_surge_and_dive_stay():
    body = "some words of the story that go on for quite a while and then end. " * 4
    middle = ["First item", "Second", "Third", "Fourth"]
    items = "".join(f"<li>{m}</li>" for m in middle)
    page = f"<div><a href=x>Home</a></div><div><a href=y>About</a></div><h1>Title</h1><div>By me</div><p>{body}</p><ul>{items}</ul>"
    page += f"<p><a href=z>See the long report</a></p><p>{body}</p><p>Thanks.</p><p>Good night.</p><p>The end.</p>"
    page += "".join(f"<div><a href={i}>Menu {i}</a></div>" for i in range(5)) + "<div>Imprint</div>"
    want = ["Title", "By me", body.strip(), *middle, "See the long report", body.strip(), "Thanks.", "Good night.", "The end."]
    assert html_text.main_text(page).split("\n") == want
    assert html_text.main_text("<p>One<p><a href=x>two &amp; more</a><p>three<p><a href=y>Next</a>") == "One\ntwo & more\nthree"
    assert html_text.main_text("<p>ab <a href=x>    cd    </a>") == "ab cd"


BODY = "some words of the story that go on for quite a while and then end."


@pytest.mark.parametrize("mark", ["article", "div"])
@pytest.mark.parametrize(
    "element",
    [
        'div class="elementor-widget-container"', 'div class="article-header"', 'section id="related-work"',
        'h2 id="legal-notice"', 'h2 id="form-validation"', 'p class="search-result"', 'div class="has-sidebar"',
        'span class="form"', 'div class="header"', 'div id="side_story"',
    ],
)
def test_words_of_a_name_take_no_text_away(mark, element):
    page = f"<{mark}><p>{BODY * 3}</p><{element}>Kept {BODY}</{element.split()[0]}><p>{BODY * 3}</p></{mark}>"
    assert f"Kept {BODY}" in html_text.main_text(page)


def test_names_and_lists_of_links_take_lines_away():
    links = "".join(f"<li><a href={i}>Other story {i}</a></li>" for i in range(4))
    for element in ('div class="x ad"', 'div class="cookie_notice"', 'section class="comments"', 'p class="promo"'):
        page = f"<article><p>{BODY}</p><{element}>Gone</{element.split()[0]}><p>End.</article>"
        assert html_text.main_text(page) == f"{BODY}\nEnd."
    for element in ('div class="post-related-box"', 'section class="widget"', 'ul class="share-list"'):
        page = f"<article><p>{BODY}</p><{element}><div>Also</div>{links}</{element.split()[0]}><p>End.</article>"
        assert html_text.main_text(page) == f"{BODY}\nEnd."
    for element in ('section id="legal"', 'h2 id="comments"', 'section id="search"'):
        page = f"<article><{element}>Kept</{element.split()[0]}><p>{BODY}</article>"
        assert html_text.main_text(page) == f"Kept\n{BODY}"
    headline = f'<article><div class="widget-header"><h1><a href=x>Title</a></h1></div><p>{BODY}</article>'
    assert html_text.main_text(headline) == f"Title\n{BODY}"


@pytest.mark.parametrize(
    "element",
    [
        'div style="overflow:hidden"', 'p aria-hidden="false"', 'p title="hidden gem"', 'p data-x="class=ad"', "p data-id='id=nav'",
        'a href="/x?id=nav"', 'a href="/hidden/x"', 'p title="a > b" data-role=search', "p title='x' alt=\"class='ad'\"",
    ],
)
def test_words_in_values_are_no_attributes(element):
    name = element.split()[0]
    page = f"<article><p>{BODY}</p><p>Some <{element}>kept words</{name}> here.<p>{BODY}</article>"
    assert html_text.main_text(page).replace("\n", " ") == f"{BODY} Some kept words here. {BODY}"


def test_hidden_and_comments_go_and_teasers_do_not_win():
    for element in ("p hidden", "div hidden=''", 'div class="comment"', 'li class="comment depth-1"', "section role=search"):
        page = f"<article><p>{BODY}</p><{element}>Gone</{element.split()[0]}><p>End.</article>"
        assert html_text.main_text(page) == f"{BODY}\nEnd."
    teaser = "<article><h3>Teaser</h3></article>" * 3
    assert html_text.main_text(f"<div><p>{BODY * 4}</p><p>{BODY}</p></div>{teaser}").startswith(BODY)
    assert html_text.main_text(f"<article><p>{BODY * 4}</article><p>{BODY}</p>") == BODY * 4


MEGABYTE = [
    '<p "', '<div class="ad">', "<a b='", "<script>", "</script", "<!", "<![CDATA[", "<!--", '<p a="b" c', "<", "<x1 class=ad>",
    "<b>", "text ", "<li hidden>", "= \"", "<p a = ", " ", "<style></style>", "&", "<td class='x y'><a href=1>z</a>",
]


@pytest.mark.parametrize("unit", MEGABYTE, ids=range(len(MEGABYTE)))
def test_a_megabyte_of_anything_is_read_in_time(unit):
    for page in (unit * (1_000_000 // len(unit)), unit * (1_000_000 // len(unit)) + ">"):
        start = time.process_time()
        html_text.main_text(page)
        assert time.process_time() - start < 12


class Walk(html.parser.HTMLParser):
    """A plain second reading of simple pages: blocks of an article outside of a few elements and classes."""

    def __init__(self):
        super().__init__()
        self.open, self.lines, self.parts = [], [], []

    def line(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag in html_text.BLOCKS and not any(gone for _, gone in self.open):
            self.line()
        gone = tag in ("nav", "aside", "footer", "script", "form") or "hidden" in own
        gone = gone or bool({"ad", "comment"} & set((own.get("class") or "").split()))
        self.open.append((tag, gone))

    def handle_endtag(self, tag):
        if tag in html_text.BLOCKS and not any(gone for _, gone in self.open):
            self.line()
        self.open.pop()

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.open) and not any(gone for _, gone in self.open):
            self.parts.append(data)


def elements(depth):
    words = st.sampled_from(["one ", "two &amp; ", "thr&eacute;e", " x&lt;y ", "\n", "é 中 "])
    attributes = st.sampled_from(
        ["", ' class="ad"', " class='big comment'", ' title="class=ad"', " hidden", ' data-hidden="x"', ' style="a:hidden"', ' id="x1"']
    )
    if not depth:
        return words
    names = st.sampled_from(["p", "div", "b", "span", "section", "nav", "aside", "h2", "i"])
    inner = st.lists(elements(depth - 1), max_size=4).map("".join)
    return st.one_of(words, st.builds(lambda n, a, t: f"<{n}{a}>{t}</{n}>", names, attributes, inner))


@settings(max_examples=150, deadline=None)
@given(st.lists(elements(3), max_size=6))
def test_article_against_a_walk_by_the_standard_parser(parts):
    page = f"<html><body><nav>Menu</nav><article>{''.join(parts)}</article><footer>Foot</footer></body></html>"
    walk = Walk()
    walk.feed(page)
    walk.close()
    assert html_text.main_text(page) == "\n".join(walk.lines)


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>x", "</div></p>", "<nav>x", "<div class=ad>x"])
def test_broken_pages(page):
    assert html_text.main_text(page) in ("", "<", "<p", "x")


def test_html_query(spark):
    rows = REGISTRY["op3_line_blocks"][0](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    for r in rows:
        assert r.n_chars == len(r.text) > 0
        assert "track(" not in r.text and "©" not in r.text
    odd = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x")], "page_id long, url string, html string, text string")
    assert [tuple(r) for r in html_text.extracted(odd).collect()] == [(1, None, "", 0)] * 2
