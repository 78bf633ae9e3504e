"""BPE by a contiguous array of ranks, next to the tokenizers library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from landgate.llm import rank_array_bpe
from landgate.llm.memory import Memory
from landgate.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = " 's\n\t  é😀́中文aab\0\x1c\x85\xa0　123'll.,ſͅⅷ²٣ﬀ᠎​"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def same(library, texts):
    codec = rank_array_bpe.codec(PATH)
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(ODD, max_size=40)), max_size=4))
def test_any_texts(library, texts):
    same(library, texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", " ", "a", "\n", "  ", "b c", "<|endof"]), max_size=9))
def test_strings_of_added_tokens(library, parts):
    same(library, ["".join(parts)])


def test_long_words(library):
    draw = random.Random(1)
    words = ["".join(draw.choices(signs, k=n)) for signs in ("ab", "a", "theandou", "äé中😀") for n in (127, 128, 129, 3000)]
    same(library, [*words, " ".join(words), "x".join(words)])
    merges = rank_array_bpe.codec(PATH).merges
    assert merges.in_order
    for n in (2, 3, 5, 60, 200):
        for signs in ("ab", "a", "theandou", "ing"):
            word = "".join(draw.choices(signs, k=n))
            token, boundary = merges.one_at_a_time(word)
            assert merges.all_of_a_rank(word) == token
            ends = [*boundary[1:], len(word)]
            assert [merges.token[word[a:b]] for a, b in zip(boundary, ends, strict=True)] == token


def test_merges_out_of_order_go_one_at_a_time():
    vocabulary = {s: i for i, s in enumerate(["a", "b", "c", "ab", "abc", "bc"])}
    merges = rank_array_bpe.Merges(vocabulary, ["ab c", "a b", "b c"])
    assert not merges.in_order
    assert merges.merged("abcbc" * 100) == [4, 5] * 100


def test_bytes_that_are_no_utf8(library):
    codec = rank_array_bpe.codec(PATH)
    ids = [library.token_to_id(s) for s in ("Ġ", "Ã", "a", "ð", "Ł", "ĺ")]
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_memory_is_bounded_by_bytes():
    memory = Memory(10_000, 2_000, longest=600)
    for i in range(1000):
        memory.add(f"piece {i}", bytes(8))
        memory.add(f"{i}" * 1000, bytes(8))
        if i % 5 == 0:
            memory.forget()
    memory.forget()
    assert memory.lasting <= 10_000 and memory.passing <= 2_000
    assert "piece 0" in memory and "0" * 1000 not in memory and len(memory) < 60


def test_odd_rows(spark):
    got = {r.doc_id: r for r in rank_array_bpe.encoded(documents(spark), PATH).collect()}
    for i, text in TEXTS:
        if i is not None:
            assert got[i].decoded == (text or "") and list(got[i].ids or []) == Tokenizer.from_file(PATH).encode(text or "").ids
    assert rank_array_bpe.digests(documents(spark), PATH).count() == len(TEXTS)
    assert rank_array_bpe.digests(documents(spark, []), PATH).count() == 0


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in REGISTRY["op11_rank_array_bpe"][0](spark, SF).collect()}
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
