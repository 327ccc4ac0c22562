import base64
import hashlib
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN

from sluice.llm import bpe
from sluice.llm.queries import vocabulary

RANKS = vocabulary("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None,
    "",
    "   ",
    "Plain words, it's 2024!  Two\n\n lines\t\tx \x1c\x1d y\x85z\xa0q　w",
    "Ünïcödé éaux ÉTÉ <|endoftext|> 漢字かな 🙂👩‍👩‍👧 don't I'LL",
    "a" * 3000 + "b" * 2500,
    "abab" * 700 + " " + "xyz" * 400,
    "word " * 20_000,
    "same",
    "same",
]


def test_texts_against_the_library(docs, library):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in bpe.encode_documents(docs(rows), RANKS, PATTERN).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table_repeated_and_null_ids(docs):
    assert bpe.encode_documents(docs([]), RANKS, PATTERN).collect() == []
    got = bpe.encode_documents(docs([(1, "x y"), (1, "x y"), (None, None)]), RANKS, PATTERN).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 0), (1, 2), (1, 2)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, text):
    assert bpe.codec(RANKS, PATTERN).encode(text) == library.encode_ordinary(text)


def test_every_code_point_beside_a_word(library):
    own = bpe.codec(RANKS, PATTERN)
    for lo in range(0, 0x3100):
        if not 0xD800 <= lo < 0xE000:
            text = f"a{chr(lo)}b {chr(lo)}{chr(lo)} c"
            assert own.encode(text) == library.encode_ordinary(text), hex(lo)


def test_long_runs_by_heap_and_matrix_agree(library, monkeypatch):
    draw = random.Random(3)
    words = [bytes(draw.choices(b"abcdet", k=n)) for n in (5, 17, 40, 200, 1500)]
    own = bpe.codec(RANKS, PATTERN)
    by_matrix = own.encode_words(words)
    monkeypatch.setattr(bpe, "LONGEST_ROW", 2)
    assert own.encode_words(words) == by_matrix
    assert by_matrix == [library.encode_ordinary(w.decode()) for w in words]
