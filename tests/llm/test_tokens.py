import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import tokens
from sluice.llm.queries import vocabulary

KINDS = [("byte_bpe_50k.json", tokens.BYTE_LEVEL_CHUNK), ("word_bpe_49k.json", tokens.WORD_CHUNK)]
ALPHABET = st.sampled_from(list("abAB12é'.,;:!?\"()- \n\t_|<>") + ["'s", "'re", "don't", "́", "\x1c", " ", "漢", "🙂", "  ", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "<|endoftext|", "<|ENDOFTEXT|>"])


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(name))


@pytest.mark.parametrize("name, pattern", KINDS)
def test_chunks_give_the_ids_of_the_whole_text(name, pattern):
    own, whole = tokens.ChunkEncoder(vocabulary(name), pattern), library(name)

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(max_size=40), st.lists(ALPHABET, max_size=25).map("".join)))
    def run(text):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    run()


@pytest.mark.parametrize("name, pattern", KINDS)
def test_every_code_point(name, pattern):
    own, whole = tokens.ChunkEncoder(vocabulary(name), pattern), library(name)
    texts = [f"a{chr(c)}, b {chr(c)}.{chr(c)} c" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for text, e in zip(texts, whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == e.ids, ascii(text)


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 600)
    own, whole = tokens.ChunkEncoder(vocabulary(KINDS[0][0]), KINDS[0][1]), library(KINDS[0][0])
    for text in ("a b c d e f", "a b x y", "z", "a b c d e f"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name, pattern", KINDS)
def test_many_texts_at_once(name, pattern, monkeypatch):
    monkeypatch.setattr(tokens, "CHARACTERS_AT_ONCE", 50)
    own, whole = tokens.ChunkEncoder(vocabulary(name), pattern), library(name)
    texts = ["", "one  <|endoftext|>  two", "x" * 200, "<|startoftext|><|endoftext|>", " ", "a b c " * 30, "one two"]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


ODD = ["  a", "a  ", "a \n b", "a\n b", " a", "a <|endoftext|>  b", "a  <|endoftext|>", "　 　a", "a  b", "é  é", "é è", " ", "", None]


@pytest.mark.parametrize("name, pattern", KINDS)
def test_a_column_gives_the_ids_of_each_whole_text(name, pattern):
    own, whole = tokens.ChunkEncoder(vocabulary(name), pattern), library(name)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.sampled_from(ODD), st.lists(ALPHABET, max_size=25).map("".join)), max_size=6))
    def run(texts):
        ids, at = own.encode_column(pa.array([*ODD, *texts], pa.string()).slice(len(ODD) - 2), 7)
        for text, begin, end in zip([*ODD[-2:], *texts], at[:-1], at[1:], strict=True):
            assert ids[begin:end].tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 7]

    run()
    ids, at = own.encode_column(pa.array(ODD), 7)
    assert [ids[b:e].tolist() for b, e in zip(at[:-1], at[1:], strict=True)] == [[*whole.encode(t or "", add_special_tokens=False).ids, 7] for t in ODD]


@pytest.mark.parametrize("name, pattern", KINDS)
def test_every_letter_that_the_model_takes_directly(name, pattern):
    own, whole = tokens.ChunkEncoder(vocabulary(name), pattern), library(name)
    assert own.direct
    words = [w for c in range(0x3100) for w in (f"a{chr(c)}b", f"{own.blank}{chr(c)}") if tokens._WORD(w)]
    for word, e in zip(words, whole.encode_batch(words, add_special_tokens=False), strict=True):
        assert own._word(word) == e.ids, ascii(word)


@pytest.mark.parametrize("name, pattern", KINDS)
def test_a_piece_of_a_column_is_searched_for_chunks_once(name, pattern):
    own, searched = tokens.ChunkEncoder(vocabulary(name), pattern), []
    find = own.find
    own.find = lambda text: searched.append(text) or find(text)
    own.encode_column(pa.array(["one two, three " * 50] * 20), 0)
    assert sum(map(len, searched)) < 20 * len("one two, three ")
