import zlib

import numpy as np
import pytest

from sluice.llm import rans
from sluice.llm.queries import vocabulary

VOCABULARY = vocabulary("byte_bpe_50k.json")


def library_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    return t.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 5000, 300_001])
@pytest.mark.parametrize("kind", ["one", "flat", "skewed"])
def test_block_round_trip(n, kind):
    draw = np.random.default_rng(n)
    ids = {"one": np.zeros(n, int), "flat": draw.integers(0, 50_000, n), "skewed": draw.geometric(0.01, n)}[kind]
    table = rans.Table.from_counts(np.bincount(ids, minlength=50_257))
    payload = rans.encode_block(ids, table)
    assert (rans.decode_block(payload, table) == ids).all()
    if n > 200_000:
        some = rans.decode_block(payload, table, slice(1, 2))
        width = rans.LANES * rans.CHECKPOINT_STEPS
        assert (some == ids[width : 2 * width]).all()
        if kind == "skewed":
            assert len(payload) < 1.2 * n + 40_000  # about 8 bits an id
    if n > 63 and kind != "one":
        damaged = bytearray(payload)
        damaged[-3] ^= 8
        with pytest.raises(ValueError):
            rans.decode_block(bytes(damaged), table)


def test_crc_of_joined_strings():
    a, b = b"first part", b"\x00second" * 99
    assert rans.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert rans.crc32_combine(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


TEXTS = [
    "Plain words, it's 2024!",
    None,
    "",
    "  two\n\n lines \t x y \x1cz  ",
    "Ünïcödé ÉTÉ <|endoftext|> 漢字 🙂 don't",
    "word " * 7000,
    "same",
    " same",
]


@pytest.mark.parametrize("block", [rans.BLOCK_TOKENS, 700])
def test_documents_come_back(docs, monkeypatch, block):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", block)
    rows = [(7 * i % 11, t) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in rans.round_trip(docs(rows), VOCABULARY).collect()}
    at = 0
    for doc_id, text in sorted(rows):
        ids = library_ids(text)
        r = got.pop(doc_id)
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert not got


def test_empty_table_and_repeated_rows(docs):
    assert rans.round_trip(docs([]), VOCABULARY).collect() == []
    got = rans.round_trip(docs([(1, "x"), (1, "x"), (None, None)]), VOCABULARY).collect()
    assert sorted((r.start, r.n_tokens, r.doc_id) for r in got) == [(0, 1, None), (1, 2, 1), (3, 2, 1)]
