import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import packing
from sluice.llm.queries import vocabulary

VOCABULARY = vocabulary("word_bpe_49k.json")


def library_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    return t.encode(text or "", add_special_tokens=False).ids + [2]


TEXTS = [
    None,
    "",
    " \n\t ",
    "Plain words, it's 2024!",
    "Ünïcödé é   ÉTÉ \x1c x <|endoftext|> 漢字 🙂",
    "long " * 9000,
    "a" * 5000,
    "same",
    "same",
]


def check(rows, docs):
    """Every id lies in one piece and sequences have no gap or overlap."""
    spans, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    for doc_id, text in docs:
        ids, at = library_ids(text), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            piece = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert zlib.crc32(piece) == r.ids_crc32
            at += r.length
        assert at == len(ids)


def test_pieces_cover_every_text(docs):
    rows = list(enumerate(TEXTS))
    check(packing.pack_documents(docs(rows), VOCABULARY).collect(), rows)


def test_repeated_and_null_ids(docs):
    rows = [(1, "one two"), (1, "one two"), (None, "x"), (None, None)]
    got = packing.pack_documents(docs(rows), VOCABULARY).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (0, 2), (1, 3), (1, 3)]


def test_empty_table(docs):
    assert packing.pack_documents(docs([]), VOCABULARY).collect() == []


@pytest.mark.parametrize("window", [1, 7, 64])
def test_best_fit_decreasing_against_a_plain_search(window):
    draw = random.Random(window)
    lengths = [draw.randint(1, window) for _ in range(400)]
    sequence, offset, count = packing.best_fit_decreasing(lengths, window)
    left: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [c for c in left if c >= lengths[i]]
        if fits:
            tightest = min(fits)
            left.remove(tightest)
            left.append(tightest - lengths[i])
        else:
            tightest = window
            left.append(window - lengths[i])
        assert offset[i] == window - tightest
    assert count == len(left)


def test_little_padding(spark):
    from sluice.llm.common import documents

    rows = packing.pack_documents(documents(spark, "/root/testdata/sf0.01"), VOCABULARY).collect()
    sequences = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) > 0.9 * packing.WINDOW * sequences
