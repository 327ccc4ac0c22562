import hashlib
import random

import numpy as np
import pytest

from sluice.llm import blocks, suffixes


def plain(rows):
    """Brute force over every 100-byte string in order of (doc_id, start)."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            window = raw[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, count):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdeéü", k=draw.randint(1, 9))) for _ in range(80)]
    passages = [" ".join(draw.choices(words, k=draw.choice([10, 25, 40, 90]))) for _ in range(6)]
    texts = [None, "", "x" * 99, "x" * 100, "x" * 101, "ab" * 500, "é" * 333]
    while len(texts) < count:
        kind = draw.random()
        own = " ".join(draw.choices(words, k=draw.choice([3, 30, 120])))
        if kind < 0.15:
            texts.append(draw.choice(texts))
        elif kind < 0.4:
            base = draw.choice(texts) or ""
            i = draw.randrange(len(base) + 1)
            texts.append(base[:i] + draw.choice(["", "#", own]) + base[i + draw.choice([0, 1, 3]) :])
        elif kind < 0.8:
            texts.append(own + draw.choice(["", " "]) + draw.choice(passages) + own[::-1])
        else:
            texts.append(own)
    return list(zip(draw.sample(range(10 * count), count), texts[:count], strict=True))


def test_the_cover_meets_every_pair_of_positions():
    offsets = {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER}
    assert len(offsets) == suffixes.PERIOD


@pytest.mark.parametrize("block, entries", [(8 << 20, 4_000_000), (3000, 500)])
def test_against_brute_force(docs, monkeypatch, block, entries):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(blocks, "BUCKET_ENTRIES", entries)
    rows = corpus(block, 160)
    got = suffixes.remove_repeats(docs(rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain(rows)
    assert all(sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed and len(r.spans) == 2 * r.n_spans for r in got)


def test_null_and_repeated_ids(docs):
    text = "some words that are long enough " * 4
    within = plain([(1, text)])[0][2]
    got = suffixes.remove_repeats(docs([(5, text), (5, text), (None, text), (2, text), (1, "short"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 128), (1, 0), (2, within), (5, 128), (5, 128)]
    assert suffixes.remove_repeats(docs([])).collect() == []


def test_cut_keeps_columns_and_whole_characters(docs):
    passage = "é" * 30 + "".join(chr(0x400 + i) for i in range(60))
    source = docs([(1, "a" + passage + "b"), (2, "cc" + passage + "d"), (3, passage), (4, None), (5, "own")])
    got = suffixes.cut_repeats(source)
    assert got.columns == source.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert {i: r.text for i, r in rows.items()} == {1: "a" + passage + "b", 2: "ccd", 4: None, 5: "own"}
    assert rows[2].n_chars == 3
