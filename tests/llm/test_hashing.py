import random

import numpy as np

from sluice.llm import hashing


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    draw = random.Random(8)
    vocabulary = ["a", "B", "b", "é", "É", "word", "WORD", "x" * 300, "\x1c", "\x85", "漢字", "a\x00"]
    for size in (hashing.SLICE, 64):
        monkeypatch.setattr(hashing, "SLICE", size)
        text = "".join(draw.choice(vocabulary) + draw.choice([" ", "\t", "\n\r", "\x0b\x0c  "]) for _ in range(2000))
        words = text.encode().lower().split()
        got = hashing.word_hashes(text.encode()).tolist()
        assert len(got) == len(words)
        assert len(set(got)) == len(set(words)) == len(set(zip(got, words, strict=True)))
    assert len(hashing.word_hashes(b"")) == len(hashing.word_hashes(b" \n")) == 0
    assert hashing.word_hashes(b"one").dtype == np.uint64
