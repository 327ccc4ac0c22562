import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import fingerprints as fp


@settings(max_examples=200, deadline=None)
@given(st.text("abé🙂", max_size=40), st.text("abé🙂", max_size=40), st.data())
def test_spans_and_extensions_against_the_texts(a, b, data):
    x, y = fp.PrefixHashes(a), fp.PrefixHashes(b)
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    plain = 0
    while i + plain < len(a) and j + plain < len(b) and a[i + plain] == b[j + plain]:
        plain += 1
    assert x.extension(i, y, j) == plain
    n = data.draw(st.integers(0, min(len(a) - i, len(b) - j)))
    assert x.equal(i, y, j, n) == (a[i : i + n] == b[j : j + n])


def test_long_text_tables_agree_with_plain_arithmetic():
    draw = random.Random(4)
    text = "".join(draw.choices("abcdé漢🙂 ", k=40_000))
    hashes = fp.PrefixHashes(text)
    for start, end in ((0, 40_000), (39_000, 40_000), (17, 18)):
        want = 0
        for base, prime in zip(fp.BASES, fp.PRIMES, strict=True):
            part = 0
            for c in reversed(text[start:end]):
                part = (part * base + ord(c) + 1) % prime
            want = want << 31 | part
        assert hashes.span(start, end) == want
    assert hashes.windows(30_000).tolist() == [hashes.span(i, i + fp.WIDTH) for i in range(30_000, 40_000 - fp.WIDTH + 1)]
    again = fp.PrefixHashes(text[1234:], hashes, 1234)
    assert all((x == y).all() for x, y in zip(hashes.sums, again.sums, strict=True))


def plain(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, following)
    return out


def true_likeness(a, b):
    spans = [{t[i : i + fp.WIDTH] for i in range(max(1, len(t) - fp.WIDTH + 1))} if t else set() for t in (a, b)]
    return len(spans[0] & spans[1]) / len(spans[0] | spans[1]) if spans[0] | spans[1] else 1.0


@pytest.mark.parametrize("count", [1, 2, 40, 700])
def test_against_a_plain_walk(docs, count):
    draw = random.Random(count)
    words = ["".join(draw.choices("abcdeü漢🙂", k=6)) for _ in range(300)]
    texts = [None, "", "a", "abc", "z" * 30_000] + [" ".join(draw.choices(words, k=draw.choice([1, 5, 60]))) for _ in range(count)]
    draw.shuffle(texts)
    rows = list(zip(draw.sample(range(-count, 5 * count + 5), count), texts[:count], strict=True))
    want = plain(rows)
    got = fp.fingerprint_documents(docs(rows)).collect()
    assert len(got) == len(want)
    for r in got:
        n, edited_sha, text, edited, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, edited_sha)
        assert abs(r.near_edited - true_likeness(text, edited)) < 0.3
        assert abs(r.near_next - true_likeness(text, following)) < 0.3
        same = next((i for i, (a, b) in enumerate(zip(text, edited, strict=False)) if a != b), min(len(text), len(edited)))
        assert r.same_prefix == same
    by_text = {}
    for r in got:
        assert by_text.setdefault(want[r.doc_id][2], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_null_and_repeated_ids(docs):
    got = fp.fingerprint_documents(docs([(None, "aaaaaa"), (None, None), (4, "b" * 9), (4, "b" * 9), (9, "c")])).collect()
    assert sorted(((r.doc_id or 0), r.n_chars) for r in got) == [(0, 0), (0, 6), (4, 9), (4, 9), (9, 1)]
    assert fp.fingerprint_documents(docs([(None, "aaaaaa")])).count() == 1
    assert fp.fingerprint_documents(docs([])).collect() == []
