import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import alignment
from sluice.llm.queries import vocabulary

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
ODD = ["a", "B", " ", "  ", "\t", "\n", "é", "é", "漢字", "🙂", "\U0001fae8", "ꙮ", "\x00", "\x1c", "\x85", " ", "　", "▁", "<|endoftext|>", "<s>", "<0x41>", "don't", "x1", "١", ".", ";", "|", "﷽", "ﬁ", "'s", "-", "word", "0", "\r\n"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(vocabulary(FILES[0]))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=vocabulary(FILES[1]))


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*map(vocabulary, FILES))


def tokens(libraries, text):
    """Whole-text tokens of both sides as (id, bytes), or None."""
    first, second = libraries
    if not text:
        return None
    alphabet = alignment.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == raw and b"".join(t for _, t in b) == raw else None


def ranges(side):
    out, at = [], 0
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def plain(libraries, text):
    """(n_a, n_b, n_groups, n_links), digest and links of one text."""
    both = tokens(libraries, text)
    if both is None:
        return (0, 0, 0, 0), "", Counter()
    a, b = map(ranges, both)
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    groups, start = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)))
        start = cut
    links = Counter((i, j) for i, s, e in a for j, u, v in b if s < v and u < e)
    return (len(a), len(b), len(groups), sum(links.values())), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def whole(libraries, rows):
    found = [(i, *plain(libraries, text)) for i, text in rows]
    counts = Counter(p for *_, links in found for p in links)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    return sorted(
        (-1 if i is None else i, *numbers, sum(t for p, t in links.items() if counts[p] == most[p[0]]), sum(t * counts[p] for p, t in links.items()), digest)
        for i, numbers, digest, links in found
    )


def test_pieces_give_the_alignment_of_the_whole_text(libraries, aligner):
    @settings(max_examples=250, deadline=None)
    @given(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(ODD), max_size=14).map("".join)))
    def run(text):
        text = text.encode("utf-8", "ignore").decode()
        ((counts, digest, pairs, times),) = aligner.documents([text])
        numbers, want, links = plain(libraries, text)
        assert (tuple(counts), digest) == (numbers, want)
        assert {(int(p) >> 15, int(p) & 32767): int(t) for p, t in zip(pairs, times)} == links

    run()


def test_every_code_point(libraries, aligner):
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}c" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    for text, (counts, digest, *_) in zip(texts, aligner.documents(texts)):
        assert (tuple(counts), digest) == plain(libraries, text)[:2], ascii(text)


def test_no_piece_of_the_second_vocabulary_crosses_a_cut(libraries):
    second = libraries[1]
    pieces = [second.id_to_piece(i) for i in range(second.get_piece_size())]
    assert not [p for p in pieces if any(x != "▁" and y == "▁" for x, y in zip(p, p[1:]))]


def test_spans_are_cuts_and_bytes_refine_them():
    def ends(spans, sizes, last=()):
        begin, end = np.array(spans).T
        return alignment.token_ends(begin, end, np.array(sizes), np.isin(np.arange(len(sizes)), [*last, len(sizes) - 1])).tolist()

    # a character of 4 bytes shared by two tokens; tokens without width
    assert ends([(0, 1), (1, 5), (1, 5), (5, 6)], [1, 3, 1, 1]) == [1, 4, 5, 6]
    assert ends([(0, 2), (2, 2), (2, 2), (2, 5)], [2, 1, 1, 1]) == [2, 3, 4, 5]
    # two texts, one after the other; the second begins with a token without width
    assert ends([(0, 3), (3, 3), (3, 5)], [3, 1, 1], last=[0]) == [3, 4, 5]
    i, j = alignment.links_of(np.array([1, 3, 6]), np.array([2, 3, 4, 6]))
    assert list(zip(i, j)) == [(0, 0), (1, 0), (1, 1), (2, 2), (2, 3)]


def run(frame, **options):
    return alignment.align_documents(frame, *map(vocabulary, FILES), **options)


@pytest.mark.parametrize("hot_pairs, partitions", [(100_000, 1), (20, 4), (0, 3)])
def test_documents_equal_the_plain_version(docs, libraries, hot_pairs, partitions):
    rows = [(i, f"the cat sat on {w} mat, the {w}") for i, w in enumerate(["the", "a", "é", "漢字", "\U0001fae8", "two  blanks", "xyzzy"])]
    rows += [(50, None), (51, ""), (52, " "), (53, "a▁b c"), (54, "the cat"), (54, "the cat"), (None, "sat on"), (55, "<|endoftext|> the"), (56, "q" * 3000)]
    out = run(docs(rows, partitions), hot_pairs=hot_pairs)
    assert out.columns == COLUMNS
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in out.collect()) == whole(libraries, rows)


def test_long_texts_are_aligned_in_runs(monkeypatch, libraries):
    monkeypatch.setattr(alignment, "CHARACTERS_AT_ONCE", 40)
    monkeypatch.setattr(alignment, "CACHE_BYTES", 2000)
    own = alignment.Aligner(*map(vocabulary, FILES))
    texts = ["one two three " * 30, "short", "x" * 500, "long with a mark ▁ " * 9, "ends with blanks   " * 8, "   " * 60]
    for text, (counts, digest, pairs, times) in zip(texts, own.documents(texts)):
        numbers, want, links = plain(libraries, text)
        assert (tuple(counts), digest) == (numbers, want)
        assert {(int(p) >> 15, int(p) & 32767): int(t) for p, t in zip(pairs, times)} == links


def test_pieces_met_again_stay_when_the_cache_is_full(monkeypatch, libraries):
    monkeypatch.setattr(alignment, "CACHE_BYTES", 20_000)
    own, learnt = alignment.Aligner(*map(vocabulary, FILES)), []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda pieces: learnt.extend(pieces) or learn(pieces))
    texts = [f"often met é漢 once{i} " + " ".join(f"rare{i}x{k}" for k in range(20)) for i in range(12)]
    for text in texts:  # one call each, so the cache is full again and again
        ((counts, digest, pairs, times),) = own.documents([text])
        numbers, want, links = plain(libraries, text)
        assert (tuple(counts), digest) == (numbers, want)
        assert {(int(p) >> 15, int(p) & 32767): int(t) for p, t in zip(pairs, times)} == links
    assert len(own.place) < len(set(learnt))  # the rare ones went
    assert [learnt.count(p) for p in ("often", "met", "é漢")] == [1, 1, 1]


def test_an_empty_table_gives_no_rows(docs):
    assert run(docs([])).collect() == []


def test_without_any_tokens(docs):
    assert [tuple(r) for r in run(docs([(1, None), (2, "▁")])).orderBy("doc_id").collect()] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
