import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import bilinear, scoring
from sluice.llm.bilinear import END, RARE, Parameters, Scorer

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def plain(rows):
    """n_tokens, n_known, N and base score of each (doc_id, text) row."""
    counts = Counter()
    for i, text in rows:
        if not held(i):
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        t = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out.append((-1 if i is None else i, held(i), len(t), sum(w in counts for w in t), n, base))
    return out


def scored(frame, **options):
    options = {"classes": 40, "width": 6, "rounds": 2, **options}
    return scoring.score_documents(frame, scoring.held_out_fifth(F.col("doc_id")), **options)


def same(out, rows):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out.collect())
    want = sorted(plain(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-9)


def corpus(n=150, seed=1):
    """Texts in which a word depends on the one before it."""
    r = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        at, words = int(r.integers(30)), []
        for _ in range(int(r.integers(1, 120))):
            words.append(names[at].upper() if r.random() < 0.2 else names[at])
            at = (at * 3 + int(r.integers(3))) % 30
        rows.append((i, " ".join(words) + (f"\tonly{i}" if i % 4 == 0 else "")))
    return rows


@pytest.mark.parametrize("hot_words, partitions", [(1000, 1), (12, 5), (0, 3)])
def test_base_and_counts_equal_the_plain_version(docs, hot_words, partitions):
    rows = corpus(60) + [(900, None), (901, ""), (902, " \t\n\x0b\x0c\r "), (903, "w1  W1"), (903, "w1  W1"), (None, "w2 other"), (904, "é É \x1c x"), (905, "x" * 70 + " " + "x" * 70), (906, "X" * 70)]
    out = scored(docs(rows, partitions), hot_words=hot_words)
    assert out.columns == COLUMNS
    same(out, rows)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in out.collect())


def test_held_out_texts_score_above_the_base(docs):
    rows = corpus(400)
    out = scored(docs(rows), classes=64, width=8).where("held_out").toPandas()
    assert len(out) > 50
    assert out["score"].sum() / out["n_tokens"].sum() > out["base_score"].sum() / out["n_tokens"].sum() + 0.1


def test_repeated_rows_have_one_score(docs):
    out = scored(docs(corpus(40) + [(7, "w1 w2"), (7, "w1 w2")])).where("n_tokens = 3 AND doc_id = 7").collect()
    assert len(out) >= 2 and len({r.score for r in out if r.n_tokens == 3}) == 1


def test_an_empty_table_gives_no_rows(docs):
    assert scored(docs([])).collect() == []


def test_without_training_texts_nothing_is_known(docs):
    ids = [i for i in range(100) if held(i)][:5]
    out = scored(docs([(i, "a b") for i in ids])).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in out} == {(3, 0, 0)}
    assert all(abs(r.base_score) < 1e-9 and abs(r.score) < 1e-5 for r in out)


def test_long_texts_are_split_where_white_space_is(monkeypatch):
    raw = ("Ab c\td" + "e" * 50 + " f\n") * 20
    monkeypatch.setattr(scoring, "SLICE", 16)
    assert [w for words in scoring.words_of(raw.encode()) for w in words] == raw.encode().lower().split()


def model(classes=9, width=4, seed=2):
    r = np.random.default_rng(seed)
    frequency = r.random(classes)
    out = Parameters.start(frequency / frequency.sum(), width)
    out.flat[: len(out.flat) // 2] += r.normal(0, 1, len(out.flat) // 2).astype(np.float32)
    return out


def test_probabilities_of_every_context_sum_to_one_and_equal_the_definition():
    m = model()
    (words, targets, bias, first, second), _ = m.parts()
    s = Scorer(m)
    for a in range(9):
        for b in range(9):
            scores = (words[a] @ first + words[b] @ second) @ targets.T + bias
            want = scores - np.log(np.exp(scores.astype(np.float64)).sum())
            got = s.far[a] + s.near[b] - s.normaliser[a, b]
            np.testing.assert_allclose(got, want, atol=2e-4)
            assert abs(np.exp(got.astype(np.float64)).sum() - 1) < 1e-4


def test_contexts_stay_inside_their_text():
    ids = np.array([5, 6, END, END, 7, 8, 9, END])
    earlier, before = bilinear.contexts(ids, np.array([3, 1, 4]))
    assert before.tolist() == [END, 5, 6, END, END, 7, 8, 9]
    assert earlier.tolist() == [END, END, 5, END, END, END, 7, 8]


def test_training_moves_along_the_gradient_of_the_noise_contrastive_objective(monkeypatch):
    """One batch: each parameter's first step has the sign of a numeric derivative."""
    monkeypatch.setattr(bilinear, "NOISE", 5)
    m = model()
    frequency = np.full(9, 1 / 9)
    ids = np.array([3, 4, RARE, 5, END, 6, END])
    lengths = np.array([5, 2])
    random = np.random.default_rng(0)
    random.permutation(len(ids))
    noise = np.minimum(np.searchsorted(np.cumsum(frequency), random.random(5) * frequency.sum(), side="right"), 8)
    earlier, before = bilinear.contexts(ids, lengths)
    log_noise = np.log(5 / 9)

    def objective(flat):
        (words, targets, bias, first, second), _ = Parameters(9, 4, flat).parts()
        total = 0.0
        for a, b, w in zip(earlier, before, ids):
            h = words[a] @ first + words[b] @ second
            total -= np.log1p(np.exp(-(h @ targets[w] + bias[w] - log_noise)))
            total -= sum(np.log1p(np.exp(h @ targets[x] + bias[x] - log_noise)) for x in noise)
        return total

    start = m.flat.copy()
    bilinear.train(m, ids, lengths, frequency, seed=0)
    moved = (m.flat - start)[: len(start) // 2]
    for at in range(0, len(start) // 2, 7):
        up, down = start.astype(np.float64), start.astype(np.float64)
        up[at] += 1e-5
        down[at] -= 1e-5
        slope = (objective(up) - objective(down)) / 2e-5
        if abs(slope) > 1e-3:
            assert np.sign(moved[at]) == np.sign(slope), at


def test_the_average_of_parameters_does_not_depend_on_grouping():
    r = np.random.default_rng(0)
    parts = [np.concatenate([[n], r.normal(size=6)]).tobytes() for n in (1.0, 5.0, 2.0, 9.0)]
    whole = np.frombuffer(scoring._average(parts))
    halves = np.frombuffer(scoring._average([scoring._average(parts[:1]), scoring._average(parts[1:])]))
    np.testing.assert_allclose(whole, halves, rtol=1e-12)


def test_shares_of_all_words_sum_to_one():
    """A class's probability times a rare word's share, over every known word and one unknown."""
    words = scoring.Vocabulary([b"a", b"", b"b"], np.array([7, 5, 2]), 3, scoring.Totals(20, 6))
    frequency = words.frequency()
    assert abs(frequency.sum() - 1) < 1e-12 and words.class_of().tolist() == [2, END, RARE]
    # b (2), three more words with 6 training tokens, and one unknown
    rest = (2.5 + 6 + 3 * 0.5 + 0.5) / words.totals.mass
    assert abs(frequency[RARE] - rest) < 1e-12
