import random
import re

import numpy as np
import pytest

from sluice.llm import jaccard
from sluice.llm.common import Scratch
from sluice.llm.components import components


def plain_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_components(rows, size, percent):
    sets = {i: plain_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed, count):
    """Families of texts at all distances from their base, some sharing a passage, and odd ones."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=30)
    rows = [None, "", " \t\n", "one", "One", "one two", "one  two", "one two three", "A b c", "a B C"]
    while len(rows) < count:
        base = draw.choices(vocabulary, k=draw.choice([2, 4, 9, 20, 45, 80, 150, 300]))
        for _ in range(draw.choice([1, 1, 2, 5, 9])):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4, 9])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                words = passage + words
            if draw.random() < 0.3:
                words = words[: max(1, len(words) - draw.choice([1, 3, 8]))]
            rows.append(draw.choice([" ", "\n"]).join(words))
    ids = draw.sample(range(10 * count), count)
    return list(zip(ids, rows[:count], strict=True))


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_against_all_pairs(docs, size, percent):
    rows = corpus(size, 450)
    got = jaccard.near_groups(docs(rows), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows, size, percent)


def test_hot_keys_go_in_chunks(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    draw = random.Random(1)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.randrange(9)):
            words[draw.randrange(len(words))] = f"x{i}"
        rows.append((1000 - i, " ".join(words)))
    got = jaccard.near_groups(docs(rows), 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows, 3, 90)


def test_linked_sets_share_a_key_and_bits_bound_the_difference():
    draw = np.random.default_rng(5)
    for _ in range(600):
        percent = int(draw.choice([80, 90]))
        n = int(draw.choice([3, 6, 12, 30, 100, 900]))
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        drop, add = draw.integers(0, n // 6 + 2, 2)
        b = np.unique(np.concatenate([a[drop:], draw.integers(0, 2**63, add).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert np.bitwise_count(jaccard.bit_sketch(a) ^ jaccard.bit_sketch(b)).sum() <= apart
        wide = jaccard.bit_sketch(a, 8192)
        assert (jaccard.folded(wide, len(jaccard.bit_sketch(a))) == jaccard.bit_sketch(a)).all()
        bound = jaccard.pass_bound(len(a), wide, max(len(b), 1), jaccard.bit_sketch(b), percent)
        assert bound is not None or not len(b) or not jaccard.linked(a, b, percent)
        if len(b) and apart and jaccard.linked(a, b, percent):
            assert len(np.intersect1d(jaccard.sketch_keys(a, percent), jaccard.sketch_keys(b, percent)))


def test_null_and_repeated_ids(docs):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (3, "a b c d"), (7, None)]
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.near_groups(docs(rows), 3, 90).collect()), key=str)
    assert got == sorted([(None, None), (5, 3), (5, 3), (3, 3), (7, 7)], key=str)
    kept = jaccard.keep_one_of_each(docs(rows), 3, 90)
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, 3, 7], key=str)
    assert jaccard.near_groups(docs([])).collect() == []


def test_components_of_paths_and_stars(spark):
    draw = random.Random(2)
    ids = draw.sample(range(10_000), 400)
    edges = [(ids[i], ids[i + 1]) for i in range(0, 120)] + [(ids[200], ids[i]) for i in range(201, 300)] + [(ids[350], ids[350])] * 2
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), "c").collect()
    want = {i: min(ids[:121]) for i in ids[:121]} | {i: min(ids[200:300]) for i in ids[200:300]}
    assert {r.node: r.component for r in got} == want
    assert len(got) == len(want)


def test_candidates_lose_no_link_and_a_spanning_forest_joins_the_same_groups():
    draw = np.random.default_rng(6)
    for percent in (80, 90):
        base = draw.integers(0, 2**63, 200).astype(np.uint64)
        sets = []
        for _ in range(60):
            own = base[draw.random(200) < draw.choice([0.9, 0.97, 0.99])]
            sets.append(np.unique(np.concatenate([own, draw.integers(0, 2**63, int(draw.integers(0, 12))).astype(np.uint64)])))
        sets += [np.unique(draw.integers(0, 2**63, 150).astype(np.uint64)) for _ in range(10)]
        n = np.array([len(s) for s in sets])
        sketches = [jaccard.bit_sketch(s, 1024 if len(s) < 190 else 2048) for s in sets]
        group, side = np.arange(len(sets)), np.zeros(len(sets), bool)
        found = {tuple(sorted(p)) for p in jaccard.candidates(n, sketches, group, side, percent, False)}
        links = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard.linked(sets[i], sets[j], percent)}
        assert links and links <= found
        forest = list(jaccard.candidates(n, sketches, group, side, percent, True))
        assert {tuple(sorted(p)) for p in forest} <= found and len(forest) < len(sets)
        assert not [p for p in jaccard.candidates(n, sketches, np.zeros(len(sets), int), side, percent, False)]
        sides = np.arange(len(sets)) % 2 == 0
        across = {tuple(sorted(p)) for p in jaccard.candidates(n, sketches, group, sides, percent, False)}
        assert across == {(i, j) for i, j in found if sides[i] != sides[j]}


def test_texts_that_share_passages_meet_only_when_they_are_near(docs, spark):
    """Unrelated texts chained by shared passages: hardly any text goes to verification beyond those of real groups."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    passages = [draw.choices(words, k=60) for _ in range(40)]
    rows = []
    for i in range(600):
        body = draw.choices(words, k=60) + draw.choice(passages) + draw.choice(passages)
        rows.append((i, " ".join(body)))
    for i in range(60):
        rows.append((1000 + i, rows[i][1] + f" end{i}"))
    scratch = Scratch(spark, "shared-passages")
    got = jaccard.near_groups(docs(rows), 5, 80, scratch).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows, 5, 80)
    tried = sum(spark.read.parquet(scratch.path(name)).count() for name in ("tried-1", "pairs-2", "pairs-3"))
    assert 60 <= tried <= 120


def test_helper_columns_leave_the_callers_alone(docs):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z")]
    frame = docs(rows).withColumnRenamed("source", "_dropped").withColumnRenamed("lang", "node")
    kept = jaccard.keep_one_of_each(frame, 3, 90)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r._dropped, r.node) for r in kept.collect()) == [(1, "s", "en"), (3, "s", "en")]
