import random

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import blocks, passages
from sluice.llm.common import Scratch


def plain_windows(h, least):
    """Cartesian tree by recursion."""
    out, todo = [], [(0, len(h) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a + 1 >= least:
            c = a + int(np.argmin(h[a : b + 1]))
            out.append((a, c, b))
            todo += [(a, c - 1), (c + 1, b)]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 2, 5, 46])
def test_compact_windows_against_the_tree(least):
    draw = np.random.default_rng(least)
    for n in (0, 1, 4, 46, 47, 300):
        for most in (4, 2**60):
            h = draw.integers(1, most + 1, n).astype(np.uint64)  # values count from 1
            assert sorted(passages.compact_windows(h, least)) == plain_windows(h, least)


@pytest.mark.parametrize("seed", range(30))
def test_best_stretch_against_all(seed):
    draw = np.random.default_rng(seed)
    match = draw.random(60) < draw.choice([0.5, 0.85, 0.95])
    stretches = [(e - s, s, e) for s in range(60) for e in range(s + 1, 61) if match[s] and match[e - 1] and 9 * match[s:e].sum() >= 8 * (e - s)]
    s, e = passages.best_stretch(match)
    assert match[s] and match[e - 1] and e - s >= max(stretches)[0] - 16  # the longest may end in misses, which are cut


def corpus(seed):
    """Own words for every text; some hold a passage of 60 words, whole or with one word in 30 changed."""
    draw = random.Random(seed)
    own = iter(range(10**9))
    planted = [[f"p{k}x{i}" for i in range(60)] for k in range(5)]
    rows, held = [], {}
    for doc in range(120):
        words = [f"u{next(own)}" for _ in range(draw.choice([0, 10, 80, 200]))]
        if doc % 3 == 0:
            k = draw.randrange(5)
            passage = list(planted[k])
            if draw.random() < 0.4:
                passage[draw.randrange(60)] = f"u{next(own)}"
            i = draw.randrange(len(words) + 1)
            words = words[:i] + passage + words[i:]
            held[doc] = (k, i)
        elif doc % 3 == 1:
            words += planted[0][:30]  # too short to count
        rows.append((doc, draw.choice([" ", "\n"]).join(words)))
    return rows, held


@pytest.mark.parametrize("block", [8 << 20, 2000])
def test_planted_passages_are_found_and_nothing_else(docs, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    rows, held = corpus(1)
    got = passages.repeated_passages(docs(rows)).collect()
    for r in got:
        (k, i), (fk, fi) = held[r.doc_id], held[r.first_doc_id]
        assert k == fk and r.first_doc_id < r.doc_id and r.similarity >= 0.8
        assert i <= r.start and r.end <= i + 60 and fi <= r.first_start and r.first_end <= fi + 60
        assert r.end - r.start >= 50
    texts = {doc: text.split()[held[doc][1] : held[doc][1] + 60] for doc, text in rows if doc in held}
    shingles = {doc: {tuple(w[i : i + 5]) for i in range(56)} for doc, w in texts.items()}
    firsts = {}
    for doc, (k, _) in held.items():
        firsts.setdefault(k, doc)
    near = {doc: shingles[doc] & shingles[firsts[k]] for doc, (k, _) in held.items() if firsts[k] != doc}
    expected = {doc for doc, common in near.items() if 10 * len(common) >= 8 * len(shingles[doc] | shingles[firsts[held[doc][0]]])}
    assert len(expected) > 15
    assert len({r.doc_id for r in got} & expected) >= 0.9 * len(expected)


def test_copies_nulls_and_empty(docs):
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(3, text), (3, text), (None, text), (1, text), (2, "short"), (4, None), (5, ""), (6, "der " * 5000)]
    got = passages.repeated_passages(docs(rows)).collect()
    assert {(r.doc_id, r.first_doc_id, r.start, r.end) for r in got} == {(3, 1, 0, 70), (None, 1, 0, 70)}
    assert passages.repeated_passages(docs([])).collect() == []


def words_reported(rows, doc):
    return {w for r in rows if r.doc_id == doc for w in range(r.start, r.end)}


def test_a_copy_among_many_variants(docs):
    draw = random.Random(3)
    base = [f"b{i}" for i in range(52)]
    rows = []
    for doc in range(300):
        words = list(base)
        for at in draw.sample(range(52), 3):
            words[at] = f"u{doc}x{at}"
        rows.append((doc, f"own{doc} " + " ".join(words) + f" end{doc}"))
    for copy, of in ((300, 100), (301, 200), (302, 37)):
        rows.append((copy, f"own{copy} " + " ".join(rows[of][1].split()[1:-1]) + f" end{copy}"))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(1, 49)} for _, t in rows]
    links = {(d, f) for d in range(len(rows)) for f in range(d) if 10 * len(sets[d] & sets[f]) >= 8 * len(sets[d] | sets[f])}
    assert {(300, 100), (301, 200), (302, 37)} <= links
    got = passages.repeated_passages(docs(rows)).collect()
    assert {d for d, _ in links} <= {r.doc_id for r in got}
    assert {(300, 100), (301, 200), (302, 37)} <= {(r.doc_id, r.first_doc_id) for r in got}
    for d, f in ((300, 100), (301, 200), (302, 37)):
        assert words_reported(got, d) == set(range(1, 53))


@pytest.mark.parametrize("times, gap", [(2, 40), (6, 40), (6, 0), (2, 300)])
def test_passages_held_several_times(docs, times, gap):
    own = iter(range(10**9))
    passage = [f"p{i}" for i in range(55)]

    def text():
        words = []
        for _ in range(times):
            words += [f"u{next(own)}" for _ in range(gap)] + passage
        return " ".join(words + ["end" + str(next(own))])

    rows = [(doc, text()) for doc in range(3)]
    got = passages.repeated_passages(docs(rows)).collect()
    seen = set()
    for doc, t in rows:
        words = t.split()
        runs = [tuple(words[k : k + 50]) for k in range(len(words) - 49)]
        want = {w for k, run in enumerate(runs) if run in seen for w in range(k, k + 50)}
        seen |= set(runs)
        assert words_reported(got, doc) == want


@pytest.mark.parametrize("period", [1, 7, 20])
def test_text_that_repeats_itself(docs, period):
    line = [f"r{i}" for i in range(period)] * (900 // period)
    rows = [(doc, " ".join([f"a{doc}"] * 3 + line + [f"z{doc}"])) for doc in range(3)]
    got = passages.repeated_passages(docs(rows)).collect()
    for doc in (1, 2):
        assert words_reported(got, doc) == set(range(3, 3 + len(line)))


def test_tables_go_once_nothing_reads_them(docs, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    monkeypatch.setattr(passages, "Scratch", lambda spark, label: kept.append(Scratch(spark, label)) or kept[0])
    kept = []
    found = passages.repeated_passages(docs([(1, " ".join(words)), (2, "x " + " ".join(words[:120]))]))
    path = docs([]).sparkSession._jvm.org.apache.hadoop.fs.Path(kept[0].root)
    left = {f.getPath().getName() for f in path.getFileSystem(docs([]).sparkSession._jsc.hadoopConfiguration()).listStatus(path)}
    assert not left & {"windows", "first-copies", "tied", "rest", "pairs_first", "texts_first", "pairs_second", "texts_second"}
    assert [(r.doc_id, r.first_doc_id) for r in found.collect()] == [(2, 1)]
    kept[0].clear()


def test_texts_take_turns_with_their_evidence(docs, monkeypatch):
    """What the second round writes at once is bounded; all turns together give what one gives."""
    draw = random.Random(5)
    rows = []
    for doc in range(90):
        words = [f"b{i}" for i in range(52)]
        for at in draw.sample(range(52), 3):
            words[at] = f"u{doc}x{at}"
        rows.append((doc, f"own{doc} " + " ".join(words) + f" end{doc}"))
    rows += [(100 + doc, f"own{100 + doc} " + " ".join(rows[doc][1].split()[1:-1]) + f" end{100 + doc}") for doc in range(5, 90, 7)]
    pairs, bound = passages._pairs, passages._evidence_bytes
    evidence, bytes_, kept = {}, [], []

    def counted(rows_, scratch, name, *args):
        evidence[name] = rows_.count()
        return pairs(rows_, scratch, name, *args)

    monkeypatch.setattr(passages, "_pairs", counted)
    monkeypatch.setattr(passages, "_evidence_bytes", lambda *args: bytes_.append(bound(*args)) or bytes_[-1])
    monkeypatch.setattr(passages, "Scratch", lambda spark, label: kept.append(Scratch(spark, label)) or kept[-1])
    found = sorted(passages.repeated_passages(docs(rows)).collect(), key=str)
    once = dict(evidence)
    assert found and set(once) == {"first", "second"}
    assert 0 < once["second"] * passages.EVIDENCE_BYTES <= bytes_[0]

    evidence.clear()
    monkeypatch.setattr(passages, "TURN_BYTES", 0)
    monkeypatch.setattr(passages, "TURN_LEAST", bytes_[0] // 4 + 1)
    assert sorted(passages.repeated_passages(docs(rows)).collect(), key=str) == found
    assert set(evidence) == {"first", "second", "second_1", "second_2", "second_3"}
    turns = [n for name, n in evidence.items() if name != "first"]
    assert sum(turns) == once["second"]
    assert max(turns) <= 0.5 * once["second"]
    path = docs([]).sparkSession._jvm.org.apache.hadoop.fs.Path(kept[1].root)
    left = {f.getPath().getName() for f in path.getFileSystem(docs([]).sparkSession._jsc.hadoopConfiguration()).listStatus(path)}
    assert left <= {"blocks", "copies", "answers", "found_first", "found_second", "found_second_1", "found_second_2", "found_second_3"}
    for scratch in kept:
        scratch.clear()


def plain_stretches(rows):
    """Runs of one pair of texts, one after the other."""
    clusters, out = [], []
    for row in sorted(rows, key=lambda r: r[1] - r[4]):
        lie = row[1] - row[4]
        if not clusters or lie - clusters[-1][0] > passages.LEAST // 4:
            clusters.append([lie, []])
        clusters[-1][0] = lie
        clusters[-1][1].append(row)
    for _, members in clusters:
        runs = []
        for row in sorted(members, key=lambda r: r[1]):
            if not runs or row[1] - runs[-1][-1][1] > passages.REACH:
                runs.append([])
            runs[-1].append(row)
        for run in runs:
            if len({r[6] for r in run}) >= passages.ENOUGH or any(r[7] for r in run):
                a, c, b, fa, fc, fb = list(zip(*run))[:6]
                reach = passages.REACH
                out.append((max(min(a), min(c) - reach), min(max(b), max(c) + reach), max(min(fa), min(fc) - reach), min(max(fb), max(fc) + reach)))
    return sorted(out)


@pytest.mark.parametrize("size, combined", [(1, 500_000), (7, 3), (1000, 500_000)])
def test_pairs_of_texts_together_equal_one_at_a_time(monkeypatch, size, combined):
    monkeypatch.setattr(passages, "COMBINED", combined)
    draw = random.Random(size)
    places = lambda: [{"a": c - draw.randrange(60), "c": c, "b": c + draw.randrange(60)} for c in (draw.randrange(400) for _ in range(draw.choice([1, 1, 2, 4])))]
    rows, want = [], {}
    for k in range(60):
        combos = []
        for signature in range(draw.choice([1, 2, 5, 9])):
            row = {"block": k // 7, "i": k, "first_block": 0, "first_i": k % 3, "beside": draw.random() < 0.03, "places": places(), "leads": places()}
            rows.append(row)
            combos += [(p["a"], p["c"], p["b"], q["a"], q["c"], q["b"], signature, row["beside"]) for p in row["places"] for q in row["leads"]]
        want[k] = plain_stretches(combos)
    kind = pa.list_(pa.struct([("a", pa.int32()), ("c", pa.int32()), ("b", pa.int32())]))
    schema = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("first_block", pa.int64()), ("first_i", pa.int32()), ("beside", pa.bool_()), ("places", kind), ("leads", kind)])
    batches = pa.Table.from_pylist(rows, schema=schema).combine_chunks().to_batches(max_chunksize=size)
    got = {k: [] for k in want}
    for batch in passages._pair_rows(iter(batches)):
        for r in batch.to_pylist():
            assert (r["block"], r["first_block"], r["first_i"]) == (r["i"] // 7, 0, r["i"] % 3)
            got[r["i"]].append((r["s"], r["e"], r["first_s"], r["first_e"]))
    assert {k: sorted(v) for k, v in got.items()} == want
    assert sum(map(len, got.values())) > 20


@pytest.mark.parametrize("seed", range(20))
def test_likely_stretches_against_all(seed):
    draw = np.random.default_rng(seed)
    n = int(draw.choice([0, 1, 45, 46, 47, 150]))
    held = draw.random(n) < draw.choice([0.5, 0.85, 0.95, 1])
    covered = np.zeros(n, bool)
    for s in range(n):
        for e in range(s + passages.LEAST, n + 1):
            covered[s:e] |= 9 * held[s:e].sum() >= 8 * (e - s)
    got = np.zeros(n, bool)
    for s, e in passages.likely_stretches(held):
        assert e - s >= passages.LEAST
        got[s:e] = True
    assert (got == covered).all()


def test_a_line_that_many_texts_hold_is_no_evidence(docs, monkeypatch):
    """Only texts that can hold a passage of each other are fetched, not all pairs of those with the line."""
    line = " ".join(f"h{i}" for i in range(30))
    rows = [(doc, line + " " + " ".join(f"u{doc}x{i}" for i in range(80))) for doc in range(80)]
    middle = rows[40][1].split()
    rows.append((80, line + " " + " ".join(f"v{i}" for i in range(120)) + " " + " ".join(middle[40:100])))
    fetched, store = {}, Scratch.store

    def counted(self, df, name, codec="zstd"):
        out = store(self, df, name, codec)
        fetched[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "store", counted)
    got = passages.repeated_passages(docs(rows)).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(80, 40)}
    assert words_reported(got, 80) == set(range(150, 210))
    assert fetched["pairs_first"] + fetched.get("pairs_second", 0) < 400
