import hashlib
from collections import defaultdict

import pytest

from sluice.llm import exact

LONG = "0123456789abcdef" * 1000


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[lower(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), hashlib.sha256(lower(text).encode()).hexdigest()))
    return sorted(out, key=str)


CASES = {
    "mixed": [(1, "Same"), (2, "sAME"), (3, "same "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, LONG), (9, LONG.upper()), (10, LONG + "x"), (11, "x" + LONG)],
    "long": [(i, "ab" * 2048 * n + tail) for i, (n, tail) in enumerate([(1, ""), (2, ""), (3, ""), (3, "c"), (5, ""), (5, ""), (8, ""), (9, ""), (9, ""), (2, "")])],
    "multibyte": [(1, "é漢🙂" * 3000), (2, "é漢🙂" * 3000), (3, "é漢🙂" * 3001)],
    "repeated": [(1, "x"), (1, "x"), (1, "y"), (2, "x"), (None, "x"), (None, "z"), (None, "z"), (3, LONG), (3, LONG)],
    "hot": [(i, "copy" if i % 3 else f"own {i}") for i in range(300)],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_against_plain_grouping(docs, case):
    rows = CASES[case]
    got = exact.exact_groups(docs(rows)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in got}) == len(kept)
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("block", [3, 16])
def test_small_blocks_need_many_levels(docs, monkeypatch, block):
    monkeypatch.setattr(exact, "BLOCK_BYTES", block)
    rows = [(i, t) for i, t in enumerate(["abcabcabc" * 9, "abcabcabc" * 9, "abc" * 28, "abcabcabc" * 8, "", "ABCABCABC" * 9, "a"])]
    got = exact.exact_groups(docs(rows)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == plain(rows)


def test_drop_copies_keeps_columns(docs):
    rows = CASES["repeated"] + CASES["mixed"]
    source = docs([(None if i is None else i * 100 + n, t) for n, (i, t) in enumerate(rows)])
    got = exact.drop_copies(source)
    assert got.columns == source.columns
    assert sorted(lower(r.text) for r in got.collect()) == sorted({lower(t) for _, t in rows})


def test_no_python_in_the_plan(docs):
    plan = exact.exact_groups(docs(CASES["mixed"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
