"""Near-duplicate passages by compact windows.

A text is its sequence of 5-word shingles. Under a hash function, the shingle
with the least hash of a passage is its signature, and all passages with the
same signature form a compact window (a, c, b): they start in [a, c] and end in
[c, b]. The windows are the nodes of the Cartesian tree over the hashes; nodes
that span at least ``LEAST`` shingles are kept, and found without the tree: such
a node is the minimum of some run of ``LEAST`` shingles, and its nearest smaller
neighbours are such nodes too.

A text's windows of a signature (hash function and value) are joined, in a first
round, with those of the earliest document that holds it and of the one before
in order. Where ``ENOUGH`` windows agree on a pair of documents and overlap, the
two passages are brought together, cut to where they match, and verified: at
least ``LEAST`` shingles (50 words) each and a Jaccard similarity of ``PERCENT``
or more. A second round joins every window whose signature lies in no passage
found so far with all earlier documents that hold the signature, where both texts
have a stretch of shingles that the other side holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import blocks
from sluice.llm.blocks import BUCKET_SCHEMA, LAST, answered, bits, deal, later_copies, lay_out, split, tied, to_batches
from sluice.llm.common import Scratch
from sluice.llm.hashing import mix, power_tables, word_hashes

WORDS = 5
LEAST = 46
PERCENT = 80
FUNCTIONS = 8
ENOUGH = 3
#: Signatures of one passage lie this far apart at most.
REACH = 2 * LEAST
#: Passages are fetched in whole steps of so many words, so that many requests for one passage are one.
STEP = 64
#: Holders of one signature put in one order, or joined in one task; more are dealt out.
HOLDERS = 10_000
#: Pairs of windows looked at together.
COMBINED = 500_000
#: Bytes of a row of evidence before it is packed, without its places.
EVIDENCE_BYTES = 96
#: Evidence of one turn of the second round: bytes before they are packed for each byte of text, and at least.
TURN_BYTES, TURN_LEAST = 3, 64 << 20


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """One per position; a text of fewer words has none."""
    n = len(words) - WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, mixed = np.zeros(n, np.uint64), mix(words)
    for i in range(WORDS):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += mixed[i : i + n]
    return mix(out)


def function(hashes: np.ndarray, number: int) -> np.ndarray:
    """Values of one hash function, from 1."""
    return np.maximum(mix(hashes ^ np.uint64(0x9E3779B97F4A7C15 * (number + 1) % 2**64)), np.uint64(1))


def _sliding(pick: np.ufunc, h: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of every run of ``width``, by doubling."""
    out, reach = h, 1
    while reach < width:
        move = min(reach, width - reach)
        out = pick(out[: len(out) - move], out[move:])
        reach += move
    return out


def _nearest(value: np.ndarray, or_equal: bool) -> np.ndarray:
    """For every place the nearest one to the left with a smaller (or equal) value; place 0 holds the least.

    All values between a place and its candidate are too large, which stays so
    when the candidate is replaced by its own.
    """
    at = np.maximum(np.arange(len(value)) - 1, 0)
    open_ = np.arange(1, len(value))
    while len(open_):
        here = value[at[open_]]
        open_ = open_[here > value[open_] if or_equal else here >= value[open_]]
        open_ = open_[at[open_] > 0]
        at[open_] = at[at[open_]]
    return at


def tree_nodes(h: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, c, b), inclusive, of the nodes of Cartesian trees that span ``least`` or more; ties go left.

    ``h`` holds one or more sequences of values from 1, a 0 before, between and
    after them; a tree never goes across a 0.
    """
    if len(h) < least + 2:
        return (np.zeros(0, np.int64),) * 3
    low = _sliding(np.minimum, h, least)
    edge = np.zeros(least - 1, h.dtype)
    high = _sliding(np.maximum, np.concatenate([edge, low, edge]), least)
    place = np.flatnonzero((h == high) | (h == 0))  # least of some run around it
    value = h[place]
    before = place[_nearest(value, or_equal=True)]
    after = place[len(place) - 1 - _nearest(value[::-1], or_equal=False)[::-1]]
    kept = (value > 0) & (after - before > least)
    return before[kept] + 1, place[kept], after[kept] - 1


def compact_windows(h: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The nodes of one sequence."""
    edge = np.zeros(1, np.uint64)
    nodes = tree_nodes(np.concatenate([edge, np.maximum(h, np.uint64(1)), edge]), least)
    return [(a - 1, c - 1, b - 1) for a, c, b in zip(*(x.tolist() for x in nodes), strict=True)]


def _run_of(group: np.ndarray, c: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places ``c``, ascending in each group, to keep, and which of them start a run.

    Places of a group less than ``least`` apart are a run; of it the first stays
    and then one per ``least``.
    """
    starts = np.ones(len(c), bool)
    starts[1:] = (group[1:] != group[:-1]) | (c[1:] - c[:-1] >= least)
    first = np.flatnonzero(starts)
    run = np.cumsum(starts) - 1
    step = (c - c[first][run]) // least if len(c) else c
    kept = starts.copy()
    kept[1:] |= step[1:] != step[:-1]
    return kept, starts


def _nodes_of(raws: list[bytes], skipped: set[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: the key and (a, c, b) of every window, in one row of the shingles of all texts; this, where each text begins there, and which it is."""
    texts, parts = [], []
    for i, raw in enumerate(raws):
        hashes = shingle_hashes(word_hashes(raw)) if i not in skipped and len(raw) >= 2 * (LEAST + WORDS) - 3 else ()
        if len(hashes) >= LEAST:
            texts.append(i)
            parts.append(hashes)
    begin = np.cumsum([1] + [len(x) + 1 for x in parts])  # a 0 before each text and after the last
    every = np.zeros(begin[-1], np.uint64)
    for at, x in zip(begin, parts, strict=False):
        every[at : at + len(x)] = x
    gaps = np.concatenate([[0], begin[1:] - 1])
    keys, nodes = [], []
    for f in range(FUNCTIONS):
        h = function(every, f)
        h[gaps] = 0
        a, c, b = tree_nodes(h)
        keys.append(mix(h[c]))  # least values are small: spread them over the buckets
        nodes.append(np.stack([a, c, b], axis=1))
    return np.concatenate(keys), np.concatenate(nodes), every, begin, np.array(texts, np.int64)


def _led(keys: np.ndarray, nodes: np.ndarray, own: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows stay, and which of these lead.

    Text that repeats itself within ``LEAST`` shingles has a window of the same
    signature per repeat. Where all that a passage of ``LEAST`` shingles around
    it can hold is equal too, one per ``LEAST`` shingles stays; the first of them leads.
    """
    a, c, b = nodes.T
    _, up, down = power_tables(len(every))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(every) * down[: len(every)])])
    left, right = np.maximum(a, c - LEAST + 1), np.minimum(b, c + LEAST - 1)
    around = mix((sums[right + 1] - sums[left]) * up[left]) + mix((c - left).astype(np.uint64) << np.uint64(32) | (right - c).astype(np.uint64))
    order = np.lexsort((c, around, keys, own))
    group = np.cumsum(np.concatenate([[0], np.any([x[order[1:]] != x[order[:-1]] for x in (around, keys, own)], axis=0)])) if len(order) else order
    stays, starts = np.empty(len(c), bool), np.empty(len(c), bool)
    stays[order], starts[order] = _run_of(group, c[order], LEAST)
    return stays, starts


def _key_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = _nodes_of(split(row["payload"], row["sizes"]), set(row["copies"] or ()))[0]
                keys.sort()  # faster here than np.unique
                keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
                yield from to_batches(deal(keys, None, row["block"], row["doc_ids"], buckets, 4))

    return run


_PLACES = "array<struct<a: int, c: int, b: int>>"
_WINDOW_DDL = f"key long, id long, block long, i int, places {_PLACES}, leads {_PLACES}"


def _place_lists(rows: np.ndarray, owner: np.ndarray, owners: int) -> pa.ListArray:
    """(a, c, b) of ``rows`` by their owner, which ascends."""
    places = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in rows[:, 1:4].T], ["a", "c", "b"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(owners + 1)), pa.int32()), places)


def _among_enough(text: np.ndarray, c: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Windows that ``ENOUGH`` signatures of their text, each ``REACH`` or less from the next, lie together with."""
    order = np.lexsort((c, text))
    new = np.ones(len(c), bool)
    new[1:] = (text[order[1:]] != text[order[:-1]]) | (np.diff(c[order]) > REACH)
    cluster = np.empty(len(c), np.int64)
    cluster[order] = np.cumsum(new) - 1
    each = np.unique(np.stack([cluster, key]), axis=1)[0]
    return np.bincount(each, minlength=new.sum())[cluster] >= ENOUGH


def _window_rows(buckets: int):
    """A row per text and signature that another text has too: all its windows, and those that lead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _WINDOW_DDL.split(", places")[0].split(", ")] + ["places", "leads"]
        for batch in batches:
            for row in batch.to_pylist():
                keys, nodes, every, begin, texts = _nodes_of(split(row["payload"], row["sizes"]), set(row["copies"] or ()))
                if not len(keys):
                    continue
                order = np.argsort(keys, kind="stable")  # by place for each function
                own = (np.searchsorted(begin, nodes[:, 1], side="right") - 1)[order]
                keys, nodes = keys[order], nodes[order]
                new_key = np.concatenate([[True], keys[1:] != keys[:-1]])
                starts = new_key | np.concatenate([[True], own[1:] != own[:-1]])
                place = np.cumsum(new_key) - 1
                holders = np.bincount(place[starts])
                shared = (bits(row["windows"], keys[new_key], buckets) | (holders > 1))[place]
                keys, nodes, own, place = keys[shared], nodes[shared], own[shared], place[shared]
                stays, leads = _led(keys, nodes, own, every)
                rows = np.concatenate([texts[own][:, None], nodes - begin[own][:, None], leads[:, None]], axis=1).astype(np.int32)
                stays[stays] = _among_enough(rows[stays, 0], rows[stays, 2], place[stays])
                keys, rows = keys[stays], rows[stays]
                starts = np.ones(len(keys), bool)
                starts[1:] = (keys[1:] != keys[:-1]) | (rows[1:, 0] != rows[:-1, 0])
                owner, first = np.cumsum(starts) - 1, np.flatnonzero(starts)
                ids = np.array([LAST if d is None else d for d in row["doc_ids"]], np.int64)
                text, lead = rows[first, 0], rows[:, 4] > 0
                columns = [pa.array(keys[first].view(np.int64)), pa.array(ids[text]), pa.array(np.full(len(first), row["block"], np.int64)), pa.array(text, pa.int32())]
                columns += [_place_lists(rows, owner, len(first)), _place_lists(rows[lead], owner[lead], len(first))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


_PAIR_DDL = "block long, i int, s int, e int, first_block long, first_i int, first_s int, first_e int"


def agreeing(rows: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of two texts on whose alignment ``ENOUGH`` signatures agree: (pair, s, e, first_s, first_e).

    ``rows``: (a, c, b) of one text and of the other, the signature (a number), and whether the window
    lies beside a passage found before, whose own windows are not given: it is enough by itself; ``pair``:
    the number of the two texts, from 0. Windows whose signatures lie on about the same diagonal
    (insertions shift it) and overlap belong together.
    """
    if not len(rows):
        return (np.zeros(0, np.int64),) * 5
    c, fc = rows[:, 1], rows[:, 4]
    lie = c - fc
    order = np.argsort(_both(pair, lie))
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(pair[order]) != 0) | (np.diff(lie[order]) > LEAST // 4)
    cluster = np.empty(len(rows), np.int64)
    cluster[order] = np.cumsum(new) - 1
    order = np.argsort(_both(cluster, c))
    cluster, at = cluster[order], c[order]
    starts = np.ones(len(rows), bool)
    starts[1:] = (cluster[1:] != cluster[:-1]) | (np.diff(at) > REACH)
    run = np.cumsum(starts) - 1
    held = np.sort(_both(run, rows[order, 6]))
    distinct = np.concatenate([[True], held[1:] != held[:-1]])
    kept = np.bincount(held[distinct] >> 32) >= ENOUGH
    kept |= np.bincount(run, rows[order, 7]) > 0
    order = order[kept[run]]
    if not len(order):
        return (np.zeros(0, np.int64),) * 5
    first = np.flatnonzero(starts[kept[run]])
    low, high = (lambda x: np.minimum.reduceat(rows[order, x], first)), (lambda x: np.maximum.reduceat(rows[order, x], first))
    s, e = np.maximum(low(0), low(1) - REACH), np.minimum(high(2), high(1) + REACH)
    return pair[order[first]], s, e, np.maximum(low(3), low(4) - REACH), np.minimum(high(5), high(4) + REACH)


def _both(number: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A key by which to sort by two numbers that fit 31 bits, the second with its sign."""
    return (number.astype(np.int64) << 32) + value


def _combined(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Every window of one text with every window of the other, row by row, and how many each row gives."""
    (own, n_own, from_own), (other, n_other, from_other) = (_listed(batch.column(x)) for x in ("places", "leads"))
    n = n_own * n_other
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at_own, at_other = np.divmod(at, n_other[row])
    at_own += from_own[row]
    at_other += from_other[row]
    out = np.empty((8, len(row)), np.int32)  # a column lies together
    for k in range(3):
        out[k] = own[k][at_own]
        out[3 + k] = other[k][at_other]
    out[6] = row  # of two texts a signature has one row, beside a passage one more
    out[7] = batch.column("beside").to_numpy(zero_copy_only=False)[row]
    return out.T, n


def _listed(column: pa.ListArray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """a, c and b of all windows, and of each row how many they are and where they begin."""
    at = column.offsets.to_numpy().astype(np.int64)
    return [column.values.field(x).to_numpy() for x in "acb"], np.diff(at), at[:-1]


def _flat(places: str) -> Column:
    """a, c and b of all windows in one list, which takes half the bytes in a shuffle."""
    return F.flatten(F.transform(places, lambda p: F.array(p["a"], p["c"], p["b"])))


def _unflat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name in ("places", "leads"):
            column = batch.column(name)
            values = column.values.to_numpy()
            places = pa.StructArray.from_arrays([pa.array(values[k::3]) for k in range(3)], ["a", "c", "b"])
            at = pa.array(column.offsets.to_numpy() // 3, pa.int32())
            batch = batch.set_column(batch.schema.get_field_index(name), name, pa.ListArray.from_arrays(at, places))
        yield batch


_PAIR = ["block", "i", "first_block", "first_i"]


def _pair_starts(batch: pa.RecordBatch) -> np.ndarray:
    """Whether a row begins another pair of texts than the row before."""
    starts = np.ones(batch.num_rows, bool)
    starts[1:] = np.any([np.diff(batch.column(x).to_numpy()) != 0 for x in _PAIR], axis=0)
    return starts


def _stretches(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of whole pairs of texts, about ``COMBINED`` windows at once."""
    for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
        number = np.cumsum(_pair_starts(batch)) - 1
        # most pairs agree on too little
        enough = (np.bincount(number) >= ENOUGH) | (np.bincount(number, batch.column("beside").to_numpy(zero_copy_only=False)) > 0)
        batch = batch.take(pa.array(np.flatnonzero(enough[number])))
        first = np.flatnonzero(_pair_starts(batch))
        if not len(first):
            continue
        sizes = np.diff(batch.column("places").offsets.to_numpy()).astype(np.int64) * np.diff(batch.column("leads").offsets.to_numpy())
        share = np.cumsum(np.add.reduceat(sizes, first)) // COMBINED
        cuts = [0, *first[np.flatnonzero(np.diff(share)) + 1].tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.take(pa.array(np.arange(start, stop)))
            starts = _pair_starts(part)
            rows, n = _combined(part)
            pair, *ends = agreeing(rows, np.repeat(np.cumsum(starts) - 1, n))
            texts = part.select(_PAIR).take(pa.array(np.flatnonzero(starts)[pair]))
            ends = [pa.array(x, pa.int32()) for x in ends]
            columns = [*texts.columns[:2], *ends[:2], *texts.columns[2:], *ends[2:]]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _PAIR_DDL.split(", ")])


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by pair of texts; the last pair of a batch may go on in the next."""
    held: list[pa.RecordBatch] = []
    pair = None
    for batch in batches:
        if not batch.num_rows:
            continue
        start = int(np.flatnonzero(_pair_starts(batch))[-1])
        last = tuple(batch.column(x)[start].as_py() for x in _PAIR)
        if start or last != pair:
            yield from _stretches([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
        pair = last
    if held:
        yield from _stretches(held)


_TEXT_DDL = "block long, i int, low int, high int, id long, passage binary"


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _TEXT_DDL.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    for batch in batches:
        for row in batch.to_pylist():
            raws, out = split(row["payload"], row["sizes"]), []
            for w in sorted(row["wanted"], key=lambda w: (w["i"], w["low"])):
                if not out or out[-1][1] != w["i"]:
                    words = raws[w["i"]].lower().split()
                doc = row["doc_ids"][w["i"]]
                out.append((row["block"], w["i"], w["low"], w["high"], LAST if doc is None else doc, b" ".join(words[w["low"] : w["high"]])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)


def best_stretch(match: np.ndarray) -> tuple[int, int]:
    """The longest [start, end) whose share of hits lets two such stretches reach ``PERCENT``, cut to its outer hits."""
    if not match.any():
        return 0, 0
    total = np.zeros(len(match) + 1, np.int64)
    np.cumsum(np.where(match, PERCENT - 100, 2 * PERCENT), out=total[1:])
    start = np.maximum.accumulate(total).searchsorted(total)  # the first prefix sum that is no smaller
    end = int((np.arange(len(total)) - start).argmax())
    first = int(start[end])
    hits = match[first:end].nonzero()[0]
    return first + int(hits[0]), first + int(hits[-1]) + 1


def _distinct(values: np.ndarray) -> np.ndarray:
    """In order; faster on a passage than np.unique."""
    out = np.sort(values)
    new = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


def _likeness(a: np.ndarray, b: np.ndarray) -> float | None:
    """Jaccard similarity of two shingle sequences, if it reaches ``PERCENT``."""
    x, y = _distinct(a), _distinct(b)
    common = int(np.count_nonzero(_among(x, y)))
    union = len(x) + len(y) - common
    return common / union if 100 * common >= PERCENT * union else None


def _matching(a: np.ndarray, b: np.ndarray, match: np.ndarray) -> tuple[int, int, int, int, float] | None:
    s, e = best_stretch(match)
    if e - s < LEAST:
        return None  # a run of LEAST equal shingles would lie in a stretch of as many
    fs, fe = best_stretch(_among(b, np.sort(a[s:e])))
    likeness = _likeness(a[s:e], b[fs:fe]) if fe - fs >= LEAST else None
    return _longest_run(a, b) if likeness is None else (s, e, fs, fe, likeness)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the others, which are in order."""
    return known.take(known.searchsorted(values), mode="clip") == values


def _longest_run(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, float] | None:
    """The longest run of shingles that are the same in both, one after the other."""
    order = np.argsort(b, kind="stable")
    at = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    at = np.where(b[order[at]] == a, order[at], -1)
    breaks = np.flatnonzero((at[1:] != at[:-1] + 1) | (at[1:] < 0) | (at[:-1] < 0)) + 1
    starts, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(a)]])
    best = int(np.argmax(np.where(at[starts] >= 0, ends - starts, 0)))
    s, e, f = int(starts[best]), int(ends[best]), int(at[starts[best]])
    return (s, e, f, f + e - s, 1.0) if f >= 0 and e - s >= LEAST else None


def aligned(a: np.ndarray, b: np.ndarray, known: np.ndarray | None = None) -> list[tuple[int, int, int, int, float]]:
    """The matching stretches of two shingle sequences, [start, end) each, and their similarity.

    The longest that reaches ``PERCENT``, else the longest run of equal
    shingles; then the same on what lies before and after it. ``known``: ``b`` in order.
    """
    if len(a) < LEAST or len(b) < LEAST:
        return []
    out, todo, match = [], [(0, len(a))], _among(a, np.sort(b) if known is None else known)
    while todo:
        low, high = todo.pop()
        if high - low < LEAST or np.count_nonzero(match[low:high]) * 100 < LEAST * PERCENT:
            continue
        found = _matching(a[low:high], b, match[low:high])
        if found:
            s, e, fs, fe, likeness = found
            out.append((low + s, low + e, fs, fe, likeness))
            todo += [(low, low + s), (low + e, high)]
    return sorted(out)


_FOUND_DDL = "block long, i int, doc_id long, start long, end long, first_doc_id long, first_start long, first_end long, similarity double"


def _verified_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _FOUND_DDL.split(", ")]
    types = [pa.int64(), pa.int32()] + [pa.int64()] * 6 + [pa.float64()]
    for batch in batches:
        out = []
        columns = [batch.column(x).to_pylist() for x in ("block", "i", "id", "low", "passage", "first_id", "first_low", "first_passage")]
        hashed: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}  # many passages share their first
        for block, i, doc, low, text, first, first_low, first_text in zip(*columns, strict=True):
            for t in (text, first_text):
                if t not in hashed:
                    hashed[t] = (h := shingle_hashes(word_hashes(t)), np.sort(h))
            for s, e, fs, fe, likeness in aligned(hashed[text][0], *hashed[first_text]):
                out.append((block, i, doc, low + s, low + e + WORDS - 1, first, first_low + fs, first_low + fe + WORDS - 1, likeness))
        columns = zip(*out, strict=True) if out else [()] * 9
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)


_TEXT = ["id", "block", "i"]


def _evidence(joined: DataFrame) -> DataFrame:
    """A row per two texts and signature: the ``places`` of the one, and those that lead in the other, both flat."""
    first = [F.col(f"first.{x}").alias(f"first_{x}") for x in ("block", "i")]
    return joined.select("block", "i", *first, "beside", "places", F.col("first.leads").alias("leads"))


def _first_round(windows: DataFrame, held: DataFrame, scratch: Scratch) -> DataFrame:
    """Passages found by the earliest holder of each signature and the one before in order."""
    windows = windows.withColumns({x: _flat(x) for x in ("places", "leads")})
    place = F.struct(*_TEXT, "leads")
    # a hot signature is dealt over several orders, so its earliest holder is found apart; a row per HOLDERS windows at most
    shares = windows.groupBy("key").agg(F.ceil(F.count("*") / HOLDERS).alias("shares")).where("shares > 1")
    shares = F.broadcast(scratch.store(shares, "hot-shares"))
    hot = windows.join(shares, "key").groupBy("key", "shares").agg(F.min_by(place, F.struct(*_TEXT)).alias("earliest"))
    joined = windows.join(F.broadcast(scratch.store(hot, "hot")), "key", "left")
    joined = joined.withColumn("share", F.coalesce(F.pmod(F.xxhash64("block", "i"), "shares"), F.lit(0)))
    order = Window.partitionBy("key", "share").orderBy(*_TEXT)
    joined = joined.withColumn("first", F.first(place).over(order)).withColumn("before", F.lag(place).over(order))
    firsts = F.array(F.coalesce("earliest", "first"), "before")
    joined = joined.withColumn("first", F.explode(F.array_distinct(F.array_compact(firsts))))
    joined = joined.where(F.struct(*_TEXT) != F.struct("first.id", "first.block", "first.i"))
    pairs = _pairs(_evidence(joined.withColumn("beside", F.lit(False))), scratch, "first")
    found = _found(pairs, _texts(pairs, held, scratch, "first"), scratch, "first")
    scratch.drop("pairs_first", "texts_first", "hot-shares", "hot")
    return found


def _not_found(windows: DataFrame, found: DataFrame) -> DataFrame:
    """``windows`` whose signature lies in no passage found of their text.

    ``beside`` are those so near to one that some of the windows that would agree with them can lie in it.
    """
    shingles = F.struct("start", (F.col("end") - WORDS + 1).alias("end"))
    spans = found.groupBy("block", "i").agg(F.collect_set(shingles).alias("spans"))
    spanned = windows.join(spans, ["block", "i"], "left").withColumn("spans", F.coalesce("spans", F.expr("array()").cast("array<struct<start: long, end: long>>")))

    def touches(p: Column, reach: int) -> Column:
        return F.exists("spans", lambda x: (p["c"] + reach >= x["start"]) & (p["c"] - reach < x["end"]))

    open_ = F.filter("places", lambda p: ~touches(p, 0))
    split_ = spanned.withColumn("open", open_).select("key", *_TEXT, F.explode(F.array(F.lit(False), F.lit(True))).alias("beside"), "open", "spans")
    near = split_.withColumn("places", F.filter("open", lambda p: touches(p, LEAST) == F.col("beside")))
    return near.where(F.size("places") > 0).select("key", *_TEXT, "beside", "places")


def _on_other_side(rows: list[dict]) -> np.ndarray:
    """Entries of later texts that an earlier one holds, and of earlier ones (``~block``) that a later one holds."""
    h = np.concatenate([np.frombuffer(r["entries"], "<u4") for r in rows])
    n = [len(r["docs"]) for r in rows]
    ids, block = np.concatenate([np.array(r["docs"], np.int64) for r in rows]), np.repeat([r["block"] for r in rows], n)
    is_first, block = block < 0, np.maximum(block, ~block)
    order = np.lexsort((block, ids))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], (np.diff(ids[order]) != 0) | (np.diff(block[order]) != 0)]))
    counts = np.concatenate([np.array(r["counts"], np.int64) for r in rows])
    rank, is_first = np.repeat(rank, counts), np.repeat(is_first, counts)
    order = np.argsort(h, kind="stable")
    starts = np.concatenate([[True], np.diff(h[order]) != 0])
    at, group = np.flatnonzero(starts), np.cumsum(starts) - 1
    rank, is_first = rank[order], is_first[order]
    earliest = np.minimum.reduceat(np.where(is_first, rank, LAST), at)[group]
    latest = np.maximum.reduceat(np.where(is_first, -1, rank), at)[group]
    out = np.empty(len(h), bool)
    out[order] = np.where(is_first, latest > rank, earliest < rank)
    return out


_on_other_side.width = 4

_STRETCH_DDL = "block long, i int, first boolean, stretches array<struct<s: int, e: int>>"


def _span_entries(raws: list[bytes], spans: list[dict]) -> Iterator[tuple[int, list[int], list[np.ndarray], np.ndarray]]:
    """Of every text with ``spans``: its place, where the shingles of each begin that can be fetched for its windows, these, and the distinct ones."""
    for i, group in groupby(sorted((w["i"], w["low"], w["high"]) for w in spans), key=lambda w: w[0]):
        hashes = shingle_hashes(word_hashes(raws[i]))
        ends = [(max(low - REACH - STEP, 0), high + REACH + STEP + 1) for _, low, high in group]
        parts = [hashes[low:high] for low, high in ends]
        yield i, [low for low, _ in ends], parts, np.unique(np.concatenate(parts))


_SIDES = (("own", False), ("firsts", True))


def _entry_rows(buckets: int):
    """The shingles of later texts (``own``) and of earlier ones, these under ``~block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raws = split(row["payload"], row["sizes"])
                for name, first in _SIDES:
                    entries = [(distinct, np.full(len(distinct), i)) for i, _, _, distinct in _span_entries(raws, row[name] or [])]
                    if entries:
                        h, text = (np.concatenate(x) for x in zip(*entries, strict=True))
                        yield from to_batches(deal(h, text, ~row["block"] if first else row["block"], row["doc_ids"], buckets, 4))

    return run


def likely_stretches(held: np.ndarray) -> list[tuple[int, int]]:
    """All [start, end) that stretches of ``LEAST`` or more with the share of hits of ``best_stretch`` cover."""
    total = np.concatenate([[0], np.cumsum(np.where(held, 100 - PERCENT, -2 * PERCENT))])
    start = np.searchsorted(-np.minimum.accumulate(total), -total)
    end = np.flatnonzero(np.arange(len(total)) - start >= LEAST)
    if not len(end):
        return []
    # from the last end on, so that what lies to the right begins as early as any
    least = np.minimum.accumulate(start[end][::-1])[::-1]
    new = np.concatenate([[True], least[1:] > end[:-1]])
    first = np.flatnonzero(new)
    return list(zip(least[first].tolist(), end[np.concatenate([first[1:] - 1, [len(end) - 1]])].tolist(), strict=True))


def _stretch_rows(buckets: int):
    """Where a text can hold a passage of a text of the other side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _STRETCH_DDL.split("<")[0].split(", ")]
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        for batch in batches:
            for row in batch.to_pylist():
                raws, ids, out = split(row["payload"], row["sizes"]), row["doc_ids"], []
                for name, first in _SIDES:
                    entries = list(_span_entries(raws, row[name] or []))
                    if not entries:
                        continue
                    known = bits(row[f"{name}_held"], np.concatenate([x[3] for x in entries]), buckets)
                    at = 0
                    for i, lows, parts, distinct in entries:
                        held = known[at : at + len(distinct)]
                        at += len(distinct)
                        if ids.count(ids[i]) > 1:  # which of them is earlier was not asked
                            held = np.ones(len(distinct), bool)
                        found = [(low + s, low + e) for low, part in zip(lows, parts, strict=True) for s, e in likely_stretches(held[np.searchsorted(distinct, part)])]
                        if found:
                            out.append((row["block"], i, first, [{"s": s, "e": e} for s, e in found]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), pa.bool_(), kind], strict=True)], names)

    return run


def _likely(rest: DataFrame, windows: DataFrame, held: DataFrame, buckets: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rest`` where an earlier text holds the signature, and where a passage can lie in the texts.

    Windows of a text not more than ``REACH`` apart lie in one span, and so does what is fetched for them. Its
    shingles are looked up among those that can be fetched of earlier texts with such a signature, and the other
    way round: a verified passage is a stretch of them in both.
    """
    earliest = windows.groupBy("key").agg(F.min(F.struct(*_TEXT)).alias("earliest"))
    late = scratch.store(rest.join(earliest, "key").where(F.struct(*_TEXT) > F.col("earliest")).drop("earliest"), "late")
    text = Window.partitionBy("block", "i").orderBy("c")
    each = late.select("block", "i", "key", "beside", F.explode("places.c").alias("c"))
    each = each.withColumn("new", F.coalesce(F.col("c") - F.lag("c").over(text) > REACH, F.lit(False)).cast("int"))
    spans = each.withColumn("span", F.sum("new").over(text)).groupBy("block", "i", "span")
    spans = spans.agg(F.min("c").alias("low"), F.max("c").alias("high"), F.size(F.collect_set("key")).alias("n"), F.max("beside").alias("beside"))
    spans = spans.where((F.col("n") >= ENOUGH) | F.col("beside"))
    firsts = windows.join(late.select("key").distinct(), "key", "left_semi").select("block", "i", F.explode("leads.c").alias("c"))
    firsts = firsts.groupBy("block", "i").agg(F.min("c").alias("low"), F.max("c").alias("high"))

    def by_block(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("block").agg(F.collect_list(F.struct("i", "low", "high")).alias(name))

    asked = scratch.store(by_block(spans, "own").join(by_block(firsts, "firsts"), "block", "full"), "spans")
    answers = answered(held.join(asked, "block").mapInArrow(_entry_rows(buckets), BUCKET_SCHEMA), _on_other_side, scratch, "answers")
    sides = [answers.where("block >= 0").withColumnRenamed("answers", "own_held"), answers.where("block < 0").select(F.bitwise_not("block").alias("block"), F.col("answers").alias("firsts_held"))]
    known = held.join(asked, "block").join(sides[0], "block", "left").join(sides[1], "block", "left")
    stretches = scratch.store(known.mapInArrow(_stretch_rows(buckets), _STRETCH_DDL), "stretches")
    scratch.drop("spans", "answers")
    return late, stretches


def _evidence_bytes(rest: DataFrame, windows: DataFrame) -> float:
    """Bytes of the evidence at most, before they are packed: as if all windows of a signature met, whichever is earlier."""

    def summed(rows: DataFrame, places: str, side: str) -> DataFrame:
        each = EVIDENCE_BYTES / 2 + 4 * F.size(places)
        return rows.groupBy("key").agg(F.count("*").cast("double").alias(f"{side}_n"), F.sum(each).alias(f"{side}_bytes"))

    both = summed(rest, "places", "own").join(summed(windows, "leads", "first"), "key")
    return both.agg(F.sum(F.col("own_n") * F.col("first_bytes") + F.col("first_n") * F.col("own_bytes"))).first()[0] or 0.0


def _all_earlier(rest: DataFrame, windows: DataFrame, shares: DataFrame) -> DataFrame:
    """Evidence of the windows of ``rest`` and all earlier texts that hold their signature, hot ones dealt out."""
    dealt = windows.join(shares, "key", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    others = dealt.select("key", F.pmod(F.xxhash64("block", "i"), "shares").alias("share"), F.struct(*_TEXT, "leads").alias("first"))
    own = rest.join(shares, "key", "left").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("shares", F.lit(1)) - 1)))
    joined = own.join(others, ["key", "share"]).where(F.struct("first.id", "first.block", "first.i") < F.struct(*_TEXT))
    return _evidence(joined.select(*_TEXT, "key", "places", "first", "beside"))


def _second_round(rest: DataFrame, windows: DataFrame, held: DataFrame, total: int, scratch: Scratch) -> DataFrame:
    """Passages of the windows of ``rest`` in any earlier text that holds their signature.

    Evidence grows with the square of the texts that hold a signature, so the texts take turns, as
    many as bound what one writes by the bytes of all texts (``total``).
    """
    late, stretches = _likely(rest, windows, held, 1 + total // 8 // blocks.BUCKET_ENTRIES, scratch)
    own, firsts = stretches.where("not first").drop("first"), stretches.where("first").drop("first")
    late = scratch.store(late.join(own, ["block", "i"], "left_semi").withColumn("places", _flat("places")), "own")
    windows = windows.drop("places").join(firsts, ["block", "i"], "left_semi").join(late.select("key").distinct(), "key", "left_semi")
    windows = scratch.store(windows.withColumn("leads", _flat("leads")), "firsts")
    scratch.drop("tied", "rest", "late")
    shares = windows.groupBy("key").agg(F.ceil(F.count("*") / HOLDERS).alias("shares")).where("shares > 1")
    shares = F.broadcast(scratch.store(shares, "shares"))  # a row per HOLDERS windows at most
    turns = 1 + int(_evidence_bytes(late, windows) // max(TURN_LEAST, TURN_BYTES * total))
    names = ["second", *(f"second_{x}" for x in range(1, turns))]
    pairs = []
    for turn, name in enumerate(names):
        now = late.where(F.pmod(F.xxhash64("block", "i"), F.lit(turns)) == turn)
        pairs.append(_pairs(_all_earlier(now, windows, shares), scratch, name, (own, firsts)))
    scratch.drop("own", "firsts", "shares", "stretches")
    texts = _texts(reduce(DataFrame.unionByName, pairs), held, scratch, "second")
    found = []
    for name, some in zip(names, pairs, strict=True):
        found.append(_found(some, texts, scratch, name))
        scratch.drop(f"pairs_{name}")
    scratch.drop("texts_second")
    return reduce(DataFrame.unionByName, found)


def _pairs(evidence: DataFrame, scratch: Scratch, name: str, likely: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The passages that the evidence points to; ``likely``: where they can lie in the text and in the other."""
    pairs = evidence.repartition(*_PAIR).sortWithinPartitions(*_PAIR).mapInArrow(lambda batches: _pair_rows(_unflat(batches)), _PAIR_DDL)
    pairs = scratch.store(pairs, f"agreed_{name}")

    def steps(s: str, e: str) -> tuple:
        return (F.floor(F.col(s) / STEP) * STEP).cast("int"), (F.ceil((F.col(e) + WORDS) / STEP) * STEP).cast("int")

    low, high = steps("s", "e")
    first_low, first_high = steps("first_s", "first_e")
    pairs = pairs.select("block", "i", low.alias("low"), high.alias("high"), "first_block", "first_i", first_low.alias("first_low"), first_high.alias("first_high"))
    for side, prefix in zip(likely, ("", "first_"), strict=True) if likely else ():
        side = side.select(F.col("block").alias(f"{prefix}block"), F.col("i").alias(f"{prefix}i"), "stretches")
        within = F.expr(f"exists(stretches, x -> least(x.e, {prefix}high) - greatest(x.s, {prefix}low) >= {LEAST})")
        pairs = pairs.join(side, [f"{prefix}block", f"{prefix}i"]).where(within).drop("stretches")
    pairs = scratch.store(pairs.distinct(), f"pairs_{name}")
    scratch.drop(f"agreed_{name}")
    return pairs


def _texts(pairs: DataFrame, held: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The words of all passages of ``pairs``."""
    wanted = pairs.select("block", "i", "low", "high").unionByName(
        pairs.select(F.col("first_block").alias("block"), F.col("first_i").alias("i"), F.col("first_low").alias("low"), F.col("first_high").alias("high"))
    )
    wanted = wanted.distinct().groupBy("block").agg(F.collect_list(F.struct("i", "low", "high")).alias("wanted"))
    return scratch.store(held.join(wanted, "block").mapInArrow(_passage_rows, _TEXT_DDL), f"texts_{name}")


def _found(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """What matches of the passages of ``pairs``."""
    own = pairs.join(texts, ["block", "i", "low", "high"]).select(*_TEXT, "low", "passage", *[F.col(f"first_{x}") for x in ("block", "i", "low", "high")])
    others = texts.select(*[F.col(x).alias(f"first_{x}") for x in ("block", "i", "low", "high", "id", "passage")])
    both = own.join(others, ["first_block", "first_i", "first_low", "first_high"])
    out = both.select(*_TEXT, "low", "passage", "first_id", "first_low", "first_passage").mapInArrow(_verified_rows, _FOUND_DDL)
    return scratch.store(out.distinct(), f"found_{name}")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per passage found in an earlier document too.

    Returns doc_id, start, end (words, end exclusive), first_doc_id, first_start,
    first_end and similarity (1.0 for whole copies of a text of 50 words or
    more, which are matched by digest). Earlier means a smaller ``doc_id``; null
    ids come last and are reported as null. Null and short texts give no rows.
    A passage that several earlier documents hold, or one more than once, can give several rows.
    Candidates are found by min-hash, so a passage near the threshold can be missed;
    what is returned is verified.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    laid = lay_out(docs, scratch)
    total = laid.agg(F.sum("raw_bytes")).first()[0] or 0
    buckets = 1 + total // 15 // blocks.BUCKET_ENTRIES  # about a window per 15 bytes over all functions
    held = laid.select("block", "doc_ids", "sizes", "payload")
    copies = scratch.store(later_copies(laid, 2 * LEAST, scratch), "copies")
    skipped = copies.groupBy("block").agg(F.collect_list("i").alias("copies"))
    known = held.join(skipped, "block", "left")
    shared = answered(known.mapInArrow(_key_rows(buckets), BUCKET_SCHEMA), tied, scratch, "windows")
    windows = scratch.store(known.join(shared, "block").mapInArrow(_window_rows(buckets), _WINDOW_DDL), "tied")
    scratch.drop("windows", "first-copies")

    found = _first_round(windows, held, scratch)
    rest = scratch.store(_not_found(windows, found), "rest")
    if not rest.isEmpty():
        found = found.unionByName(_second_round(rest, windows, held, total, scratch))
    scratch.drop("tied", "rest")
    found = found.drop("block", "i")

    counted = held.select("block", "sizes", "payload").join(copies.groupBy("block").agg(F.collect_list("i").alias("copies")), "block")
    words = counted.mapInArrow(_word_counts, "block long, i int, words long")
    whole = copies.join(words, ["block", "i"]).where(F.col("words") >= LEAST + WORDS - 1)
    zero = F.lit(0).cast("long")
    whole = whole.select(
        F.col("id").alias("doc_id"), zero.alias("start"), F.col("words").alias("end"), F.col("first.id").alias("first_doc_id"), zero.alias("first_start"), F.col("words").alias("first_end"), F.lit(1.0).alias("similarity")
    )
    out = found.unionByName(whole)
    return out.withColumns({x: F.nullif(F.col(x), F.lit(LAST)) for x in ("doc_id", "first_doc_id")}).distinct()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            raws = split(row["payload"], row["sizes"])
            rows = [{"block": row["block"], "i": i, "words": len(raws[i].split())} for i in row["copies"]]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("i", pa.int32()), ("words", pa.int64())]))
