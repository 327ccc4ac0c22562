"""Alignment of two tokenizers' ids over the same bytes.

Texts are cut where neither tokenizer can join: before a single blank between
characters that are no white space. A worker aligns each distinct piece once and
keeps the result up to a bound of bytes; past it, pieces that no later text held
go first. In a piece, the spans that the
libraries report are coarse cuts. Where several tokens share a character, or a
token has no width of its own (byte fallback), the decoded bytes place the cut.

Pairs of linked ids are counted over documents task by task, then shuffled. The
commonest pairs (``HOT_PAIRS`` at most) are looked up inside the tasks and the
rest are joined with the stored table of all pairs.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import WHITE_SPACE, Scratch, bound_batches, held_by_worker
from sluice.llm.frequent import commonest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

HOT_PAIRS = 1 << 20
#: Bytes of aligned pieces that a worker keeps, pieces aligned at once, characters of text worked on at once.
CACHE_BYTES = 220 << 20
PIECES_AT_ONCE = 20_000
CHARACTERS_AT_ONCE = 4 << 20
#: Pairs a task counts before it hands them on.
PAIRS_AT_ONCE = 4 << 20
#: A pair is one number: the first id times 2^15, plus the second (which is below 2^15).
SECOND_BITS = 15
BLANK_MARK = "▁"

CUT = re.compile(f"(?<=[^{WHITE_SPACE}]) (?=[^{WHITE_SPACE}])")

ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
)
LOOKED_UP = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "n_best long, count_sum long, cold array<struct<pair: long, times: long>>"
)

def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@contextmanager
def no_collection() -> Iterator[None]:
    """The libraries' results are many small objects without cycles: the collector would walk them, and all kept pieces, over and over."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


def within(counts: np.ndarray) -> np.ndarray:
    """Place of each item in its run, for runs of the given lengths one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def token_ends(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Byte offset at which each token ends, texts laid one after the other.

    ``begin`` and ``end`` are the reported spans in bytes, ``sizes`` the decoded sizes, ``last`` the
    tokens that close a text. A span's end is taken where the span has a width
    and the next one begins no earlier; any other token ends its decoded size
    after the one before it.
    """
    sure = (end > begin) & (last | (np.append(begin[1:], 0) >= end))
    run = np.cumsum(sizes)
    before = np.maximum.accumulate(np.where(sure, np.arange(len(run)), -1))
    shift = np.where(sure, end - run, 0)
    return run + np.where(before >= 0, shift[before], 0)


def links_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of either side whose byte ranges overlap; both are given by their ends, the last ones equal."""
    first = np.searchsorted(b, np.append(0, a[:-1]), side="right")
    counts = np.searchsorted(b, a, side="left") - first + 1
    return np.repeat(np.arange(len(a)), counts), np.repeat(first, counts) + within(counts)


class Aligner:
    """Both tokenizers and the pieces aligned so far."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_level)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet, size = byte_alphabet(), self.first.get_vocab_size()
        tokens = [self.first.id_to_token(i) or "" for i in range(size)]
        self.first_bytes = [bytes(alphabet.get(c, 63) for c in t) for t in tokens]
        self.second_bytes = [self._piece_bytes(i) for i in range(self.second.get_piece_size())]
        self.first_table, self.second_table = map(self._table, (self.first_bytes, self.second_bytes))
        #: each id followed by ',', and by what closes its side of a group
        self.written = [f"{i}{c}" for i in range(size) for c in ",|"] + [f"{i}{c}" for i in range(len(self.second_bytes)) for c in ",;"]
        if len(self.second_bytes) > 1 << SECOND_BITS:
            raise ValueError(f"the second vocabulary has more than {1 << SECOND_BITS} ids")
        self.clear()

    @staticmethod
    def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes one after the other, where each begins and its length."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace(BLANK_MARK, " ").encode()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        #: ids of a piece's groups as text with a closing ';', None where the bytes differ
        self.groups: list[str | None] = []
        self.counts = np.zeros((0, 4), np.int64)  # tokens of either side, groups, links
        self.pairs = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.met = np.zeros(0, bool)  # whether a later call held the piece too
        self.bytes = 0

    def make_room(self) -> None:
        """Keep the pieces met again since the last time, where they take half the bound at most."""
        kept = np.flatnonzero(self.met)
        bytes_ = round(self.bytes * len(kept) / max(len(self.met), 1))
        if not len(kept) or bytes_ > CACHE_BYTES // 2:
            self.clear()
            return
        self.place = {p: i for i, p in enumerate(compress(self.place, self.met.tolist()))}
        self.groups = [self.groups[i] for i in kept.tolist()]
        of_kept = np.repeat(self.met, self.counts[:, 3])
        self.counts, self.pairs = self.counts[kept], self.pairs[of_kept]
        self.starts = np.append(0, np.cumsum(self.counts[:, 3]))
        self.met = np.zeros(len(kept), bool)
        self.bytes = bytes_

    def learn(self, pieces: list[str]) -> None:
        """Align pieces that are not known yet, many at once."""
        learnt = [self._align(pieces[at : at + PIECES_AT_ONCE]) for at in range(0, len(pieces), PIECES_AT_ONCE)]
        if learnt:
            counts, pairs = (np.concatenate(c) for c in zip(*learnt, strict=True))
            self.counts, self.pairs = np.concatenate([self.counts, counts]), np.concatenate([self.pairs, pairs])
            self.starts = np.append(0, np.cumsum(self.counts[:, 3]))
            self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces)), strict=True))
            self.met = np.append(self.met, np.zeros(len(pieces), bool))
            self.bytes += 300 * len(pieces) + 4 * len(pairs) + sum(map(len, pieces))

    @staticmethod
    def _same(ids: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray], text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the tokens of each piece give its bytes; the pieces' bytes and sizes lie one after the other."""
        raw, starts, lengths = table
        length = lengths[ids]
        total = np.diff(np.append(0, np.cumsum(length))[np.append(0, np.cumsum(counts))])
        own = raw[np.repeat(starts[ids], length) + within(length)]
        same = total == sizes
        if same.all():
            wrong = np.flatnonzero(own != text)
        else:  # compare what has the right size
            wrong = np.zeros(0, np.int64)
            kept = own[np.repeat(same, total)] != text[np.repeat(same, sizes)]
            wrong = np.flatnonzero(np.repeat(same, sizes))[kept]
        same[np.searchsorted(np.cumsum(sizes), wrong, side="right")] = False
        return same

    def _align(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(counts, pairs) of pieces; their group texts are added to ``groups``."""
        spaced = [" " + p for p in pieces]
        of_a = self.first.encode_batch(spaced, add_special_tokens=False)
        ids_a, spans_a = [e.ids for e in of_a], [e.offsets for e in of_a]
        # the spans of the immutable proto, which this version of the library gives in this form
        of_b = self.second.encode(pieces, num_threads=1, return_type="offset_mapping")
        ids_b, spans_b = [e["ids"] for e in of_b], [e["offsets"] for e in of_b]
        raw = [s.encode() for s in spaced]
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(pieces)) for x in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, n.sum()) for x, n in ((ids_a, n_a), (ids_b, n_b)))
        spans_a, spans_b = (
            np.fromiter(chain.from_iterable(chain.from_iterable(x)), np.int64, 2 * n.sum()).reshape(-1, 2) for x, n in ((spans_a, n_a), (spans_b, n_b))
        )

        # character offsets to byte offsets, all pieces laid one after the other
        text = np.frombuffer(b"".join(raw), np.uint8)
        byte_at = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
        chars, sizes = (np.fromiter(map(len, x), np.int64, len(pieces)) for x in (spaced, raw))
        good = self._same(a, n_a, self.first_table, text, sizes) & self._same(b, n_b, self.second_table, text, sizes)
        base_a, base_b = (np.repeat(np.cumsum(chars) - chars, n) for n in (n_a, n_b))
        begin_a, end_a = byte_at[spans_a[:, 0] + base_a], byte_at[spans_a[:, 1] + base_a]
        # the blank that the second tokenizer adds is character 0 of a piece
        begin_b, end_b = byte_at[spans_b[:, 0] + base_b + (within(n_b) > 0)], byte_at[spans_b[:, 1] + base_b + 1]

        keep_a, keep_b = np.repeat(good, n_a), np.repeat(good, n_b)
        a, b = a[keep_a], b[keep_b]
        piece_a, piece_b = (np.repeat(np.arange(len(pieces)), n)[k] for n, k in ((n_a, keep_a), (n_b, keep_b)))
        # the bytes of pieces that are left out close up
        gone = (np.cumsum(np.where(good, 0, sizes)) - np.where(good, 0, sizes))
        ends = []
        for begin, end, keep, piece, table, ids in ((begin_a, end_a, keep_a, piece_a, self.first_table[2], a), (begin_b, end_b, keep_b, piece_b, self.second_table[2], b)):
            last = np.append(piece[1:] != piece[:-1], True)[: len(piece)]
            ends.append(token_ends(begin[keep] - gone[piece], end[keep] - gone[piece], table[ids], last))
        ends_a, ends_b = ends
        counts, pairs = np.zeros((len(pieces), 4), np.int64), np.zeros(0, np.uint32)
        texts: list[str | None] = [None] * len(pieces)
        if len(a):
            i, j = links_of(ends_a, ends_b)
            pairs = (a[i] << SECOND_BITS | b[j]).astype(np.uint32)
            close_a, close_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
            group_a, group_b = (np.cumsum(c) - c for c in (close_a, close_b))
            counts[:, 0], counts[:, 1] = (np.bincount(p, minlength=len(pieces)) for p in (piece_a, piece_b))
            counts[:, 2] = np.bincount(piece_a[close_a], minlength=len(pieces))
            counts[:, 3] = np.bincount(piece_a[i], minlength=len(pieces))
            # in each group the first ids, then the second ones; a separator follows each id
            order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), np.concatenate([group_a, group_b])))
            codes = np.concatenate([2 * a + close_a, 2 * (len(self.first_bytes) + b) + close_b])[order]
            words = list(map(self.written.__getitem__, codes.tolist()))
            stops = np.cumsum(counts[:, 0] + counts[:, 1]).tolist()
            for k, (start, stop) in enumerate(zip([0, *stops], stops)):
                if good[k]:
                    texts[k] = "".join(words[start:stop])
        self.groups += texts
        self.bytes += sum(len(t) for t in texts if t)
        return counts, pairs

    def documents(self, texts: list[str]) -> list[tuple[tuple[int, int, int, int], str, np.ndarray, np.ndarray]]:
        """Of each text: counts, digest of its groups, its distinct pairs ascending and how often each is linked."""
        out: list = []
        held: list[list[str]] = []
        waiting = 0
        for text in texts:
            if len(text) > CHARACTERS_AT_ONCE:
                out += self._together(held) + [self._alone(text)]
                held, waiting = [], 0
                continue
            held.append(CUT.split(text) if text else [])
            waiting += len(text)
            if waiting > CHARACTERS_AT_ONCE:
                out += self._together(held)
                held, waiting = [], 0
        return out + self._together(held)

    def _known(self, texts: list[list[str]]) -> list[np.ndarray]:
        if self.bytes > CACHE_BYTES:
            self.make_room()
        before = len(self.place)
        every = list(chain.from_iterable(texts))
        self.learn([*(dict.fromkeys(every).keys() - self.place.keys())])
        at = np.fromiter(map(self.place.__getitem__, every), np.int64, len(every))
        self.met[at[at < before]] = True
        return np.split(at, np.cumsum([len(pieces) for pieces in texts])[:-1])

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, str, np.ndarray, np.ndarray] | None:
        """(counts, group text with a closing ';', distinct pairs, times) of some pieces; None where one has no tokens."""
        groups = list(map(self.groups.__getitem__, at.tolist()))
        if None in groups:
            return None
        counts, starts = self.counts[at], self.starts[at]
        pairs = self.pairs[np.repeat(starts, counts[:, 3]) + within(counts[:, 3])]
        return counts.sum(axis=0), "".join(groups), *np.unique(pairs, return_counts=True)

    def _together(self, texts: list[list[str]]) -> list:
        out = []
        for at in self._known(texts) if texts else ():
            found = self._gathered(at) if len(at) else None
            if found is None:
                out.append(NOTHING)
            else:
                out.append((tuple(found[0].tolist()), hashlib.sha256(found[1][:-1].encode()).hexdigest(), found[2], found[3]))
        return out

    def _alone(self, text: str) -> tuple:
        """A long text, in runs of pieces."""
        digest, counts, start, close = hashlib.sha256(), np.zeros(4, np.int64), 0, ""
        pairs, times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        while start < len(text):
            cut = CUT.search(text, min(start + CHARACTERS_AT_ONCE, len(text)))
            end = cut.start() if cut else len(text)
            (at,) = self._known([CUT.split(text[start:end])])
            found = self._gathered(at)
            if found is None:
                return NOTHING
            digest.update((close + found[1][:-1]).encode())
            counts += found[0]
            pairs, where = np.unique(np.concatenate([pairs, found[2]]), return_inverse=True)
            times = np.bincount(where, np.concatenate([times, found[3]]), len(pairs)).astype(np.int64)
            start, close = (cut.end() if cut else len(text)), ";"
        return tuple(counts.tolist()), digest.hexdigest(), pairs, times


#: What a text without tokens has.
NOTHING = ((0, 0, 0, 0), "", np.zeros(0, np.uint32), np.zeros(0, np.int64))


def _aligner(byte_level: str, pieces: str) -> Aligner:
    """The worker's own aligner of two vocabularies."""
    return held_by_worker(("aligner", byte_level, pieces), lambda: Aligner(byte_level, pieces))


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Counts, digest and distinct pairs (as ascending differences) of each row (row, doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces)
        for batch in batches:
            with no_collection():
                found = aligner.documents([t or "" for t in batch.column("text").to_pylist()])
            numbers = [pa.array([f[0][i] for f in found], pa.int64()) for i in range(4)]
            steps = [np.diff(f[2], prepend=np.uint32(0)).tobytes() for f in found]
            columns = [batch.column("row"), batch.column("doc_id"), *numbers, pa.array([f[1] for f in found], pa.string())]
            columns += [pa.array(steps, pa.binary()), pa.array([f[3].astype(np.uint32).tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")])

    return docs.mapInArrow(run, ALIGNED)


def _pairs(steps: pa.Scalar) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps.as_py(), np.uint32), dtype=np.uint32)


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each pair, and whether no pair of its first id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def handed_on() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

        for batch in batches:
            for steps in batch.column("pairs"):
                held.append(_pairs(steps))
                waiting += len(held[-1])
                if waiting > PAIRS_AT_ONCE:
                    yield handed_on()
                    held, waiting = [], 0
        if waiting:
            yield handed_on()

    counts = documents.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # as many pairs at most share a first id as the second vocabulary has ids
    same_first = Window.partitionBy(F.shiftright("pair", SECOND_BITS))
    return counts.withColumn("best", F.col("n") == F.max("n").over(same_first))


def look_up(documents: DataFrame, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Sums over the links of each document whose pair is among ``hot`` (pairs ascending, n, best); the other pairs as ``cold``."""
    shared = documents.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            bests, sums, cold = [], [], []
            for steps, times in zip(batch.column("pairs"), batch.column("times"), strict=True):
                pairs, times = _pairs(steps), np.frombuffer(times.as_py(), np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                met = keys[at] == pairs
                bests.append(int((times * best[at] * met).sum()))
                sums.append(int((times * n[at] * met).sum()))
                cold.append([{"pair": p, "times": t} for p, t in zip(pairs[~met].tolist(), times[~met].tolist(), strict=True)])
            names = [c.split()[0] for c in LOOKED_UP.split(", ")][:7]
            cold_type = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
            columns = [batch.column(c) for c in names] + [pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), pa.array(cold, cold_type)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_best", "count_sum", "cold"])

    return documents.mapInArrow(run, LOOKED_UP)


def align_documents(docs: DataFrame, byte_level: str, pieces: str, hot_pairs: int = HOT_PAIRS, scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``byte_level`` is a file of the tokenizers library (ids A, of a blank and the
    text), ``pieces`` a sentencepiece model that adds that blank (ids B). A null
    or empty text, and one that either side does not give back byte by byte (one
    that holds U+2581, say), has no tokens: zeros and ''. Repeated rows and ids
    are documents of their own and count as such; an id may be null. Without
    rows there are none. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "alignment")
    bound_batches(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    documents = scratch.store(aligned(rows, byte_level, pieces), "documents")
    counts = scratch.store(pair_counts(documents), "pairs")
    is_hot, _ = commonest(counts, hot_pairs)
    hot = counts.where(is_hot).toPandas().sort_values("pair")
    # one pair that no text holds, so that the table is never empty
    table = tuple(np.append(hot[c].to_numpy(t), t(v)) for c, t, v in (("pair", np.uint32, 2**32 - 1), ("n", np.int64, 0), ("best", np.int64, 0)))
    found = scratch.store(look_up(documents, table), "found")

    cold = found.select("row", F.explode("cold").alias("c")).select("row", "c.pair", F.col("c.times").alias("times"))
    rest = cold.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    return found.drop("cold").join(rest, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
