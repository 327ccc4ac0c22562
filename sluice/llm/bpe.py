"""Byte-level BPE over padded numpy matrices.

Distinct pre-tokens of a batch are sorted into length buckets; a bucket is one
matrix with a row per pre-token. Each round finds every row's leftmost pair of
minimum rank in a hash table of pairs, merges it and closes the gap; rows with
no pair left leave the matrix, and it narrows to its longest row.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches
from sluice.llm.tokens import BYTE_LEVEL_CHUNK

#: Chunks and pre-tokens whose ids a worker keeps.
CACHE_CHUNKS = 700_000
#: Longer pre-tokens (rare: unbroken runs) merge by a heap with the same rule, as a matrix row would take quadratic time.
LONGEST_ROW = 2048
#: Cells of one matrix.
CELLS = 1 << 21
NONE = np.int32(np.iinfo(np.int32).max)

_loaded: dict[tuple[str, str], Codec] = {}


class PairTable:
    """Open-addressing hash table from a pair of ids to the merged id (its rank)."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, NONE)
        self.probes = 1
        waiting, place = np.arange(len(keys)), self._place(keys)
        while len(waiting):
            free = self.values[place] == NONE
            spot, first = np.unique(place[free], return_index=True)
            winners = waiting[free][first]
            self.keys[spot], self.values[spot] = keys[winners], values[winners]
            lost = ~np.isin(waiting, winners)
            waiting, place = waiting[lost], (place[lost] + 1) & self.mask
            self.probes += bool(len(waiting))

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where it is no token; negative ids are padding."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        place = self._place(keys)
        out = np.where(self.keys[place] == keys, self.values[place], NONE)
        open_ = np.flatnonzero((out == NONE) & (self.values[place] != NONE))
        for _ in range(self.probes):
            if not len(open_):
                break
            place[open_] = (place[open_] + 1) & self.mask
            at = place[open_]
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.values[at] != NONE)]
        return out


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = PairTable(self.ranks)
        self.pre_tokens = regex.compile(pattern).findall
        self.chunks = re.compile(BYTE_LEVEL_CHUNK).findall
        self.known: dict[str, tuple[str, int, bytes]] = {}

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token."""
        out: list[list[int]] = [[]] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[i] = [whole]
            elif len(word) > LONGEST_ROW:
                out[i] = self._by_heap(word)
            else:
                n = len(word)
                buckets.setdefault(n if n <= 16 else -(-n // 16) * 16 if n <= 64 else 1 << (n - 1).bit_length(), []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for lo in range(0, len(rows), step):
                part = rows[lo : lo + step]
                for i, ids in zip(part, self._merge([words[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge(self, words: list[bytes], width: int) -> list[list[int]]:
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        ids = np.where(np.arange(width) < size[:, None], self.byte_ids[raw], -1)
        rank = self._ranks(ids)
        row = np.arange(len(words))
        out: list[list[int]] = [[]] * len(words)
        while len(row):
            at = rank.argmin(axis=1)  # the leftmost of the least
            all_rows = np.arange(len(row))
            best = rank[all_rows, at]
            done = best == NONE
            if done.any():
                for i, r, n in zip(row[done].tolist(), ids[done].tolist(), size[done].tolist(), strict=True):
                    out[i] = r[:n]
                keep = ~done
                row, size, at, best = row[keep], size[keep], at[keep], best[keep]
                if not len(row):
                    break
                width = int(size.max())
                ids, rank = ids[keep][:, :width], rank[keep][:, : width - 1]
                all_rows = np.arange(len(row))
            column = np.arange(width - 1)
            after = column[None, :] > at[:, None]
            new = np.where(after, ids[:, 1:], ids[:, :-1])
            new[all_rows, at] = best
            new_rank = np.where(after[:, : width - 2], rank[:, 1:], rank[:, :-1])
            ids = np.concatenate([new, np.full((len(row), 1), -1)], axis=1)
            rank = np.concatenate([new_rank, np.full((len(row), 1), NONE)], axis=1)
            size = size - 1
            for beside in (at - 1, at):
                real = np.flatnonzero((beside >= 0) & (beside + 1 < size))
                b = beside[real]
                rank[real, b] = self.pairs.rank(ids[real, b], ids[real, b + 1])
                gone = np.flatnonzero((beside >= 0) & (beside + 1 >= size))
                rank[gone, beside[gone]] = NONE
        return out

    def _ranks(self, ids: np.ndarray) -> np.ndarray:
        left, right = ids[:, :-1], ids[:, 1:]
        out = np.full(left.shape, NONE)
        real = right >= 0
        out[real] = self.pairs.rank(left[real], right[real])
        return out

    def _by_heap(self, word: bytes) -> list[int]:
        ids: list[int | None] = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        first = self.pairs.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        current = dict(enumerate(first))

        def renew(i: int) -> None:
            j = after[i]
            pair = self.ranks.get(self.bytes_of[ids[i]] + self.bytes_of[ids[j]]) if j < len(ids) else None
            current[i] = pair
            if pair is not None:
                heapq.heappush(heap, (pair, i))

        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] is None or current[i] != r:
                continue
            j = after[i]
            ids[i], ids[j] = r, None
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return [i for i in ids if i is not None]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def _learn(self, chunks: set[str]) -> None:
        """Ids of new chunks, each by its pre-tokens; a chunk ends where a pre-token does."""
        words = {c: [w.encode() for w in self.pre_tokens(c)] for c in chunks}
        distinct = list({w for ws in words.values() for w in ws})
        ids = dict(zip(distinct, self.encode_words(distinct), strict=True))
        for c, ws in words.items():
            own = [i for w in ws for i in ids[w]]
            self.known[c] = (",".join(map(str, own)), len(own), self.decode(own))

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[list[str], int, bytes]]:
        """Per text: runs of decimal ids joined by commas, their number, the decoded bytes."""
        split = [self.chunks(t) for t in texts]
        if len(self.known) > CACHE_CHUNKS:
            self.known.clear()
        known = self.known
        new = {c for chunks in split for c in chunks if c not in known}
        if new:
            self._learn(new)
        for chunks in split:
            got = [known[c] for c in chunks]
            yield [g[0] for g in got], sum([g[1] for g in got]), b"".join([g[2] for g in got])

    def encode(self, text: str) -> list[int]:
        runs = next(self.encode_texts([text]))[0]
        return [int(i) for i in ",".join(runs).split(",")] if runs else []


def codec(path: str, pattern: str) -> Codec:
    """The worker's own codec for a rank file."""
    key = (path, pattern)
    if key not in _loaded:
        _loaded[key] = Codec(path, pattern)
    return _loaded[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode and decode every whole text.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas)
    and decoded_sha256 (of the decoded bytes). Null text is empty; repeated rows
    give a row each; an empty table gives none.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for runs, n, raw in own.encode_texts(texts):
                counts.append(n)
                ids.append(hashlib.sha256(",".join(runs).encode()).hexdigest())
                decoded.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    bound_batches(docs.sparkSession, 4 << 20)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
