"""Best-fit-decreasing packing of token sequences into fixed windows.

A document longer than a window is first cut into full windows, each a sequence
of its own; what remains (shorter than a window) is packed longest first into
the tightest open window, found in a segment tree over remaining capacities.
Only lengths move between tasks: a piece's checksum is taken where its document
is tokenised, because cuts depend on the document's length alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches
from sluice.llm.tokens import WORD_CHUNK, chunk_encoder

WINDOW = 4096
#: Pieces packed together in one task; bounds its memory.
PIECES_AT_ONCE = 200_000

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


class CapacityTree:
    """Open windows by remaining capacity; a bit per node says whether any lies below."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.any = bytearray(2 * self.leaves)

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        node = self.leaves + capacity
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def tightest(self, size: int) -> int | None:
        """Smallest remaining capacity of at least ``size``."""
        node = self.leaves + size
        if self.any[node]:
            return size
        while node > 1:
            if not node & 1 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, capacity: int) -> int:
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            node = self.leaves + capacity
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return sequence


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Sequence number and offset of each length; the number of sequences."""
    tree, count = CapacityTree(window), 0
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        left = tree.tightest(size)
        if left is None:
            left, number = window, count
            count += 1
        else:
            number = tree.take(left)
        sequence[i], offset[i] = number, window - left
        if left > size:
            tree.add(left - size, number)
    return sequence, offset, count


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """One row per piece of each document's ids plus ``end_id``.

    Null text is empty (one piece holding ``end_id``); repeated rows are
    documents of their own; a null ``doc_id`` stays null.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(vocabulary, WORD_CHUNK)
        for batch in batches:
            rows: list[tuple] = []
            every, at = encoder.encode_column(batch.column(1), end_id)
            every, at = memoryview(every.tobytes()), at.tolist()
            for doc_id, begin, end in zip(batch.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                ids, total = every[4 * begin : 4 * end], end - begin
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    bound_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(cut, PIECE_SCHEMA)


def pack_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Place every piece: ``sequence_id`` and gapless ``offset`` from 0.

    The pieces (a few numbers each) are spread evenly over tasks, and each task
    packs up to ``PIECES_AT_ONCE`` of them together, so a window holds pieces of
    one task only. ``sequence_id`` is the task's number times 2^40 plus a count.
    """

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = TaskContext.get().partitionId() << 40
        held: list[pd.DataFrame] = []
        waiting = 0

        def packed() -> pd.DataFrame:
            nonlocal base
            frame = pd.concat(held, ignore_index=True)
            sequence, offset, count = best_fit_decreasing(frame["length"].tolist(), window)
            frame["sequence_id"], frame["offset"] = sequence, offset
            frame["sequence_id"] += base
            base += count
            return frame

        for frame in frames:
            held.append(frame)
            waiting += len(frame)
            if waiting >= PIECES_AT_ONCE:
                yield packed()
                held, waiting = [], 0
        if waiting:
            yield packed()

    spread = pieces.hint("rebalance").sortWithinPartitions("doc_id", "start", "ids_crc32")
    return spread.mapInPandas(place, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """Pack all documents; an empty table gives no rows."""
    return pack_pieces(token_pieces(docs, vocabulary, end_id, window), window)
