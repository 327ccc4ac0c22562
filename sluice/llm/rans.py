"""Token ids as binary blocks of a static range asymmetric numeral system.

One frequency table, counted over the whole corpus, serves every block. A block
holds up to ``BLOCK_TOKENS`` ids dealt over interleaved lanes (id ``i`` belongs
to lane ``i % lanes``), each lane a 64-bit state that spills 32-bit words into
one shared stream. Every ``CHECKPOINT_STEPS`` steps the block notes the states
and the place in the stream, so its segments decode side by side, and a crc32
per segment proves each. Blocks do not depend on each other.

Files are Parquet rows, one per block: ``shard`` and ``block`` give the order,
``doc_ids``, ``doc_starts`` and ``part_tokens`` say which documents (or parts of
a long one) the block carries, ``payload`` is the block itself. The table lies
beside them. Spark's committers write both, so a lost executor leaves no half file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, bound_batches, partitions
from sluice.llm.tokens import BYTE_LEVEL_CHUNK, chunk_encoder

SCALE = 20
LOW = 1 << 31
BLOCK_TOKENS = 1 << 20
LANES = 1024
CHECKPOINT_STEPS = 256
MAGIC = b"RNS1"

BLOCK_SCHEMA = (
    "shard int, block int, first_token long, n_tokens long, doc_ids array<long>, "
    "doc_starts array<long>, part_tokens array<long>, payload binary"
)


class Table:
    """Static frequencies, scaled to a sum of 2^SCALE; every counted symbol keeps at least 1."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq)

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Table:
        total = int(counts.sum())
        freq = np.where(counts > 0, np.maximum(1, counts * float(1 << SCALE) // max(1, total)), 0).astype(np.int64)
        short = (1 << SCALE) - int(freq.sum()) if total else 0
        while short:
            for i in np.argsort(-freq, kind="stable"):  # the most frequent give or take first
                move = short if short > 0 else max(short, -int(freq[i] // 2))
                freq[i] += move
                short -= move
                if not short:
                    break
        return cls(freq)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = 1 << max(0, min(LANES.bit_length() - 1, (n // 64).bit_length() - 1))
    steps = -(-n // lanes)
    freq, start = table.freq[ids], table.start[ids]
    if n and not freq.all():
        raise ValueError("an id was not counted in the frequency table")
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    saved: list[np.ndarray] = []
    spill, half = np.uint64(63 - SCALE), np.uint64(32)
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes : (t + 1) * lanes], start[t * lanes : (t + 1) * lanes]
        x = state[: len(f)]
        full = x >= f << spill
        words.append(x[full].astype(np.uint32))  # the low half
        x = x >> (full * half)
        q = x // f
        state[: len(f)] = (q << np.uint64(SCALE)) + (x - q * f) + c
        if t % CHECKPOINT_STEPS == 0:
            saved.append(state.copy())
    words.reverse()
    saved.reverse()
    sizes = np.array([len(w) for w in words], np.int64)
    places = np.concatenate([[0], np.cumsum(sizes)])[:-1][::CHECKPOINT_STEPS] if steps else np.zeros(0, np.int64)
    raw = ids.astype("<u4").tobytes()
    span = 4 * lanes * CHECKPOINT_STEPS
    crcs = [zlib.crc32(raw[i : i + span]) for i in range(0, len(raw), span)]
    head = MAGIC + struct.pack("<IIII", n, lanes, CHECKPOINT_STEPS, len(saved))
    return b"".join(
        [head, places.astype("<u4").tobytes(), np.array(crcs, "<u4").tobytes(), *[s.astype("<u8").tobytes() for s in saved]]
        + [w.astype("<u4").tobytes() for w in words]
    )


def decode_block(payload: bytes, table: Table, segments: slice = slice(None)) -> np.ndarray:
    """The ids of a block, or of some of its segments; raises ValueError on damage."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token block")
    n, lanes, every, count = struct.unpack_from("<IIII", payload, 4)
    at = 20
    places = np.frombuffer(payload, "<u4", count, at).astype(np.int64)
    crcs = np.frombuffer(payload, "<u4", count, at + 4 * count)
    at += 8 * count
    states = np.frombuffer(payload, "<u8", count * lanes, at).reshape(count, lanes).astype(np.uint64)
    words = np.frombuffer(payload, "<u4", -1, at + 8 * count * lanes).astype(np.uint64)
    span = every * lanes
    wanted = list(range(count))[segments]
    whole = [s for s in wanted if (s + 1) * span <= n]
    parts: dict[int, np.ndarray] = {}
    if whole:
        begun = states[whole]
        got = _decode_side_by_side(begun, places[whole], words, table, span)
        states[whole] = begun
        parts.update(zip(whole, got, strict=True))
    for s in set(wanted) - set(whole):
        parts[s] = _decode_side_by_side(states[s : s + 1], places[s : s + 1], words, table, n - s * span)[0]
    if wanted and wanted[-1] == count - 1 and (states[-1] != LOW).any():
        raise ValueError("the stream does not end where it began")
    for s in wanted:
        if zlib.crc32(parts[s].tobytes()) != crcs[s]:
            raise ValueError(f"checksum of segment {s} does not match")
    return np.concatenate([parts[s] for s in wanted]) if wanted else np.zeros(0, "<u4")


def _decode_side_by_side(state, place, words, table: Table, n: int) -> np.ndarray:
    """``n`` ids of each segment, all segments one step at a time; leaves the last states in ``state``."""
    count, lanes = state.shape
    out = np.empty((count, n), "<u4")
    mask, scale, half = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    place = place.tolist()
    for lo in range(0, n, lanes):
        width = min(lanes, n - lo)
        x = state[:, :width]
        slot = x & mask
        symbol = table.symbol.take(slot.view(np.int64))
        out[:, lo : lo + width] = symbol
        x = (x >> scale) * table.freq.take(symbol) + (slot - table.start.take(symbol))
        low = np.flatnonzero((x < LOW).ravel())
        ends = np.searchsorted(low, np.arange(width, (count + 1) * width, width)).tolist()
        more, begin = [], 0
        for s, end in enumerate(ends):
            more.append(words[place[s] : place[s] + end - begin])
            place[s] += end - begin
            begin = end
        flat = x.reshape(-1)
        got = np.concatenate(more)
        if len(got) != len(low):
            raise ValueError("the stream ends early")
        flat[low] = (flat[low] << half) | got
        state[:, :width] = flat.reshape(count, width)
    return out


def crc32_combine(a: int, b: int, length: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the second one's length."""

    def times(matrix: list[int], vector: int) -> int:
        out = 0
        for row in matrix:
            if not vector:
                break
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    matrix = [0xEDB88320, *[1 << i for i in range(31)]]  # appends one zero bit
    bits = 8 * length
    while bits:
        if bits & 1:
            a = times(matrix, a)
        matrix = [times(matrix, row) for row in matrix]
        bits >>= 1
    return a ^ b


def tokenise(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, ids (little-endian, two bytes each where the vocabulary allows), width (bytes an id)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(vocabulary, BYTE_LEVEL_CHUNK)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        for batch in batches:
            ids, at = encoder.encode_column(batch.column(1), end_id, f"<u{width}")
            held = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((at * width).astype("<i4")), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column(0), held, pa.array([width] * batch.num_rows, pa.int32())], ["doc_id", "ids", "width"])

    bound_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(encode, "doc_id long, ids binary, width int")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    for doc_id, ids, width in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
        yield doc_id, np.frombuffer(ids.as_buffer(), f"<u{width}")


def count_ids(tokenised: DataFrame) -> np.ndarray:
    """Occurrences of every id over all documents, up to the largest id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            rows = [ids for _, ids in _rows(batch)]
            got = np.bincount(np.concatenate(rows) if rows else np.zeros(0, np.int64), minlength=len(total))
            got[: len(total)] += total
            total = got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    rows = tokenised.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.n
    return counts


def write_ids(docs: DataFrame, scratch: Scratch, vocabulary: str, end_id: int = 0) -> None:
    """Write all documents' ids (each with ``end_id``) in ascending ``doc_id`` order.

    Null text is empty; repeated rows are written one after the other; a null
    ``doc_id`` comes first. An empty table writes no block. A document longer
    than a block goes on in the next.
    """
    spark = docs.sparkSession
    tokenised = scratch.store(tokenise(docs, vocabulary, end_id), "ids")
    freq = Table.from_counts(count_ids(tokenised)).freq.astype("<u4").tobytes()
    spark.createDataFrame([(SCALE, bytearray(freq))], "scale int, freq binary").coalesce(1).write.parquet(scratch.path("table"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(np.frombuffer(freq, "<u4"))
        shard = TaskContext.get().partitionId()
        held: list[tuple[int | None, int, np.ndarray]] = []
        room, written, block = BLOCK_TOKENS, 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([h[2] for h in held])
            values = [
                pa.array([shard], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([written], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                pa.array([[len(h[2]) for h in held]], pa.list_(pa.int64())),
                pa.array([encode_block(ids, table)], pa.binary()),
            ]
            names = ["shard", "block", "first_token", "n_tokens", "doc_ids", "doc_starts", "part_tokens", "payload"]
            return pa.RecordBatch.from_arrays(values, names)

        for batch in batches:
            for doc_id, ids in _rows(batch):
                begin = written + BLOCK_TOKENS - room
                while len(ids):
                    held.append((doc_id, begin, ids[:room]))
                    ids = ids[room:]
                    room -= len(held[-1][2])
                    if not room:
                        yield flush()
                        written += BLOCK_TOKENS
                        held, room, block = [], BLOCK_TOKENS, block + 1
        if held:
            yield flush()

    ordered = tokenised.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("ids"))
    scratch.store(ordered.mapInArrow(blocks, BLOCK_SCHEMA), "blocks", "uncompressed")
    scratch.drop("ids")


def read_documents(scratch: Scratch) -> DataFrame:
    """Decode the files: per document ``start``, ``n_tokens`` and ``ids_crc32``."""
    spark = scratch.spark
    freq = bytes(spark.read.parquet(scratch.path("table")).first()["freq"])
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(scratch.path("blocks"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(np.frombuffer(freq, "<u4"))
        names = ["shard", "doc_id", "doc_start", "part_start", "n", "crc"]
        for batch in batches:
            rows: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            for shard, first, doc_ids, starts, sizes, payload in zip(*columns, strict=True):
                raw, at = memoryview(decode_block(payload, table).tobytes()), 0
                for doc_id, start, n in zip(doc_ids, starts, sizes, strict=True):
                    rows.append((shard, doc_id, start, first + at, n, zlib.crc32(raw[4 * at : 4 * (at + n)])))
                    at += n
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays(arrays, names)

    parts = stored.select("shard", "first_token", "doc_ids", "doc_starts", "part_tokens", "payload").mapInArrow(
        decode, "shard long, doc_id long, doc_start long, part_start long, n long, crc long"
    )
    docs = parts.groupBy("shard", "doc_start", "doc_id").agg(
        F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("part_start", "n", "crc"))).alias("parts")
    )
    combine = F.pandas_udf(_combine_parts, "long")
    docs = docs.withColumn("ids_crc32", combine("parts"))
    per_shard = stored.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = per_shard.select(
        F.col("shard").cast("long").alias("shard"),
        F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
    )
    return docs.join(before, "shard").select(
        "doc_id", (F.col("base") + F.col("doc_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def _combine_parts(parts: pd.Series) -> pd.Series:
    """crc32 of a document from its parts in order (a long one goes over several blocks)."""
    out = []
    for row in parts:
        crc = int(row[0]["crc"])
        for part in row[1:]:
            crc = crc32_combine(crc, int(part["crc"]), 4 * int(part["n"]))
        out.append(crc)
    return pd.Series(out, dtype="int64")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write the ids of ``docs`` and read them back from the files."""
    scratch = Scratch(docs.sparkSession, "token-ids")
    write_ids(docs, scratch, vocabulary, end_id)
    return read_documents(scratch)
