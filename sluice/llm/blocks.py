"""Texts laid out in blocks, and questions about their strings asked bucket by bucket.

A table of documents is written once as blocks of about ``BLOCK_BYTES`` of text,
bucketed by block. To compare strings of all documents, each block sends
fingerprints (equal ones once) to buckets, a task sorts one bucket at a time and
answers with a bit per fingerprint, and the answers join their blocks where
those lie, so texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, bound_batches, partitions, release_held

BLOCK_BYTES = 8 << 20
#: Entries sorted together in one task.
BUCKET_ENTRIES = 4_000_000

BLOCK_SCHEMA = "block long, n_docs int, raw_bytes long, doc_ids array<long>, sizes array<long>, digests array<binary>, payload binary"
BUCKET_SCHEMA = "block long, bucket int, docs array<long>, counts array<int>, entries binary"
ANSWER_SCHEMA = "block long, bucket int, bits binary"

LAST = 2**63 - 1  # a null doc_id comes last


def split(payload: bytes, sizes: list[int]) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(payload) if sum(sizes) else b""
    ends = np.cumsum(sizes).tolist()
    return [raw[e - s : e] for e, s in zip(ends, sizes, strict=True)]


def _laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release_held()
    base = TaskContext.get().partitionId() << 32
    held: list[tuple[int | None, bytes]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal base
        held.sort(key=lambda d: LAST if d[0] is None else d[0])
        raw = b"".join(d[1] for d in held)
        values = [
            [base],
            [len(held)],
            [len(raw)],
            [[d[0] for d in held]],
            [[len(d[1]) for d in held]],
            [[xxhash.xxh3_128_digest(d[1]) for d in held]],
            [zstandard.ZstdCompressor(level=3).compress(raw)],
        ]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary()]
        base += 1
        names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            if held and size + len(raw) > BLOCK_BYTES:
                yield flush()
                held, size = [], 0
            held.append((doc_id, raw))
            size += len(raw)
    if held:
        yield flush()


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def deal(h: np.ndarray, doc: np.ndarray | None, block: int, doc_ids: list[int | None], buckets: int, width: int) -> Iterator[tuple]:
    """Rows for the buckets; within one, entries keep their order."""
    bucket = bucket_of(h, buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
        own = order[ends[b] : ends[b + 1]]
        docs, counts = [], []
        if doc is not None:
            index, counts = np.unique(doc[own], return_counts=True)
            docs, counts = [LAST if doc_ids[i] is None else doc_ids[i] for i in index], counts.tolist()
        yield block, b, docs, counts, h[own].astype(f"<u{width}").tobytes()


def to_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    names = ["block", "bucket", "docs", "counts", "entries"]
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)


def _answers(sort_bucket: Callable[[list[dict]], np.ndarray]):
    """Run over rows sorted by bucket; yields a bit per entry of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(rows: list[dict]) -> pa.RecordBatch:
            found, at, out = sort_bucket(rows), 0, []
            for n in (len(r["entries"]) // sort_bucket.width for r in rows):
                out.append(np.packbits(found[at : at + n]).tobytes())
                at += n
            return pa.RecordBatch.from_arrays(
                [pa.array([r["block"] for r in rows], pa.int64()), pa.array([r["bucket"] for r in rows], pa.int32()), pa.array(out, pa.binary())],
                ["block", "bucket", "bits"],
            )

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    return run


def tied(rows: list[dict]) -> np.ndarray:
    """Entries that several blocks hold."""
    h = np.concatenate([np.frombuffer(r["entries"], "<u4") for r in rows])
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


tied.width = 4


def bits(answers: list[dict] | None, h: np.ndarray, buckets: int) -> np.ndarray:
    """The answers for the entries ``h`` that a block has sent, in its order."""
    out = np.zeros(len(h), bool)
    bucket = bucket_of(h, buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for a in answers or ():
        own = order[ends[a["bucket"]] : ends[a["bucket"] + 1]]
        out[own] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=len(own)).astype(bool)
    return out


def lay_out(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents as a bucketed table of blocks; texts are UTF-8 bytes, null is empty."""
    spark = docs.sparkSession
    bound_batches(spark, 4 << 20)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = f"blocks_{scratch.root.rpartition('-')[2]}"
    writer = source.mapInArrow(_laid, BLOCK_SCHEMA).write.bucketBy(partitions(spark), "block")
    writer.option("compression", "uncompressed").option("path", scratch.path("blocks")).saveAsTable(table)
    scratch.tables.append(table)
    return spark.table(table)


def answered(rows: DataFrame, sort_bucket: Callable[[list[dict]], np.ndarray], scratch: Scratch, name: str) -> DataFrame:
    """Sort every bucket; per block, column ``name`` holds the answers by bucket."""
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "block")
    bits_ = dealt.mapInArrow(_answers(sort_bucket), ANSWER_SCHEMA)
    return scratch.store(bits_.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name)), name)


def later_copies(blocks: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """(block, i, doc_id, first) of every text of ``least`` bytes or more that an earlier one equals.

    ``first`` is the struct (id, block, i) of the earliest, by doc_id.
    """
    each = blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", "sizes", "digests")).alias("i", "d")).select(
        "block", "i", F.col("d.digests").alias("digest"), F.coalesce("d.doc_ids", F.lit(LAST)).alias("id"), F.col("d.sizes").alias("size")
    )
    each = each.where(F.col("size") >= least)
    first = each.groupBy("digest", "size").agg(F.min(F.struct("id", "block", "i")).alias("first"), F.count("*").alias("n")).where("n > 1")
    # stored, so that the join shuffles two plain tables and Spark can split a hot text
    first = scratch.store(first, "first-copies")
    return each.join(first, ["digest", "size"]).where(F.struct("id", "block", "i") != F.col("first")).select("block", "i", "id", "size", "first")
