"""Document fingerprints from prefix polynomial hashes.

For a text c_0 c_1 ... the arrays P[i] = sum of c_j * B^j over j < i, modulo two
primes, give the hash of any span in constant time, so spans compare without
their texts and a binary search finds how far two texts agree from any places.
A fingerprint holds the length, the hash of the whole and the least hashes of
all spans of ``WIDTH`` characters (a bottom-k sketch); the likeness of two
fingerprints estimates the share of spans that their texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, partitions

WIDTH = 10
KEPT = 64
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 911382323)

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_table(first: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = first
    while len(out) < n:  # doubling: powers n..2n-1 are powers 0..n-1 times B^n
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(prime)])
        step = step * step % prime
    return out


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, at least n of them."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, 1 << 14)
        _powers[:] = [(_power_table(b, size, p), _power_table(pow(b, -1, p), size, p)) for b, p in zip(BASES, PRIMES, strict=True)]
    return _powers


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)


class PrefixHashes:
    """Prefix arrays of one text, by code points."""

    def __init__(self, text: str, prefix: PrefixHashes | None = None, kept: int = 0):
        """The hashes of ``text``, or of the first ``kept`` characters behind ``prefix`` with ``text`` after them."""
        code = _codes(text)
        self.length = kept + len(code)
        self.sums = []
        for k, ((up, _), prime) in enumerate(zip(_tables(self.length + 1), PRIMES, strict=True)):
            begun = prefix.sums[k][: kept + 1] if prefix else np.zeros(1, np.uint64)
            terms = code * up[kept : self.length] % np.uint64(prime)
            more = (np.cumsum(terms, dtype=np.uint64) + begun[-1]) % np.uint64(prime)
            self.sums.append(np.concatenate([begun, more]))

    def windows(self, begin: int = 0) -> np.ndarray:
        """Hashes of the spans of ``WIDTH`` characters that start at ``begin`` or later."""
        out, end = np.zeros(self.length - WIDTH + 1 - begin, np.uint64), self.length - WIDTH + 1
        for sums, (_, down), prime in zip(self.sums, _tables(self.length + 1), PRIMES, strict=True):
            apart = sums[begin + WIDTH :] + np.uint64(prime) - sums[begin:end]  # below 2^32, so the product fits
            out = out << np.uint64(31) | apart * down[begin:end] % np.uint64(prime)
        return out

    def span(self, start: int, end: int) -> int:
        """Hash of the span [start, end); equal for equal spans of any texts."""
        out = 0
        for sums, (_, down), prime in zip(self.sums, _tables(self.length + 1), PRIMES, strict=True):
            out = out << 31 | (int(sums[end]) - int(sums[start])) % prime * int(down[start]) % prime
        return out

    def equal(self, start: int, other: PrefixHashes, at: int, length: int) -> bool:
        return self.span(start, start + length) == other.span(at, at + length)

    def extension(self, start: int, other: PrefixHashes, at: int) -> int:
        """Length of the longest common extension from ``start`` here and ``at`` there."""
        low, high = 0, min(self.length - start, other.length - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def values(hashes: PrefixHashes, begin: int = 0) -> np.ndarray:
    """32-bit values of the text's spans from ``begin``; a shorter text is one span."""
    if hashes.length >= WIDTH:
        raw = hashes.windows(begin)
    else:
        raw = np.array([hashes.span(0, hashes.length)] if hashes.length else [], np.uint64)
    return _mix(raw) >> np.uint64(32)


def sketch(value: np.ndarray) -> list[int]:
    """The least ``KEPT`` distinct values, ascending."""
    few = 4 * KEPT
    if len(value) > few:
        least = np.unique(np.partition(value, few)[:few])
        if len(least) >= KEPT:
            return least[:KEPT].tolist()
    return np.unique(value)[:KEPT].tolist()


def likeness(a: list[int], b: list[int]) -> float:
    """Estimated Jaccard similarity of two span sets; two empty texts are alike."""
    x, y = set(a), set(b)
    least = sorted(x | y)[:KEPT]
    return sum(v in x and v in y for v in least) / len(least) if least else 1.0


def written(hashes: PrefixHashes, least: list[int]) -> str:
    return f"{hashes.length:x}.{hashes.span(0, hashes.length):016x}." + "".join([f"{x:08x}" for x in least])


class _Document:
    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.hashes = PrefixHashes(text)
        self.values = values(self.hashes)
        self.least = sketch(self.values)

    def row(self, following: _Document) -> dict:
        n = len(self.text)
        cut = n // 3
        end = following.text[:cut]
        # prefix sums and spans of what stays are those of the text
        hashes = PrefixHashes(end, self.hashes, n - cut)
        shared = max(0, n - cut - WIDTH + 1) if hashes.length >= WIDTH else 0
        least = sketch(np.concatenate([self.values[:shared], values(hashes, shared)]))
        edited = self.text[: n - cut] + end
        return {
            "doc_id": self.doc_id,
            "n_chars": n,
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": written(self.hashes, self.least),
            "edited_fingerprint": written(hashes, least),
            "near_edited": likeness(self.least, least),
            "near_next": likeness(self.least, following.least),
            "same_prefix": self.hashes.extension(0, hashes, 0),
        }


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("same_prefix", pa.int64())]
)
_RESULT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, same_prefix long"
)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, its own documents in order, then guests, the first of which follows the last."""
    bucket, first, last = None, None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                if last:
                    out.append(last.row(first))
                bucket, first, last = row["bucket"], None, None
            if row["guest"]:
                if last:
                    out.append(last.row(_Document(row["doc_id"], row["text"])))
                last = None
                continue
            document = _Document(row["doc_id"], row["text"])
            if last:
                out.append(last.row(document))
            first, last = first or document, document
        yield pa.RecordBatch.from_pylist(out, schema=_RESULT)
    if last:
        yield pa.RecordBatch.from_pylist([last.row(first)], schema=_RESULT)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint every whole text and its edited text.

    The edited text has its last third (rounded down) replaced by the first as
    many code points of the next document, in descending ``doc_id``; after the
    last comes the first. Null text is empty. Rows that repeat an id follow one
    another by a hash of their text; null ids come last. ``same_prefix`` is how
    far the text and its edited text agree. An empty table gives no rows.

    Documents are dealt into ranges of ids, cut at ids of the table (as many as
    partitions need), and the first of a range also goes to the range before it
    as a guest, so one shuffle brings every document and the next one together.
    """
    spark = docs.sparkSession
    bound_batches(spark, 4 << 20)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = 8 * partitions(spark)
    found = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("cuts"), F.max("doc_id").alias("largest")).first()
    cuts, largest = np.array(sorted(set(found["cuts"] or ())), np.int64), found["largest"]

    @F.pandas_udf("array<struct<bucket int, guest boolean>>")
    def places(ids: pd.Series, absent: pd.Series) -> pd.Series:
        out = []
        for i, none in zip(ids, absent, strict=True):
            above = len(cuts) - int(np.searchsorted(cuts, i)) if not none else len(cuts)
            own = [{"bucket": above, "guest": False}]
            if not none and above and cuts[len(cuts) - above] == i:
                own.append({"bucket": above - 1, "guest": True})
            if not none and i == largest:
                own.append({"bucket": len(cuts), "guest": True})
            out.append(own)
        return pd.Series(out)

    known = places(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull())
    dealt = docs.withColumn("place", F.explode(known)).select("place.bucket", "place.guest", "doc_id", "text")
    ordered = dealt.repartition(partitions(spark), "bucket").sortWithinPartitions(
        "bucket", "guest", F.desc_nulls_last("doc_id"), F.xxhash64("text")
    )
    return ordered.mapInArrow(_follow, _RESULT_DDL)
