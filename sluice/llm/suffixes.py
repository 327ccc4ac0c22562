"""Removal of long repeated substrings by blockwise suffix sorting with a difference cover.

A suffix matters only up to ``LENGTH`` bytes: two suffixes tie when their first
``LENGTH`` bytes are equal, and of a tie all but the earliest are repeats. The
construction bounds memory to one bucket of suffixes at a time.

1. Texts are laid out once in blocks (blocks.py), so later passes join small
   answers to a block without moving text again.
2. Positions in a difference cover (mod 57) are the sample: for any two
   positions there is an offset below 57 that puts both into it. Sample strings
   of 44 bytes are dealt into buckets and sorted by a 32-bit part of their
   fingerprint; a bit tells which are met twice, no rank is kept. A suffix can
   only tie over 100 bytes if one of the sample strings in it does, so all
   others are settled.
3. The remaining suffixes are dealt into buckets by their key (a fingerprint of
   their first 100 bytes), each bucket is sorted by (key, document, place), and
   every suffix but the first of a tie is a repeat. The bytes themselves are not
   compared: 63 bits of the fingerprint can differ (its lowest is 0 before mixing),
   so one false tie is expected from about 4.3 * 10^9 distinct unsettled suffixes.

Equal strings within a block are sent once, so a passage that many documents
share costs an entry per block. Whole copies of a text are found beforehand by
their digest and take no part in 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import blocks
from sluice.llm.blocks import BUCKET_SCHEMA, answered, bits, deal, later_copies, lay_out, split, tied, to_batches
from sluice.llm.common import Scratch, free_name
from sluice.llm.hashing import power_tables

LENGTH = 100
PERIOD = 57
#: A perfect difference set mod 57 (fixed values): every non-zero difference occurs once.
COVER = (1, 6, 7, 9, 19, 38, 42, 49)
SAMPLE = LENGTH - PERIOD + 1
def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def prefix_sums(raw: bytes) -> np.ndarray:
    value, _, down = power_tables(len(raw))
    code = np.frombuffer(raw, np.uint8)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(value[code] * down[: len(raw)], out=out[1:])
    return out


def strings_at(sums: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the strings of ``length`` bytes that start at ``at``."""
    _, up, _ = power_tables(len(sums))
    return _mix((sums[at + length] - sums[at]) * up[at])


def cover_positions(n: int) -> np.ndarray:
    """Sample positions whose string lies within ``n`` bytes."""
    at = (np.arange(0, n, PERIOD)[:, None] + np.array(COVER)).ravel()
    return at[at + SAMPLE <= n]


def candidates(n: int, repeated: np.ndarray) -> np.ndarray:
    """Starts of the windows of an ``n``-byte text that hold a repeated sample string."""
    change = np.zeros(n + 2, np.int32)
    np.add.at(change, np.maximum(repeated - (LENGTH - SAMPLE), 0), 1)
    np.add.at(change, repeated + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: n - LENGTH + 1] > 0)


def covered_by(n: int, starts: np.ndarray) -> np.ndarray:
    """Bytes that the windows starting at ``starts`` cover."""
    change = np.zeros(n + 1, np.int32)
    change[starts] += 1
    change[starts + LENGTH] -= 1
    return np.cumsum(change[:n]) > 0


def _samples(raws: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """Fingerprints of all sample strings of a block's texts, and their number per text."""
    out = [strings_at(prefix_sums(r), cover_positions(len(r)), SAMPLE) if len(r) >= LENGTH else np.zeros(0, np.uint64) for r in raws]
    return np.concatenate(out), [len(x) for x in out]


def _sample_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h = np.unique(_samples(split(row["payload"], row["sizes"]))[0])
                yield from to_batches(deal(h, None, row["block"], row["doc_ids"], buckets, 4))

    return run


def _later_suffixes(rows: list[dict]) -> np.ndarray:
    """Suffixes that are not the first of their tie, by (document, block)."""
    h = np.concatenate([np.frombuffer(r["entries"], "<u8") for r in rows])
    doc = np.concatenate([np.repeat(np.array(r["docs"], np.int64), r["counts"]) for r in rows])
    order = np.lexsort((doc, h))  # rows come sorted by block, and the sort is stable
    out = np.zeros(len(h), bool)
    out[order[1:]] = h[order[1:]] == h[order[:-1]]
    return out


_later_suffixes.width = 8


def _candidates_of(raws: list[bytes], skipped: set[int], answers: list[dict] | None, buckets: int):
    """Per text, the starts of its unsettled suffixes; the keys of all; the text of each key."""
    h, numbers = _samples(raws)
    sent, place, count = np.unique(h, return_inverse=True, return_counts=True)
    again = (bits(answers, sent, buckets) | (count > 1))[place] if len(h) else np.zeros(0, bool)
    starts, keys, owner, at = [], [], [], 0
    for i, (raw, n) in enumerate(zip(raws, numbers, strict=True)):
        own, at = again[at : at + n], at + n
        found = np.zeros(0, np.int64)
        if i not in skipped and own.any():
            found = candidates(len(raw), cover_positions(len(raw))[own])
            keys.append(strings_at(prefix_sums(raw), found, LENGTH))
            owner.append(np.full(len(found), i, np.int32))
        starts.append(found)
    return starts, np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(owner or [np.zeros(0, np.int32)])


def _first_of_each(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of first occurrences, ascending; for every key its number among them."""
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    order = np.argsort(first)
    number = np.empty(len(first), np.int64)
    number[order] = np.arange(len(first))
    return first[order], number[inverse]


def _suffix_rows(sample_buckets: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raws = split(row["payload"], row["sizes"])
                _, keys, owner = _candidates_of(raws, set(row["copies"] or ()), row["samples"], sample_buckets)
                first, _ = _first_of_each(keys)
                yield from to_batches(deal(keys[first], owner[first], row["block"], row["doc_ids"], buckets, 8))

    return run


def _whole_characters(raw: bytes, gone: np.ndarray) -> np.ndarray:
    """Keep every character of which a byte stays."""
    lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    character = np.cumsum(lead) - 1
    return (np.bincount(character, ~gone) == 0)[character]


def _result_rows(sample_buckets: int, buckets: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(list(documents_of(row)), schema=_RESULT_TEXT if with_text else _RESULT)

    def documents_of(row: dict) -> Iterator[dict]:
        raws = split(row["payload"], row["sizes"])
        copies = set(row["copies"] or ())
        starts, keys, _ = _candidates_of(raws, copies, row["samples"], sample_buckets)
        first, number = _first_of_each(keys)
        later = bits(row["suffixes"], keys[first], buckets)[number]
        later[np.setdiff1d(np.arange(len(keys)), first, assume_unique=True)] = True
        at = 0
        for i, (doc_id, raw) in enumerate(zip(row["doc_ids"], raws, strict=True)):
            own = starts[i][later[at : at + len(starts[i])]]
            at += len(starts[i])
            gone = np.full(len(raw), i in copies) if i in copies or not len(own) else covered_by(len(raw), own)
            if with_text:
                gone = _whole_characters(raw, gone) if gone.any() else gone
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            kept = raw if not len(edges) else np.frombuffer(raw, np.uint8)[~gone].tobytes()
            out = {"doc_id": doc_id, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(edges) // 2}
            out |= {"kept_sha256": hashlib.sha256(kept).hexdigest(), "spans": edges.tolist()}
            yield out | {"kept": kept.decode(), "source_sha256": hashlib.sha256(raw).hexdigest()} if with_text else out

    return run


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    + [("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))]
)
_RESULT_TEXT = pa.schema([*_RESULT, ("kept", pa.string()), ("source_sha256", pa.string())])
_RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def remove_repeats(docs: DataFrame, with_text: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (starts and ends).

    Removed is each byte covered by a ``LENGTH``-byte string that also starts
    earlier (smaller ``doc_id``, or earlier in the same document). Null text is
    empty. A null ``doc_id`` comes after all others; of rows that repeat an id,
    one counts as the earlier. ``with_text`` adds the kept text, in which a
    character stays whole if any byte of it does, and the sha256 of the input text.
    """
    scratch = scratch or Scratch(docs.sparkSession, "suffixes")
    laid = lay_out(docs, scratch)
    total = laid.agg(F.sum("raw_bytes")).first()[0] or 0
    sample_buckets = 1 + total * len(COVER) // PERIOD // blocks.BUCKET_ENTRIES
    buckets = 1 + total // 3 // blocks.BUCKET_ENTRIES

    held = laid.select("block", "doc_ids", "sizes", "payload")
    samples = answered(held.mapInArrow(_sample_rows(sample_buckets), BUCKET_SCHEMA), tied, scratch, "samples")
    copies = scratch.store(later_copies(laid, LENGTH, scratch).groupBy("block").agg(F.collect_list("i").alias("copies")), "copies")
    known = held.join(copies, "block", "left").join(samples, "block", "left")
    suffixes = answered(known.mapInArrow(_suffix_rows(sample_buckets, buckets), BUCKET_SCHEMA), _later_suffixes, scratch, "suffixes")
    known = known.join(suffixes, "block", "left")
    ddl = _RESULT_DDL + (", kept string, source_sha256 string" if with_text else "")
    return known.mapInArrow(_result_rows(sample_buckets, buckets, with_text), ddl)


def cut_repeats(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with repeated passages cut from the texts, all columns, one row each; a text cut to nothing goes.

    An integer ``n_chars`` column follows the text. Of rows that repeat id and
    text one stays as it is cut first. Of ``scratch`` only the changed texts are kept.
    """
    scratch = scratch or Scratch(docs.sparkSession, "suffixes")
    names = {n: free_name(docs, n) for n in ("id", "sha", "kept", "own")}
    cut = remove_repeats(docs, with_text=True, scratch=scratch).where("n_removed > 0")
    cut = cut.groupBy(F.col("doc_id").alias(names["id"]), F.col("source_sha256").alias(names["sha"])).agg(
        F.max_by("kept", F.octet_length("kept")).alias(names["kept"])
    )
    cut = scratch.store(cut, "cut")
    scratch.keep_only("cut")
    id_, sha, kept, own = (F.col(n) for n in names.values())
    marked = docs.withColumn(names["own"], F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    joined = marked.join(cut, (own == sha) & F.col("doc_id").cast("long").eqNullSafe(id_), "left")
    text = F.coalesce(kept, F.col("text"))
    changed = {"text": text} | ({"n_chars": F.length(text).cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in docs.columns else {})
    return joined.where(kept.isNull() | (kept != "")).withColumns(changed).select(*docs.columns)
