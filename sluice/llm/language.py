"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit a binary classifier over hashed
character n-grams says on which side a text lies. Decoding adds up, per
language, the loss of each bit's vote against the codeword, weighted by how
well that bit's classifier does on that language, and takes the nearest one.

The classifiers come from n-gram counts over every training document. Only the
bits' reliabilities use a bounded sample (``RELIABILITY_ROWS`` training rows).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, release_held, trim

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Training rows on which the classifiers' reliabilities are measured.
RELIABILITY_ROWS = 20_000
#: Characters handled at once; a longer text goes in slices of this length.
SLICE = 1 << 19
#: Ambiguous when the runner-up has at least this share of the winner's score.
AMBIGUOUS_SHARE = 0.5
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text numbers ascending) of the n-grams of lower-cased words; a gap between words is one blank."""
    pieces = [(i, t[lo : lo + SLICE].lower()) for i, t in enumerate(texts) for lo in range(0, len(t), SLICE)]
    while pieces:
        taken, size = [], 0
        while pieces and (not taken or size + len(pieces[0][1]) <= SLICE):
            taken.append(pieces.pop(0))
            size += len(taken[-1][1])
        raw = "".join([f" {t} " for _, t in taken]).encode("utf-32-le", "surrogatepass")
        code = np.frombuffer(raw, "<u4").astype(np.uint64)
        number = np.repeat([i for i, _ in taken], [len(t) + 2 for _, t in taken])
        letter = _is_letter()[code]
        first = np.concatenate([[True], letter[:-1] | (number[1:] != number[:-1])])
        code = np.where(letter, code, np.uint64(32))[letter | first]
        number = number[letter | first]
        mixed = np.zeros(len(code), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            end = len(code) - n + 1
            if end <= 0:
                break
            mixed = mixed[:end] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(n)
            if n in ORDERS:
                same = number[:end] == number[n - 1 :]
                bucket = (mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
                yield bucket[same].astype(np.int64), number[:end][same]


def codewords(languages: int) -> np.ndarray:
    """One row of +1/-1 bits per language: all two-way splits for few languages, else a spread random code."""
    if languages <= 1:
        return np.ones((languages, 0), np.int8)
    if languages <= 6:
        columns = [(1, *rest) for rest in product((1, -1), repeat=languages - 1) if -1 in rest]
        return np.array(columns, np.int8).T
    draw, bits = np.random.default_rng(languages), 15 * int(np.ceil(np.log2(languages)))
    best, best_distance = None, -1
    for _ in range(50):
        code = draw.choice(np.array([1, -1], np.int8), (languages, bits))
        code[0, np.abs(code.sum(axis=0)) == languages] *= -1
        distances = (bits - code.astype(int) @ code.T.astype(int)) // 2 + bits * np.eye(languages, dtype=int)
        if distances.min() > best_distance:
            best, best_distance = code, distances.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # bucket x bit: log odds of the bit's two sides
    reliability: np.ndarray  # language x bit, each row sums to 1

    def margins(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.code.shape[1]))
        for bucket, number in ngrams(texts):
            if len(bucket):
                starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
                np.add.at(out, number[starts], np.add.reduceat(self.weights[bucket], starts, axis=0))
        return out / len(ORDERS)  # the orders overlap

    def shares(self, margins: np.ndarray) -> np.ndarray:
        """Per text, each language's share of belief; rows sum to 1."""
        loss = np.zeros((len(margins), len(self.languages)))
        for i, (word, weight) in enumerate(zip(self.code, self.reliability, strict=True)):
            loss[:, i] = (np.logaddexp(0, -word * margins) * weight).sum(axis=1)
        loss = (loss - loss.min(axis=1, keepdims=True)) * max(1, self.code.shape[1])
        share = np.exp(-np.minimum(loss, 700))
        return share / share.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score from 0 to 1, whether ambiguous."""
        letters = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
        if not len(texts) or not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        share = self.shares(self.margins([t or "" for t in texts]))
        best = share.argmax(axis=1)
        score = share[np.arange(len(texts)), best]
        share[np.arange(len(texts)), best] = 0
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, score, 0.0), ~letters | (share.max(axis=1) >= AMBIGUOUS_SHARE * score)


def held_out(doc_id: Column) -> Column:
    """A null id is on neither side: not held out, not learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _labelled(docs: DataFrame) -> DataFrame:
    side = held_out(F.col("doc_id"))
    kept = ~side & F.col("lang").isNotNull() & F.col("text").isNotNull()
    return docs.where(kept).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame) -> Model:
    """Learn from the documents that are not held out and have text and lang."""
    spark = docs.sparkSession
    bound_batches(spark, 4 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_held()
        names: dict[str, int] = {}
        totals = np.zeros((0, BUCKETS), np.int64)
        texts = np.zeros(0, np.int64)
        for batch in batches:
            own = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()], np.int64)
            grown = np.zeros((len(names), BUCKETS), np.int64)
            grown[: len(totals)] = totals
            totals, texts = grown, np.bincount(own, minlength=len(names)) + np.pad(texts, (0, len(names) - len(texts)))
            for bucket, number in ngrams(batch.column(1).to_pylist()):
                totals += np.bincount(own[number] * BUCKETS + bucket, minlength=totals.size).reshape(totals.shape)
        for name, i in names.items():
            seen = np.flatnonzero(totals[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(seen) + 1), pa.string()), pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(totals[i][seen], texts[i]), pa.int64())],
                ["lang", "bucket", "n"],
            )
        trim()

    counted = _labelled(docs).mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    code = codewords(len(languages))
    if not languages:
        return Model([], code, np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)))
    counts = np.zeros((len(languages), BUCKETS))
    grams = counted[counted["bucket"] >= 0]
    counts[np.searchsorted(languages, grams["lang"]), grams["bucket"]] = grams["n"]
    rows = int(counted.loc[counted["bucket"] < 0, "n"].sum())
    usage = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)  # each language weighs the same
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        side = code[:, bit] > 0
        weights[:, bit] = np.log(usage[side].mean(axis=0)) - np.log(usage[~side].mean(axis=0))
    model = Model(languages, code, weights, np.full(code.shape, 1 / max(1, code.shape[1])))
    if code.shape[1]:
        model.reliability = _reliability(docs, model, rows)
    return model


def _reliability(docs: DataFrame, model: Model, rows: int) -> np.ndarray:
    """Share of each language's training texts whose bit is right, on a bounded sample, as weights."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    parts = 1_000_000
    threshold = parts if rows <= RELIABILITY_ROWS else max(1, parts * RELIABILITY_ROWS // rows)
    drawn = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < threshold)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_held()
        own = shared.value
        place = {x: i for i, x in enumerate(own.languages)}
        right, seen = np.zeros(own.code.shape), np.zeros(len(place))
        for batch in batches:
            labels = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            votes = own.margins(batch.column(1).to_pylist()) * own.code[labels] > 0
            np.add.at(right, labels, votes)
            np.add.at(seen, labels, 1)
        index = np.indices(right.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(index[0], pa.int32()), pa.array(index[1], pa.int32()), pa.array(right.ravel()), pa.array(np.repeat(seen, right.shape[1]))],
            ["language", "bit", "good", "seen"],
        )

    sums = _labelled(drawn).mapInArrow(judge, "language int, bit int, good double, seen double").groupBy("language", "bit").agg(F.sum("good").alias("good"), F.sum("seen").alias("seen")).collect()
    share = np.full(model.code.shape, 0.5)
    for r in sums:
        share[r.language, r.bit] = (r.good + 1) / (r.seen + 2)
    return share / share.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Predict every whole text: doc_id, held_out, lang_pred, score, ambiguous.

    ``lang_pred`` is ``und`` with score 0 for a null text, one without a letter,
    or when nothing was learned. Repeated rows give a row each.
    """
    spark = docs.sparkSession
    bound_batches(spark, 4 << 20)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_held()
        for batch in batches:
            names, score, ambiguous = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )
        trim()

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return source.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def with_language(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """All rows and columns of ``docs`` with a struct ``name`` of ``language`` and ``score`` of their texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<language string, score double>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        release_held()
        names, score, _ = shared.value.predict([t if isinstance(t, str) else None for t in texts])
        trim()
        return pd.DataFrame({"language": names, "score": score})

    bound_batches(docs.sparkSession, 4 << 20)
    return docs.withColumn(name, judge(F.col("text").cast("string")))


def with_letters(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter, by the rule that ``predict`` uses."""

    @F.pandas_udf("boolean")
    def lettered(texts: pd.Series) -> pd.Series:
        release_held()
        return pd.Series([isinstance(t, str) and any(map(str.isalpha, t)) for t in texts], dtype=bool)

    bound_batches(docs.sparkSession, 4 << 20)
    return docs.where(lettered(F.col("text").cast("string")))


def identify_languages(docs: DataFrame) -> DataFrame:
    """Fit on the training side of ``docs`` and predict all of them."""
    return identify(docs, fit(docs))
