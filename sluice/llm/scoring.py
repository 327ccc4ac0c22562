"""Scores of whole documents under a unigram base and a log-bilinear model.

Both count and train on every training document. Words are counted task by task
before they are shuffled. The commonest words (``HOT_WORDS`` at most, so the
broadcast has a bound) get their counts inside the tasks; the words beyond them
are joined with the stored table of all counts, so no count is left out. The
texts become class ids once, in a stored table that the training rounds and the
scoring read.

In a training round each task trains on from the shared parameters with its own
documents of that round, and the parameters of all tasks are averaged by
tokens. All rounds together read each training token once.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bilinear
from sluice.llm.bilinear import END, RARE, Parameters, Scorer
from sluice.llm.common import Scratch, bound_batches, held_by_worker
from sluice.llm.frequent import commonest
from sluice.llm.partials import gathered, partial_results

#: Words whose counts every task holds, classes of the model, width of its vectors, training rounds.
HOT_WORDS = 1 << 18
CLASSES = 2048
WIDTH = 24
ROUNDS = 4
#: A longer word is known by its digest, which bounds the rows that are shuffled.
LONGEST_WORD = 64
#: Words a task counts before it hands them on, bytes of text split at once, tokens trained on or scored at once.
COUNTED_AT_ONCE = 200_000
SLICE = 4 << 20
TOKENS_AT_ONCE = 1 << 20
#: Pieces in which a task's parameters are shuffled.
PIECES = 16
#: The end of a text as a word; no word is empty.
END_WORD = b""
ENCODED = (
    "row long, doc_id long, held_out boolean, round int, n_tokens long, known long, base double, rare double, "
    "ids binary, cold array<struct<word: binary, n: long>>"
)
SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, cold array<struct<word: binary, n: long>>"

_next_space = re.compile(rb"[ \t-\r]").search


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """The A-Z lower-cased words between ASCII white space, in lists of a bounded size."""
    at = 0
    while len(raw) - at > SLICE and (cut := _next_space(raw, at + SLICE)):
        yield raw[at : cut.start()].lower().split()
        at = cut.start()
    yield raw[at:].lower().split()


def known_by(word: bytes) -> bytes:
    """The word, or of a long one a blank (which no word holds) and its SHA-256."""
    return word if len(word) <= LONGEST_WORD else b" " + hashlib.sha256(word).digest()


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text"):
        yield text.as_py() or b""


@dataclass(frozen=True)
class Totals:
    """Training tokens, distinct training tokens, and the denominator of every base probability."""

    tokens: int
    distinct: int

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


@dataclass(frozen=True)
class Vocabulary:
    """Words every task holds, commonest first, with their counts; the first ``classes`` - 2 words have a class."""

    words: list[bytes]
    counts: np.ndarray
    classes: int
    totals: Totals

    def class_of(self) -> np.ndarray:
        ids = np.full(len(self.words), RARE, np.int64)
        plain = [i for i, w in enumerate(self.words) if w != END_WORD]
        for number, i in enumerate(plain[: self.classes - 2], start=2):
            ids[i] = number
        if len(plain) < len(self.words):
            ids[self.words.index(END_WORD)] = END
        return ids

    def frequency(self) -> np.ndarray:
        """Base probability of each class; ``RARE`` has that of all other words, known or not."""
        if not self.totals.tokens:
            return np.array([1.0, 1e-12])  # nothing is known, not even an end
        ids, out = self.class_of(), np.full(self.classes, 0.5 / self.totals.mass)
        out[ids[ids != RARE]] = (self.counts[ids != RARE] + 0.5) / self.totals.mass
        out[RARE] = max(1.0 - out[1:].sum(), 0.5 / self.totals.mass)
        return out / out.sum()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column ``text`` (binary); each row also counts one ``END_WORD``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def handed_on() -> Iterator[pa.RecordBatch]:
            short: Counter[bytes] = Counter()
            for word, n in found.items():
                short[known_by(word)] += n
            words, counts = list(short), list(short.values())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], ["word", "n"])
            found.clear()

        for batch in batches:
            for raw in _texts(batch):
                for words in words_of(raw):
                    found.update(words)
                    if len(found) > COUNTED_AT_ONCE:
                        yield from handed_on()
                found[END_WORD] += 1
        if found:
            yield from handed_on()

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, hot_words: int = HOT_WORDS, classes: int = CLASSES) -> Vocabulary:
    """Totals of a stored table (word, n) and its commonest words.

    ``hot_words`` words at most, and the end, reach the driver.
    """
    is_hot, histogram = commonest(counts, hot_words)
    totals = Totals(sum(r["total"] for r in histogram), sum(r["entries"] for r in histogram))
    hot = counts.where(is_hot | (F.col("word") == F.lit(END_WORD))).toPandas()
    ranked = sorted(zip(map(bytes, hot["word"]), hot["n"], strict=True), key=lambda p: (-p[1], p[0]))
    words, numbers = [w for w, _ in ranked], np.array([n for _, n in ranked], np.int64)
    return Vocabulary(words, numbers, 2 + min(classes - 2, sum(w != END_WORD for w in words)), totals)


class Encoder:
    def __init__(self, words: Vocabulary):
        self.place = dict(zip(words.words, range(len(words.words)), strict=True))
        self.classes = np.append(words.class_of(), RARE).astype(np.uint16)
        self.logs = np.append(np.log10(words.counts + 0.5), 0.0)

    def encode(self, raw: bytes) -> tuple[bytes, int, float, float, Counter[bytes]]:
        """Class ids; words with a count here; sums of log10(count + 0.5), of all of them and of the rare ones; the other words."""
        ids, known, base, rare, cold = [], 0, 0.0, 0.0, Counter()
        for words in (*words_of(raw), [END_WORD]):
            at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
            classes, logs = self.classes[at], self.logs[at]
            ids.append(classes.tobytes())
            found = at >= 0
            known += int(found.sum())
            base += float(logs.sum())
            rare += float(logs[classes == RARE].sum())
            if not found.all():
                for i in np.flatnonzero(~found):
                    cold[known_by(words[i])] += 1
        return b"".join(ids), known, base, rare, cold


def encode(rows: DataFrame, words: Vocabulary) -> DataFrame:
    """Class ids and partial sums of each row (row, doc_id, held_out, round, text)."""
    shared = rows.sparkSession.sparkContext.broadcast((words, f"encoder-{uuid.uuid4().hex}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, key = shared.value
        encoder = held_by_worker(key, lambda: Encoder(words))
        for batch in batches:
            found = [encoder.encode(raw) for raw in _texts(batch)]
            n = [len(f[0]) // 2 for f in found]
            cold = pa.array([[{"word": w, "n": c} for w, c in f[4].items()] for f in found], pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))
            columns = [batch.column(c) for c in ("row", "doc_id", "held_out", "round")]
            columns += [pa.array(n, pa.int64()), *(pa.array([f[i] for f in found], t) for i, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()), (0, pa.binary()))), cold]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "round", "n_tokens", "known", "base", "rare", "ids", "cold"])

    return rows.mapInArrow(run, ENCODED)


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, lengths) of whole texts, about ``TOKENS_AT_ONCE`` tokens together."""
    held, waiting = [], 0
    for batch in batches:
        for ids in batch.column("ids"):
            held.append(np.frombuffer(ids.as_py(), np.uint16))
            waiting += len(held[-1])
            if waiting >= TOKENS_AT_ONCE:
                yield np.concatenate(held).astype(np.int64), np.array([len(h) for h in held])
                held, waiting = [], 0
    if held:
        yield np.concatenate(held).astype(np.int64), np.array([len(h) for h in held])


def _average(payloads: list[bytes]) -> bytes:
    """[tokens, mean of parameters] of several such arrays, weighed by tokens."""
    arrays = [np.frombuffer(p, np.float64) for p in payloads]
    tokens = sum(a[0] for a in arrays)
    return np.concatenate([[tokens], sum(a[1:] * (a[0] / tokens) for a in arrays)]).tobytes()


def train_round(texts: DataFrame, model: Parameters, frequency: np.ndarray, round_: int) -> Parameters:
    """Mean of the parameters that all tasks reach with their own texts (column ``ids``)."""
    shared = texts.sparkSession.sparkContext.broadcast((model, frequency))

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterable[tuple[int, bytes]]:
        start, frequency = shared.value
        own = Parameters(start.classes, start.width, start.flat.copy())
        tokens, seed = 0, (round_ << 32) + TaskContext.get().partitionId()
        for number, (ids, lengths) in enumerate(_token_batches(batches)):
            bilinear.train(own, ids, lengths, frequency, seed + (number << 40))
            tokens += len(ids)
        if tokens:
            for key, piece in enumerate(np.array_split(own.flat.astype(np.float64), PIECES)):
                yield key, np.concatenate([[float(tokens)], piece]).tobytes()

    found = gathered(partial_results(texts.select("ids"), of_task), _average)
    if not found:
        return model
    flat = np.concatenate([np.frombuffer(found[key], np.float64)[1:] for key in range(PIECES)])
    return Parameters(model.classes, model.width, flat.astype(np.float32))


def train_model(encoded: DataFrame, words: Vocabulary, width: int = WIDTH, rounds: int = ROUNDS) -> Parameters:
    """The model after one pass over the training texts of an encoded table."""
    frequency = words.frequency()
    model = Parameters.start(frequency, width)
    for round_ in range(rounds):
        model = train_round(encoded.where(~F.col("held_out") & (F.col("round") == round_)), model, frequency, round_)
    return model


def score(encoded: DataFrame, model: Parameters, words: Vocabulary) -> DataFrame:
    """Sums of log10 probabilities of each text, but for the counts of its cold words."""
    shared = encoded.sparkSession.sparkContext.broadcast((model, f"scorer-{uuid.uuid4().hex}"))
    totals = words.totals
    rare = float(np.log10(words.frequency()[RARE] * totals.mass))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, key = shared.value
        scorer = held_by_worker(key, lambda: Scorer(model))
        for batch in batches:
            sums, rares = [], []
            for ids, lengths in _token_batches(iter([batch])):
                starts = np.cumsum(lengths) - lengths
                sums.append(np.add.reduceat(scorer.log_probabilities(ids, lengths).astype(np.float64), starts))
                rares.append(np.add.reduceat((ids == RARE).astype(np.int64), starts))
            classes, n_rare = (np.concatenate(x) if x else np.zeros(0) for x in (sums, rares))
            own = classes / np.log(10) + batch.column("rare").to_numpy(zero_copy_only=False) - n_rare * rare
            base = batch.column("base").to_numpy(zero_copy_only=False) - batch.column("n_tokens").to_numpy(zero_copy_only=False) * np.log10(totals.mass)
            columns = {c: batch.column(c) for c in ("row", "doc_id", "held_out", "n_tokens", "known")}
            columns |= {"base": pa.array(base), "score": pa.array(own), "cold": batch.column("cold")}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return encoded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "rare", "ids", "cold").mapInArrow(run, SCORED)


def score_documents(
    docs: DataFrame,
    held_out: Column,
    hot_words: int = HOT_WORDS,
    classes: int = CLASSES,
    width: int = WIDTH,
    rounds: int = ROUNDS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are a text's A-Z lower-cased words between ASCII white space and one
    end. ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1))). ``score`` is the
    log-bilinear model's log10 probability: a normalised distribution over
    classes, and within the class of rare words the base's shares. A null text is
    empty (its end alone); repeated rows and ids count and are scored each; a
    null ``held_out`` (null id) is training. Without training documents both
    scores are 0 for the one token type there is, unknown. Without rows there are
    none. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    scratch = scratch or Scratch(spark, "scoring")
    bound_batches(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(rounds)).cast("int").alias("round"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    counts = scratch.store(word_counts(rows.where("NOT held_out")), "counts")
    words = vocabulary(counts, hot_words, classes)
    encoded = scratch.store(encode(rows, words), "encoded")
    model = train_model(encoded, words, width, rounds)
    scored = scratch.store(score(encoded, model, words), "scored")

    cold = scored.select("row", F.explode("cold").alias("c")).select("row", "c.word", F.col("c.n").alias("times"))
    found = cold.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("met"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.drop("cold").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(words.totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )


def held_out_fifth(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id as text leaves 1 modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1
