"""Near-duplicate join on word shingles by parity sketches.

A document's set of shingles is dealt over the pieces of a sketch and XOR-ed
together piece by piece, so a shingle that two sets share cancels out and each
one they do not share changes one piece: the number of differing pieces is at
most the symmetric difference. Sets of similar size (a size band) whose Jaccard
similarity reaches the threshold differ in at most D shingles, so of D + 1 + E
pieces at least E + 1 agree. Documents are joined on (band, piece, value).

Documents with equal sets are one class from the start. A key that several
classes share is only a hint: most such classes share a passage and no more. So
nothing is closed before it is verified. Candidates meet as (size, bit sketch),
one parity bit per shingle, whose Hamming distance is a lower bound as well; the
texts of a pair meet only when that bound lets it pass. In three rounds the
verified links grow into components, and only keys that still hold several
components stay open:

1. each class with the nearest first holder of one of its keys,
2. the first holders that are left, and in each open key of three holders or
   more a spanning forest of what the bit sketches let pass,
3. in the keys that gave such a forest and are still open, all pairs between
   components that the bit sketches let pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, bound_batches, free_name, release_held
from sluice.llm.components import components
from sluice.llm.hashing import mix, word_hashes

#: Holders of one key that a task compares at once; a key with more goes out as pairs of such chunks.
CHUNK = 4096
#: Least bits of a sketch, and bits for each shingle by which two linked sets may differ.
SKETCH_BITS = 1024
BITS_PER_CHANGE = 8


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles: A-Z lower-cased words between ASCII white space.

    Fewer words than ``size`` form one shingle; none form an empty set.
    """
    h = word_hashes((text or "").encode())
    if not len(h):
        return h
    n = min(size, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + mix(h[i : len(h) - n + 1 + i])
    return np.unique(mix(out + np.uint64(n)))


def most_apart(total: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets whose sizes add up to ``total``."""
    return total * (100 - percent) // (100 + percent)


def band_of(n: int, percent: int) -> tuple[int, int, int]:
    """(first size of the band, pieces, spare pieces E) for a set size."""
    low = 1
    while (high := max(low + 1, low * 3 // 2)) <= n:
        low = high
    apart = most_apart(2 * (high - 1), percent)
    empty = (apart + 1) * math.exp(-low / (apart + 1))
    spare = 1 + math.ceil(empty + 4 * math.sqrt(empty))
    return low, apart + 1 + spare if apart else 0, spare


_bands: dict[tuple[int, int], list[tuple[int, int, int]]] = {}


def _bands_of(n: int, percent: int) -> list[tuple[int, int, int]]:
    """The set's own band, and the next one where a linked set may lie in it."""
    key = (n, percent)
    if key not in _bands:
        own, most = band_of(n, percent), band_of(n * 100 // percent, percent)
        _bands[key] = [own] if own == most else [own, most]
    return _bands[key]


def sketch_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """One join key per (band, piece, value); an empty piece counts only for sets with more of them than E."""
    out = [np.zeros(0, np.uint64)]
    place = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)
    for low, pieces, spare in _bands_of(len(hashes), percent) if len(hashes) else ():
        if not pieces:
            continue  # only equal sets are near enough
        piece = (place * np.uint64(pieces)) >> np.uint64(32)
        order = np.argsort(piece)
        at = piece[order]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        value, index = np.bitwise_xor.reduceat(hashes[order], starts), at[starts]
        if pieces - len(index) > spare:
            full = np.zeros(pieces, np.uint64)
            full[index.astype(np.int64)] = value
            value, index = full, np.arange(pieces, dtype=np.uint64)
        out.append(mix(value ^ mix(index * np.uint64(0x9E3779B97F4A7C15) + np.uint64(low))))
    return np.concatenate(out)


def sketch_bits(n: int, percent: int) -> int:
    """Bits of the sketch of a set of ``n``: a power of two, so that a longer sketch folds to a shorter one."""
    return max(SKETCH_BITS, 1 << (BITS_PER_CHANGE * most_apart(2 * n, percent) - 1).bit_length())


def bit_sketch(hashes: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bits, one toggled per shingle: their Hamming distance is at most the symmetric difference."""
    bit = mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)) & np.uint64(bits - 1)
    odd = (np.bincount(bit.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The same sketch (or rows of sketches) with fewer bits."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def pass_bound(na: int, a: np.ndarray, nb: int, b: np.ndarray, percent: int) -> int | None:
    """Distance of two sketches where sizes and sketches allow a link."""
    if 100 * min(na, nb) < percent * max(na, nb):
        return None
    words = min(len(a), len(b))
    apart = int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum())
    return apart if apart <= most_apart(na + nb, percent) else None


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted sets."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(long, short)
    common = int((long[np.minimum(at, len(long) - 1)] == short).sum())
    return common * (100 + percent) >= percent * (len(a) + len(b))


def candidates(n: np.ndarray, sketches: list[np.ndarray], group: np.ndarray, side: np.ndarray, percent: int, spanning: bool) -> Iterator[tuple[int, int]]:
    """Pairs of different groups that sizes and sketches let pass.

    With ``spanning`` only pairs that join groups not joined yet. With two sides,
    only pairs between them.
    """
    order = np.argsort(n, kind="stable")
    n, side, group = n[order], side[order], group[order].copy()
    words = np.array([len(sketches[i]) for i in order])
    # per sketch length, the members of that length or more, folded to it
    tables = {w: np.stack([folded(sketches[i], w) if len(sketches[i]) >= w else np.zeros(w, np.uint64) for i in order]) for w in np.unique(words).tolist()}
    two = side.any() and not side.all()
    for i in range(len(n) - 1):
        rest = np.arange(i + 1, np.searchsorted(n, n[i] * 100 // percent, side="right"))
        rest = rest[group[rest] != group[i]]
        if two:
            rest = rest[side[rest] != side[i]]
        if not len(rest):
            continue
        table = tables[int(words[i])]
        apart = np.bitwise_count(table[rest] ^ table[i]).sum(axis=1, dtype=np.int64)
        near = apart <= (n[rest] + n[i]) * (100 - percent) // (100 + percent)
        for j in rest[near][np.argsort(apart[near], kind="stable")].tolist():
            if spanning and group[j] == group[i]:
                continue
            if spanning:
                group[group == group[j]] = group[i]
            yield int(order[i]), int(order[j])


def _classes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, class (digest of the set), bit sketch, keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_held()
        for batch in batches:
            sets = [shingles(t.as_py(), size) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([bit_sketch(s, sketch_bits(len(s), percent)).tobytes() for s in sets], pa.binary()),
                    pa.array([sketch_keys(s, percent).view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "class", "sketch", "keys"],
            )

    bound_batches(docs.sparkSession, 4 << 20)
    return docs.mapInArrow(run, "doc_id long, n_shingles long, class binary, sketch binary, keys array<long>")


def _words(sketch: pa.Scalar) -> np.ndarray:
    return np.frombuffer(sketch.as_py(), np.uint64)


def _pair_batch(*columns: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "apart"][: len(columns)])


def _within_bound(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, apart) of the pairs (a, b) that sizes and bit sketches let pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_pylist() for i in range(4))
            apart = [pass_bound(x, _words(s), y, _words(t), percent) for x, s, y, t in zip(na, batch.column(4), nb, batch.column(5), strict=True)]
            yield _pair_batch(*([v for v, d in zip(c, apart, strict=True) if d is not None] for c in (a, b, apart)))

    one, other = (nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    sized = pairs.join(one.drop("sa"), "a").join(other.drop("sb"), "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    met = sized.select("a", "b").distinct().join(one, "a").join(other, "b").select("a", "b", "na", "nb", "sa", "sb")
    return met.mapInArrow(run, "a long, b long, apart long")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            links = []
            for x, s, t in zip(a, batch.column(2), batch.column(3), strict=True):
                text = (x, s.as_py())
                if text != last:
                    last, kept = text, shingles(text[1], size)
                links.append(linked(kept, shingles(t.as_py(), size), percent))
            yield _pair_batch(*([v for v, link in zip(c, links, strict=True) if link] for c in (a, b)))

    one, other = (docs.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
    return pairs.select("a", "b").join(other, "b").join(one, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def _open_pairs(
    members: DataFrame, nodes: DataFrame, component: DataFrame, percent: int, spanning: bool, scratch: Scratch, name: str
) -> DataFrame:
    """(key, a, b): pairs in keys of three holders or more in several components, as ``candidates`` finds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(key: int, rows: list[tuple]) -> pa.RecordBatch:
            n, group = (np.array([r[i] for r in rows], np.int64) for i in (2, 3))
            side = np.array([r[1] for r in rows], bool)
            found = [(rows[i][0], rows[j][0]) for i, j in candidates(n, [r[4] for r in rows], group, side, percent, spanning)]
            columns = [key] * len(found), [min(p) for p in found], [max(p) for p in found]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "a", "b"])

        at, held = None, []
        for batch in batches:
            where = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            rows = zip(*(batch.column(i).to_pylist() for i in range(3, 7)), map(_words, batch.column(7)), strict=True)
            for place, row in zip(where, rows, strict=True):
                if place != at:
                    if len(held) > 1:
                        yield pairs(at[0], held)
                    at, held = place, []
                held.append(row)
        if len(held) > 1:
            yield pairs(at[0], held)

    labelled = members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    one, other = F.xxhash64("node"), F.xxhash64(F.lit(1), "node")
    groups = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"),
        F.bit_xor(one).alias("x"), F.bit_xor(other).alias("y"),
    )
    # keys with the same holders are one
    groups = groups.where("low < high AND n > 2").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    groups = scratch.store(groups.select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), f"{name}-open")
    held = labelled.join(groups, "key").join(nodes.drop("keys", "class"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    placed = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "node", (F.col("own") > F.col("other")).alias("side"), "n_shingles", "component", "sketch",
    )
    dealt = placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    return dealt.mapInArrow(run, "key long, a long, b long")


def _apart(pairs: DataFrame, component: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    one, other = (component.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab")
    both = pairs.join(one, "a", "left").join(other, "b", "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _grown(component: DataFrame, links: DataFrame, scratch: Scratch, round_: int) -> DataFrame:
    """(node, component) after further links: only the components that these join are worked on."""
    one, other = (component.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab")
    between = links.join(one, "a", "left").join(other, "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    joined = scratch.store(components(between, scratch, f"joined-{round_}"), f"moved-{round_}")
    moved = joined.select(F.col("node").alias("old"), F.col("component").alias("new"))
    known = component.join(moved, F.col("component") == F.col("old"), "left")
    new = joined.join(component.select("node"), "node", "left_anti")
    return scratch.store(known.select("node", F.coalesce("new", "component").alias("component")).unionByName(new), f"component-{round_}")


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, class, component_id.

    Two documents link when 100 * |intersection| >= percent * |union| of their
    shingle sets; ``component_id`` is the least ``doc_id`` reachable by links. A
    null or blank text has an empty set and links with nothing. A row without
    ``doc_id`` is reported with a null component and takes no part. Rows that
    repeat a ``doc_id`` are one node. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with_keys = scratch.store(_classes(docs, size, percent), "with-keys")
    known = scratch.store(with_keys.drop("keys", "sketch"), "classes")

    real = with_keys.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = real.groupBy("class").agg(F.min("doc_id").alias("node"))
    first = scratch.store(first, "first")
    nodes = real.join(first, (real["class"] == first["class"]) & (real.doc_id == first.node), "left_semi").withColumnRenamed("doc_id", "node")
    nodes = scratch.store(nodes.select("node", "n_shingles", "sketch", "keys"), "nodes")
    scratch.drop("with-keys")
    keys = nodes.select("node", F.explode("keys").alias("key"))
    shared = scratch.store(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared")
    members = scratch.store(keys.join(shared, "key").distinct(), "members")

    hubs = scratch.store(members.groupBy("key").agg(F.min("node").alias("a")), "hubs")
    stars = members.join(hubs, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    near = scratch.store(_within_bound(stars, nodes, percent), "near")
    tried = scratch.store(near.groupBy("b").agg(F.min_by("a", F.struct("apart", "a")).alias("a")).select("a", "b"), "tried-1")
    links = scratch.store(_verified(tried, docs, size, percent), "links-1")
    component = scratch.store(components(links, scratch, "joined-1"), "component-1")
    for round_, spanning in ((2, True), (3, False)):
        found = scratch.store(_open_pairs(members, nodes, component, percent, spanning, scratch, f"round-{round_}"), f"found-{round_}")
        members = members.join(found.select("key").distinct(), "key", "left_semi")  # no other key can give a pair
        pairs = found.select("a", "b")
        if round_ == 2:
            pairs = pairs.unionByName(_apart(near.select("a", "b"), component))
        pairs = scratch.store(pairs.distinct().join(tried, ["a", "b"], "left_anti"), f"pairs-{round_}")
        links = scratch.store(_verified(pairs, docs, size, percent), f"links-{round_}")
        component = _grown(component, links, scratch, round_)
        tried = tried.unionByName(pairs)

    classes = first.join(component, "node", "left").select("class", F.coalesce("component", "node").alias("component_id"))
    # rows that repeat a doc_id have one node, and one component, between them
    whole = known.join(classes, "class", "left")
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), alone).alias("component_id"))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """Rows of ``docs`` that stay: of each group the one with the least ``doc_id``, all others whole; all columns.

    Of ``scratch`` only the ids of the dropped rows are kept.
    """
    scratch = scratch or Scratch(docs.sparkSession, "near")
    name = free_name(docs, "dropped")
    groups = near_groups(docs, size, percent, scratch)
    dropped = scratch.store(groups.where("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct(), "dropped")
    scratch.keep_only("dropped")
    return docs.join(dropped, docs.doc_id.cast("long") == F.col(name), "left_anti")


def sql(size: int, percent: int) -> str:
    """The same groups by an inverted index over shingles."""
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    return f"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {size} + 2), lambda i: {gram})) END AS g FROM t
), e AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM p UNION ALL SELECT b, a FROM p
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(reach.b), s.doc_id)) AS component_id
FROM s LEFT JOIN reach ON reach.a = s.doc_id GROUP BY s.doc_id, len(g)
"""
