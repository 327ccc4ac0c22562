"""Exact dedup by deterministic block naming, in DataFrame operations only.

A text (A-Z lower-cased) is cut into blocks of ``BLOCK_BYTES``. The distinct
blocks are sorted and numbered: equal blocks, and no others, share an integer
name. Then adjacent names are paired and the distinct pairs numbered the same
way, level by level, until each document has one name. Two documents with as
many levels have the same last name only if their texts are equal, so no hash
value decides anything.

Blocks and pairs are made distinct inside each task before they move, and every
name comes back over a plain equi-join, so a block that a third of all rows
share is split by Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, free_name, lower_ascii

BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    """Null counts as empty."""
    return lower_ascii(F.coalesce(text.cast("string"), F.lit("")))


def _names(values: DataFrame, *keys: str) -> DataFrame:
    """Number the distinct rows: each task's share in sorted order, tasks one after the other."""
    distinct = values.select(*keys).distinct().sortWithinPartitions(*keys)
    return distinct.withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Per (doc_id, text): doc_id, sha, copies (rows that repeat both), level, name.

    (level, name) is the text's identity within this run.
    """
    text = normalised(F.col("text")).cast("binary")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("raw")).withColumns(
        {"sha": F.unhex(F.sha2("raw", 256)), "blocks": F.greatest(F.ceil(F.octet_length("raw") / BLOCK_BYTES), F.lit(1)).cast("int")}
    )
    cut = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.substring(F.col("raw"), i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)))
    pieces = whole.select("doc_id", "sha", "blocks", F.posexplode(cut).alias("at", "block"))
    named = pieces.join(_names(pieces, "block"), "block").select("doc_id", "sha", "blocks", "at", "name")
    named = scratch.store(named, "level-0")

    longest = named.agg(F.max("blocks")).first()[0] or 0
    one = named.where("blocks = 1").groupBy("doc_id", "sha", "name").agg(F.count("*").alias("copies"))
    done = [one.select("doc_id", "sha", "copies", F.lit(0).alias("level"), "name")]
    rest = named.where("blocks > 1").withColumn("copies", F.lit(None).cast("long"))
    level = 0
    while longest > 1:
        level, longest = level + 1, -(-longest // 2)
        left, right = F.when(F.col("at") % 2 == 0, F.col("name")), F.when(F.col("at") % 2 == 1, F.col("name"))
        pairs = rest.groupBy("doc_id", "sha", "blocks", (F.col("at") / 2).cast("int").alias("at")).agg(
            F.max(left).alias("left"),
            F.coalesce(F.max(right), F.lit(-1)).alias("right"),  # an odd end; names are never negative
            F.coalesce(F.max("copies"), F.count(left)).alias("copies"),
        )
        pairs = scratch.store(pairs, f"pairs-{level}")
        rest = pairs.join(_names(pairs, "left", "right"), ["left", "right"]).select(
            "doc_id", "sha", "copies", F.ceil(F.col("blocks") / 2).cast("int").alias("blocks"), "at", "name"
        )
        rest = scratch.store(rest, f"level-{level}")
        done.append(rest.where("blocks = 1").select("doc_id", "sha", "copies", F.lit(level).alias("level"), "name"))
        rest = rest.where("blocks > 1")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_groups(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest ``doc_id`` stays; null ids lose to any other. Of
    rows that repeat id and text one stays. Null text is empty. An empty table
    gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    known = identities(docs, scratch)
    # stored, so that the join below shuffles two plain tables and Spark can split a hot group
    groups = known.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    rows = known.join(scratch.store(groups, "groups"), ["level", "name"])
    copy = F.posexplode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy", "_")
    return rows.select("doc_id", "keep_id", "group_size", "sha", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Of rows that repeat id and text one stays, whichever; if they differ in other
    columns, those of one of them. Of ``scratch`` only ids and digests of the
    kept rows are kept.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    own, kept_id, kept_sha = (free_name(docs, n) for n in ("own_sha", "kept_id", "kept_sha"))
    kept = exact_groups(docs, scratch).where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    kept = scratch.store(kept, "kept")
    scratch.keep_only("kept")
    marked = docs.withColumn(own, F.sha2(normalised(F.col("text")).cast("binary"), 256))
    same = (F.col(own) == F.col(kept_sha)) & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id))
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)


SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY norm)
"""
