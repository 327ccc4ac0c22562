"""Combining sources: union by name, priority dedup, key overlap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The relational source is the master; anything else ranks after it.
SOURCE_PRIORITIES = {"postgres": 1}
DEFAULT_PRIORITY = 2


def align_and_union(frames: Sequence[DataFrame], drop: Sequence[str] = ("created_at",)) -> DataFrame:
    """Drop the listed columns where present, then ``unionByName``.

    Strict: a column that only one side has (after dropping) raises, as does a
    type that cannot be widened. INT and BIGINT widen to BIGINT, DOUBLE and
    DECIMAL to DOUBLE.
    """
    if not frames:
        raise ValueError("need at least one DataFrame")
    aligned = [f.drop(*[c for c in drop if c in f.columns]) for f in frames]
    out = aligned[0]
    for f in aligned[1:]:
        out = out.unionByName(f)
    return out


def source_priority(
    source: str | Column = "source",
    priorities: Mapping[str, int] = SOURCE_PRIORITIES,
    default: int = DEFAULT_PRIORITY,
) -> Column:
    """Rank of a row's source; NULL or unknown sources get ``default``."""
    src = F.col(source) if isinstance(source, str) else source
    expr = None
    for name, rank in sorted(priorities.items(), key=lambda kv: kv[1]):
        expr = (F.when(src == name, F.lit(rank)) if expr is None else expr.when(src == name, F.lit(rank)))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def dedup_by_priority(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first row per key under ``order`` then ``tiebreak``.

    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a key that holds many rows (one hot key, or every NULL key,
    which form one group) ships at most one row per input partition. Ties are
    broken by ``tiebreak`` (default: every other column, ascending, NULLs
    first), so the kept row never depends on partitioning.
    """
    keyset = set(keys)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keyset]
    spec = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc_nulls_first() for c in tiebreak])
    return df.withColumn("_rn", F.row_number().over(spec)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_sources(
    df: DataFrame,
    keys: Sequence[str] = ("order_id",),
    source: str = "source",
    priorities: Mapping[str, int] = SOURCE_PRIORITIES,
    default: int = DEFAULT_PRIORITY,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """W1 as the reference uses it: the master source wins each key."""
    return dedup_by_priority(df, keys, [source_priority(source, priorities, default).asc()], tiebreak)


def dedup_by_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tiebreak: Sequence[str] | None = None,
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """W1 as one aggregate: per key the least row under ``order`` then ``tiebreak``, with ``counts`` over all its rows.

    The least of a struct (order, tiebreak, other columns; NULLs first) has a
    partial form: each task sends one row per key, so a key that holds a third
    of all rows is no task's burden, and the rows that lose are counted in the
    same pass. Every column must be comparable. The kept row is that of
    ``dedup_by_priority``.
    """
    keyset = set(keys)
    others = [c for c in df.columns if c not in keyset]
    first = list(tiebreak) if tiebreak is not None else others
    ranks = [o.alias(f"_rank{i}") for i, o in enumerate(order)]
    ordered = F.struct(*ranks, *[F.col(c) for c in first], *[F.col(c) for c in others if c not in first])
    least = df.groupBy(*keys).agg(F.min(ordered).alias("_least"), *[c.alias(n) for n, c in (counts or {}).items()])
    return least.select(*[F.col(c) if c in keyset else F.col("_least")[c].alias(c) for c in df.columns], *(counts or {}))


def dedup_counted(
    df: DataFrame,
    keys: Sequence[str] = ("order_id",),
    source: str = "source",
    priorities: Mapping[str, int] = SOURCE_PRIORITIES,
    default: int = DEFAULT_PRIORITY,
    tiebreak: Sequence[str] | None = None,
    labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """The rows that ``dedup_sources`` keeps, each with the number of its key's rows per source (``labels``: source -> column)."""
    counts = {name: F.count_if(F.col(source) == value) for value, name in (labels or {}).items()}
    return dedup_by_aggregate(df, keys, [source_priority(source, priorities, default)], tiebreak, counts)


def source_overlap(a: DataFrame, b: DataFrame, key: str = "order_id") -> DataFrame:
    """Distinct keys present in both frames (NULL matches NULL)."""
    return a.select(key).intersect(b.select(key))


def overlap_within(rows: DataFrame, key: str, source: str, a: str, b: str) -> DataFrame:
    """J2 on one frame that holds both sources: the distinct keys found in both, from one aggregate."""
    both = rows.groupBy(key).agg((F.bool_or(F.col(source) == a) & F.bool_or(F.col(source) == b)).alias("_both"))
    return both.filter("_both").select(key)
