"""Tables of a lake on plain Parquet or ORC: overwrite, append, merge, CHECK rules.

A table is a directory of versions ``v<number>``, a version a directory of parts
``p<number>.<rows>``. Every write goes to a directory of its own under ``_staged``
and is renamed into its place once Spark's committer has finished it. So a write
counts as a whole or not at all, nothing is read and overwritten in place, and
the number of rows stands in the name. An overwrite starts a new version, an
append adds a part to the newest one. The folder must be on a file system that
renames a directory in one step (HDFS and local ones do). One writer per table
at a time.

A *bucketed* table keeps its rows in hash buckets of its key
(``p<number>.<rows>.of<buckets>/_bucket=<n>``). A merge writes a part that holds only
the buckets its updates fall into; of each bucket the newest part counts.

In catalog mode each table is also an external table of the session catalog,
whose location follows the newest version. When an overwrite changes the
columns, it is dropped (the files stay) and created anew.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluice.config import LakeConfig

WRITES_SCHEMA = StructType(
    [
        StructField("layer", StringType(), False),
        StructField("table_name", StringType(), False),
        StructField("version", LongType(), False),
        StructField("operation", StringType(), False),
        StructField("row_count", LongType(), False),
    ]
)
RULES_DDL = "rule string, condition string"
BUCKET = "_bucket"
_PART = re.compile(r"p(\d+)\.(\d+)(?:\.of(\d+))?")


class SchemaMismatch(Exception):
    pass


class ConstraintViolation(Exception):
    pass


# --- constraints (K6/K7) -----------------------------------------------------

def _broken(cond: str) -> Column:
    # a CHECK holds only when the expression is TRUE; FALSE and NULL both break it
    return ~F.coalesce(F.expr(cond), F.lit(False))


def violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows that break at least one rule, with the names of the broken rules."""
    names = F.array(*[F.when(_broken(cond), F.lit(name)) for name, cond in rules.items()])
    return df.withColumn("broken_rules", F.array_compact(names)).filter(F.size("broken_rules") > 0)


def enforce(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The same rows, but the job fails on the first row that breaks a rule.

    The check is a filter predicate (TRUE or raise), so Catalyst cannot prune
    it, and it runs inside the writing tasks: no second pass over the data.
    """
    if not rules:
        return df
    guard = None
    for name, cond in rules.items():
        msg = F.lit(f"CHECK constraint {name} ({cond}) violated")
        guard = F.when(_broken(cond), F.raise_error(msg)) if guard is None else guard.when(_broken(cond), F.raise_error(msg))
    return df.filter(guard.otherwise(F.lit(True)))


# --- merge (K5/J1) -----------------------------------------------------------

def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], check_unique: bool = True, within: Sequence[str] = ()
) -> DataFrame:
    """MERGE by key: matched rows take the update's values, new keys are
    inserted, target-only rows are kept.

    Both sides are tagged and unioned, and one window per key counts the
    updates: each side is read once and shuffled once. NULL keys form a group
    like any other value, so a rerun with the same updates changes nothing.
    Columns are aligned by name and must match. Two updates with one key fail
    the job (``check_unique=False`` keeps both). ``target`` is assumed unique on
    ``keys``; its repeated rows are kept where no update meets them. ``within``
    names columns that follow from the key: rows are dealt by them, and what is
    written by them needs no second shuffle.
    """
    tagged = updates.withColumn("_update", F.lit(1)).unionByName(target.withColumn("_update", F.lit(0)))
    if within:
        tagged = tagged.repartition(*within)
    counted = tagged.withColumn("_updates", F.sum("_update").over(Window.partitionBy(*within, *keys)))
    keep = (F.col("_update") == 1) | (F.col("_updates") == 0)
    if check_unique:
        msg = F.concat(F.lit("duplicate key in merge source: "), F.to_json(F.struct(*keys)))
        keep = F.when(F.col("_updates") > 1, F.raise_error(msg).cast("boolean")).otherwise(keep)
    return counted.filter(keep).drop("_update", "_updates")


def merge_changes(target: DataFrame, updates: DataFrame, keys: Sequence[str], name: str = "change") -> DataFrame:
    """What ``merge_upsert`` would change: the updates with 1, the target rows they replace with -1 in a column ``name``.

    Sums of the merged table follow from those of the target and of these rows.
    """
    tagged = updates.withColumn(name, F.lit(1)).unionByName(target.withColumn(name, F.lit(-1)))
    met = F.max(name).over(Window.partitionBy(*keys))
    return tagged.withColumn("_met", met).filter("_met = 1").drop("_met")


def unique_or_fail(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, but the job that consumes them fails on a duplicate key (NULL keys count as one)."""
    return merge_upsert(df.limit(0), df, keys)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The hash bucket of a key (NULL is a key like any other)."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


# --- the store (K1, K2, K3, K4) -------------------------------------------------

class Part(NamedTuple):
    number: int
    rows: int
    buckets: int | None
    path: str


class TableStore:
    """Tables of one lake; ``writes`` lists what this store has written, with row counts."""

    FORMATS = ("parquet", "orc")

    def __init__(self, spark: SparkSession, lake: LakeConfig):
        if lake.table_format not in self.FORMATS:
            raise ValueError(f"table_format must be one of {self.FORMATS}")
        self.spark = spark
        self.lake = lake
        self.writes: list[tuple[str, str, int, str, int]] = []
        #: what was measured on the last write of a table
        self.measured: dict[tuple[str, str], dict] = {}

    # directories
    def _root(self, layer: str, name: str) -> str:
        return f"{self.lake.root.rstrip('/')}/{layer}/{name}"

    def _hadoop(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath, jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _found(self, pattern: str) -> list[str]:
        path, fs = self._hadoop(pattern)
        return [f.getPath().toString() for f in fs.globStatus(path) or []]

    def _delete(self, path: str) -> None:
        jpath, fs = self._hadoop(path)
        fs.delete(jpath, True)

    def _parts(self, layer: str, name: str) -> dict[int, list[Part]]:
        """Finished parts of each version; a listing of one table's directories."""
        out: dict[int, list[Part]] = {}
        for path in self._found(f"{self._root(layer, name)}/v*/p*"):
            version, part = path.rsplit("/", 2)[-2:]
            if found := _PART.fullmatch(part):
                number, rows, buckets = found.groups()
                out.setdefault(int(version[1:]), []).append(Part(int(number), int(rows), buckets and int(buckets), path))
        return {v: sorted(out[v]) for v in sorted(out)}

    def _newest(self, layer: str, name: str) -> tuple[int | None, list[Part]]:
        parts = self._parts(layer, name)
        return max(parts.items()) if parts else (None, [])

    def _path(self, layer: str, name: str, version: int) -> str:
        return f"{self._root(layer, name)}/v{version}"

    def exists(self, layer: str, name: str) -> bool:
        return bool(self._parts(layer, name))

    def versions(self, layer: str, name: str) -> list[int]:
        return list(self._parts(layer, name))

    # reading
    def _bucket_dirs(self, parts: Sequence[Part]) -> dict[int, str]:
        """Of each bucket the directory of the newest part that holds it."""
        newest: dict[int, str] = {}
        for part in parts:
            for path in self._found(f"{part.path}/{BUCKET}=*"):
                newest[int(path.rsplit("=", 1)[1])] = path
        return newest

    def _load(self, parts: Sequence[Part], only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version; of a bucketed one ``only`` some buckets, if given."""
        reader = self.spark.read.format(self.lake.table_format)
        if not parts[0].buckets:
            return reader.load([p.path for p in parts])
        dirs = self._bucket_dirs(parts)
        wanted = [d for n, d in sorted(dirs.items()) if only is None or n in set(only)]
        first = reader.load(parts[0].path)
        if not wanted:
            return first.drop(BUCKET).limit(0)
        return reader.schema(first.drop(BUCKET).schema).load(wanted)

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """The newest (or a given) version of a table."""
        parts = self._parts(layer, name)
        if not parts or version not in (None, *parts):
            raise FileNotFoundError(f"table {layer}.{name} has no version {'' if version is None else version}")
        return self._load(parts[max(parts) if version is None else version])

    def count(self, layer: str, name: str) -> int:
        """K3: rows of the newest version, from the names of its parts (of a bucketed table from its files' footers)."""
        _, parts = self._newest(layer, name)
        if not parts:
            raise FileNotFoundError(f"table {layer}.{name} has no version")
        return self._load(parts).count() if parts[0].buckets else sum(p.rows for p in parts)

    def footer_ranges(self, layer: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
        """row_count, and min_<column> and max_<column>, of the newest version from its files' footers.

        Spark's file readers of the second version push such aggregates (without
        filters; numbers, dates and booleans) into the footers, so no column is
        read. They are switched on for this one plan.
        """
        _, parts = self._newest(layer, name)
        if not parts:
            raise FileNotFoundError(f"table {layer}.{name} has no version")
        wanted = [F.count(F.lit(1)).alias("row_count")]
        wanted += [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
        settings = {"spark.sql.sources.useV1SourceList": "", f"spark.sql.{self.lake.table_format}.aggregatePushdown": "true"}
        before = {k: self.spark.conf.get(k, None) for k in settings}
        try:
            for k, v in settings.items():
                self.spark.conf.set(k, v)
            found = self._load(parts).agg(*wanted)
            found._jdf.queryExecution().executedPlan()  # planned now, under these settings
            return found
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    # writing
    def _stage(
        self, layer: str, name: str, df: DataFrame, by: Sequence[str] = (), measures: Mapping[str, Column] | None = None
    ) -> tuple[str, int]:
        """Rows written to a directory that no reader looks into; its path and their number.

        ``measures`` are aggregates over the rows, taken while they are written. The observed count sits in the write's result stage, whose accumulator
        updates Spark applies once per partition: retried or speculative tasks
        do not count twice.
        """
        rows = Observation(f"rows_{uuid.uuid4().hex[:8]}")
        path = f"{self._root(layer, name)}/_staged/{uuid.uuid4().hex}"
        seen = [F.count(F.lit(1)).alias("n"), *[c.alias(f"m_{m}") for m, c in (measures or {}).items()]]
        writer = df.observe(rows, *seen).write.format(self.lake.table_format)
        (writer.partitionBy(*by) if by else writer).save(path)
        if measures:
            self.measured[layer, name] = {m: rows.get[f"m_{m}"] for m in measures}
        return path, int(rows.get["n"])

    def _commit(self, layer: str, name: str, staged: str, version: int, part: str) -> None:
        """Rename a staged directory into its place."""
        source, fs = self._hadoop(staged)
        target, _ = self._hadoop(f"{self._path(layer, name, version)}/{part}")
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(source, target):
            raise FileExistsError(f"{layer}.{name} has another writer: {target} could not be made")
        if self.lake.catalog_mode:
            self._show(layer, name, version)

    def _show(self, layer: str, name: str, version: int) -> None:
        """K2: make the catalog's table that version, columns included."""
        table, path = self.lake.location(layer, name), self._path(layer, name, version)
        columns = self.read(layer, name, version).schema
        if self.spark.catalog.tableExists(table):
            if self.spark.table(table).schema == columns:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(table)
                return
            self.spark.sql(f"DROP TABLE {table}")
        self.spark.catalog.createTable(table, path, self.lake.table_format, columns, recursiveFileLookup="true")

    def write(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        operation: str = "OVERWRITE",
        rules: Mapping[str, str] | None = None,
        measures: Mapping[str, Column] | None = None,
    ) -> int:
        """K1/K2/K3: replace the table with ``df``, whatever its columns; returns the new version.

        The attached CHECK rules and ``rules`` are enforced inside the writing
        tasks: on a broken rule the job fails and the old version stays.
        ``measures`` (name -> aggregate, none of them DISTINCT) are taken over the
        rows in the same job and kept in ``measured``.
        """
        version, _ = self._newest(layer, name)
        checked = enforce(df, {**self.constraints(layer, name), **(rules or {})})
        staged, rows = self._stage(layer, name, checked, measures=measures)
        return self._place(layer, name, staged, 0 if version is None else version + 1, f"p0.{rows}", operation, rows)

    def _place(self, layer: str, name: str, staged: str, version: int, part: str, operation: str, rows: int) -> int:
        self._commit(layer, name, staged, version, part)
        self.writes.append((layer, name, version, operation, rows))
        return version

    def append(self, layer: str, name: str, df: DataFrame, rules: Mapping[str, str] | None = None) -> int:
        """K7: add rows to the newest version as a part of its own, all of them or none.

        Names and types must be those of the table. The stored rows are not read.
        """
        version, parts = self._newest(layer, name)
        if version is None:
            return self.write(layer, name, df, "APPEND", rules)
        if parts[0].buckets:
            raise ValueError(f"{layer}.{name} is bucketed: rows are added by merge")
        stored = self.read(layer, name)
        if sorted(stored.dtypes) != sorted(df.dtypes):
            raise SchemaMismatch(f"{layer}.{name} has {stored.dtypes}, the rows to append {df.dtypes}")
        checked = enforce(df.select(*stored.columns), {**self.constraints(layer, name), **(rules or {})})
        staged, rows = self._stage(layer, name, checked)
        total = sum(p.rows for p in parts) + rows
        return self._place(layer, name, staged, version, f"p{parts[-1].number + 1}.{rows}", "APPEND", total)

    def merge(
        self,
        layer: str,
        name: str,
        updates: DataFrame,
        keys: Sequence[str],
        check_unique: bool = True,
        buckets: int | None = None,
        measures: Mapping[str, Column] | None = None,
    ) -> int:
        """K5: upsert ``updates`` into the table (created from them if absent).

        With ``buckets`` the table is created bucketed by its key. A merge into a
        bucketed table reads and writes only the buckets that ``updates`` fall
        into; otherwise the whole table is written anew, and ``measures`` are taken
        over all its rows. A bucket should be of a size that one task can sort.
        """
        version, parts = self._newest(layer, name)
        if buckets or (parts and parts[0].buckets):
            if measures:
                raise ValueError("a bucketed merge sees some of the rows only: it takes no measures")
            return self._merge_buckets(layer, name, updates, keys, check_unique, buckets)
        if version is None:
            return self.write(layer, name, unique_or_fail(updates, keys) if check_unique else updates, operation="CREATE", measures=measures)
        merged = merge_upsert(self.read(layer, name), updates, keys, check_unique)
        return self.write(layer, name, merged, operation="MERGE", measures=measures)

    def _merge_buckets(self, layer: str, name: str, updates: DataFrame, keys: Sequence[str], check_unique: bool, buckets: int | None) -> int:
        if self.lake.catalog_mode:
            raise ValueError("bucketed tables are read by path, not through the catalog")
        version, parts = self._newest(layer, name)
        size = parts[0].buckets if parts else buckets
        if not size or buckets not in (None, size):
            raise ValueError(f"{layer}.{name} has {size or 'no'} buckets, not {buckets}")
        dealt = updates.withColumn(BUCKET, bucket_of(keys, size))
        # a few numbers: at most one per bucket
        met = [r[0] for r in dealt.select(BUCKET).distinct().collect()]
        if version is not None and not met:
            return version
        old = self._load(parts, met) if parts else updates.limit(0)
        merged = merge_upsert(old.withColumn(BUCKET, bucket_of(keys, size)), dealt, keys, check_unique, within=[BUCKET])
        staged, rows = self._stage(layer, name, enforce(merged, self.constraints(layer, name)), by=[BUCKET])
        operation, number = ("MERGE", parts[-1].number + 1) if parts else ("CREATE", 0)
        return self._place(layer, name, staged, version or 0, f"p{number}.{rows}.of{size}", operation, rows)

    def create_if_absent(self, layer: str, name: str, schema: StructType) -> bool:
        """K4: create an empty table with a declared schema unless it exists; True when created."""
        if self.exists(layer, name):
            return False
        self.write(layer, name, self.spark.createDataFrame([], schema), operation="CREATE")
        return True

    def clean(self, layer: str, name: str, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` versions, and what crashed writes have left.

        Not while another writer or a reader of an old version is at work.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        self._delete(f"{self._root(layer, name)}/_staged")
        newest = self.versions(layer, name)[-keep:]
        for path in self._found(f"{self._root(layer, name)}/v*"):
            if int(path.rsplit("/v", 1)[1]) not in newest:
                self._delete(path)

    # table constraints (K6)
    def _rule_sets(self, layer: str, name: str) -> Iterator[int]:
        for path in self._found(f"{self._root(layer, name)}/_rules/r*/_SUCCESS"):
            yield int(path.rsplit("/", 2)[-2][1:])

    def constraints(self, layer: str, name: str) -> dict[str, str]:
        """The CHECK rules attached to a table (a few rows beside its versions): the newest finished set."""
        newest = max(self._rule_sets(layer, name), default=None)
        if newest is None:
            return {}
        rows = self.spark.read.schema(RULES_DDL).json(f"{self._root(layer, name)}/_rules/r{newest}")
        return {r.rule: r.condition for r in rows.collect()}

    def _keep_rules(self, layer: str, name: str, rules: Mapping[str, str]) -> None:
        """A set in a new directory, so that a crash leaves the set before it."""
        newest = max(self._rule_sets(layer, name), default=-1)
        rows = self.spark.createDataFrame(list(rules.items()), RULES_DDL)
        rows.coalesce(1).write.mode("overwrite").json(f"{self._root(layer, name)}/_rules/r{newest + 1}")
        for old in set(self._rule_sets(layer, name)) - {newest + 1}:
            self._delete(f"{self._root(layer, name)}/_rules/r{old}")

    def add_constraints(self, layer: str, name: str, rules: Mapping[str, str]) -> None:
        """Attach CHECK rules; rows already stored must satisfy all of them
        (checked in one scan), and every later write or append to the table is
        checked against them. Re-adding a rule replaces it."""
        if self.exists(layer, name):
            bad = violations(self.read(layer, name), rules).limit(1).collect()
            if bad:
                raise ConstraintViolation(f"existing rows break CHECK constraints {bad[0]['broken_rules']}: {bad[0].asDict()}")
        kept = self.constraints(layer, name)
        if {**kept, **rules} != kept:
            self._keep_rules(layer, name, {**kept, **rules})

    def add_constraint(self, layer: str, name: str, rule: str, condition: str) -> None:
        """Attach one CHECK rule (see ``add_constraints``)."""
        self.add_constraints(layer, name, {rule: condition})

    def drop_constraint(self, layer: str, name: str, rule: str) -> bool:
        """Detach a rule; returns False when the table had no such rule."""
        kept = self.constraints(layer, name)
        if rule not in kept:
            return False
        self._keep_rules(layer, name, {k: v for k, v in kept.items() if k != rule})
        return True

    def written(self) -> DataFrame:
        """K3/K8: this store's writes: layer, table_name, version, operation, row_count."""
        return self.spark.createDataFrame(self.writes, WRITES_SCHEMA)

    def audit(self) -> DataFrame:
        """Q6: row count after the last write of every table this store has written."""
        last = {(layer, name): n for layer, name, _, _, n in self.writes}
        rows = [(*key, n) for key, n in sorted(last.items())]
        return self.spark.createDataFrame(rows, "layer string, table_name string, row_count long")
