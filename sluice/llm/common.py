"""Shared pieces: reading the corpus, written intermediate tables, batch bounds."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import shared_dir

BATCH_BYTES = 16 << 20

#: Unicode White_Space, the class that tokenizers and word rules call \s (fixed values).
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Cap the bytes of one Arrow batch, so a worker's memory does not follow text length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


_held: dict[object, object] = {}


def held_by_worker(key: object, make: Callable[[], object]):
    """A large object that a Python worker builds once: a vocabulary with its cache, a model's tables.

    A worker serves many operators one after the other, so only the latest such
    object stays.
    """
    if key not in _held:
        release_held()
        _held[key] = make()
    return _held[key]


def release_held() -> None:
    """Free what an earlier operator has left in this worker."""
    if _held:
        _held.clear()
        trim()


def trim() -> None:
    """Hand freed memory back to the system; else an idle worker keeps that of its largest batch."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if give_back:
        give_back(0)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go once it is written, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """A helper column's name that the frame does not use (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}".lower() in taken:
        name += "_"
    return f"_{name}"


class Scratch:
    """Tables written under the folder named by ``spark.checkpoint.dir``.

    A written table cuts the lineage and outlives any executor. ``drop``
    removes one once nothing reads it; tables behind a returned frame stay in
    ``root`` for the caller to remove: who passes a ``Scratch`` to an operator
    calls ``clear`` when the frame has been used up.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/sluice-llm/{label}-{uuid.uuid4().hex[:12]}"
        self.tables: list[str] = []  # tables of the session catalog that lie in this folder

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        with shuffles_dropped(self.spark):
            df.write.mode("overwrite").option("compression", codec).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _delete(self, path: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def _drop_tables(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()

    def keep_only(self, *names: str) -> None:
        """Remove all tables but some that a returned frame reads."""
        self._drop_tables()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for found in fs.listStatus(path) if fs.exists(path) else []:
            if found.getPath().getName() not in names:
                fs.delete(found.getPath(), True)

    def clear(self) -> None:
        self._drop_tables()
        self._delete(self.root)


def lower_ascii(column):
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
