import os
import time

import pyarrow as pa
from pyspark.sql import functions as F

from sluice.llm import common, language
from sluice.llm.common import Scratch


def _workers(spark, mark):
    """(pid, whether it holds an object) of the Python workers of many short tasks; ``mark`` leaves one in each."""

    def run(batches):
        for batch in batches:
            held = "left" in common._held
            if mark:
                common._held["left"] = bytearray(1000)
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()] * len(batch)), pa.array([held] * len(batch))], ["pid", "held"])
            time.sleep(0.05)

    rows = spark.range(64, numPartitions=64).mapInArrow(run, "pid long, held boolean").collect()
    return {(r.pid, r.held) for r in rows}


def test_the_language_filter_frees_what_an_earlier_operator_left(spark, docs):
    texts = docs([(i, f"some words in a text {i}") for i in range(200)], partitions=32)
    marked = {pid for pid, _ in _workers(spark, mark=True)}
    language.with_letters(texts).collect()
    language.identify(texts, language.fit(texts)).collect()
    assert any(pid in marked and not held for pid, held in _workers(spark, mark=False))


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}

    scratch = Scratch(spark, "test")
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, "false")
    stored = scratch.store(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(key, "false") == setting
    assert sorted(r["count"] for r in stored.collect()) == [142] * 1 + [143] * 6
    scratch.clear()
