"""Small results of many tasks, combined in two rounds of groups.

A task's partial result is a few binary values of bounded size, each under a
key. The first round combines each key's values in ``FIRST_ROUND`` groups spread
over the cluster, the second combines what these give, so no task and no
driver meets the partial results of all tasks at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_ROUND = 64
PARTIAL_SCHEMA = "part long, key long, payload binary"


def partial_results(source: DataFrame, of_task: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """(part, key, payload): what ``of_task`` makes of the batches of each task; a task may give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for key, payload in of_task(batches):
            columns = [pa.array([part], pa.int64()), pa.array([key], pa.int64()), pa.array([payload], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "key", "payload"])

    return source.mapInArrow(run, PARTIAL_SCHEMA)


def combined(partials: DataFrame, combine: Callable[[list[bytes]], bytes]) -> DataFrame:
    """(part, key, payload) with one row per key; ``combine`` must not depend on grouping."""

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part", kind="stable")
        payload = combine([bytes(p) for p in frame["payload"]])
        return pd.DataFrame({"part": frame["part"].iloc[:1], "key": frame["key"].iloc[:1], "payload": [payload]})

    first = partials.groupBy("key", F.pmod("part", F.lit(FIRST_ROUND)).alias("group")).applyInPandas(together, PARTIAL_SCHEMA)
    return first.groupBy("key").applyInPandas(together, PARTIAL_SCHEMA)


def gathered(partials: DataFrame, combine: Callable[[list[bytes]], bytes]) -> dict[int, bytes]:
    """The combined payload of every key; the keys are few."""
    return {row["key"]: bytes(row["payload"]) for row in combined(partials, combine).select("key", "payload").collect()}
