"""The commonest rows of a table of counts, without sorting it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of the histogram of counts per doubling.
STEPS = 32


def commonest(counts: DataFrame, most: int, column: str = "n") -> tuple[Column, list]:
    """A condition that holds for ``most`` rows at most, those of the highest counts, and the histogram behind it.

    Counts (1 or more) fall into steps of equal ratio; the rows of the highest
    steps are taken, as many whole steps as stay within ``most``. The histogram
    has a row per step (step, entries, total): a few thousand at any size.
    """
    step = F.floor(F.log2(F.col(column)) * STEPS).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("entries"), F.sum(column).alias("total")).collect()
    least, room = 1 << 30, most
    for r in sorted(histogram, key=lambda r: -r["step"]):
        room -= r["entries"]
        if room < 0:
            break
        least = r["step"]
    return step >= F.lit(least), histogram
