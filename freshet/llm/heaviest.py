"""The heaviest rows of a table, found by a histogram instead of an ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heaviest(df: DataFrame, weight: str, most: int) -> DataFrame:
    """At most ``most`` rows, those of the largest ``weight`` (positive). Rows come in steps of about one
    per cent of weight, each taken whole or not at all, so no task has to hold or order candidates of all
    the others; the histogram has at most 4096 rows."""
    step = F.floor(F.log2(F.col(weight).cast("double")) * 64).cast("int")
    taken, least = 0, None
    for row in sorted(df.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        taken += row["count"]
        if taken > most:
            break
        least = row["step"]
    return df.where(step >= least) if least is not None else df.limit(0)
