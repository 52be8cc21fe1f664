"""Axes that have to be equal: fingerprints that depend on the order of values and merge like sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fingerprints(rows: DataFrame, by: str, place: str, value: str) -> DataFrame:
    """(by, n, sum1, sum2): of each axis its length and two sums of hashes of place and value together.

    Partial sums are made before the shuffle, so no task gathers an axis. Axes of equal values in another order, with one
    other value or of another length have other fingerprints (but for chance, about 1 in 2^120). A null place or value
    is hashed as such.
    """
    both = F.struct(F.col(place).alias("place"), F.col(value).alias("value"))
    sums = [F.sum(F.xxhash64(F.lit(salt), both["place"].isNull(), both["value"].isNull(), both["place"], both["value"]).cast("decimal(38,0)")).alias(name) for salt, name in ((1, "sum1"), (2, "sum2"))]
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *sums)


def alike(rows: DataFrame, by: str, place: str, value: str) -> DataFrame:
    """(by, n, like): each axis' length and the smallest ``by`` whose axis is equal."""
    found = fingerprints(rows, by, place, value)
    least = found.groupBy("n", "sum1", "sum2").agg(F.min(by).alias("like"))
    return found.join(least, ["n", "sum1", "sum2"]).select(by, "n", "like")


def differing(rows: DataFrame, by: str, place: str, value: str) -> DataFrame:
    """(by, n, expected): the axes that are not equal to the commonest one (of equally common ones, that of the smallest
    ``by``) with its length; no rows if all are equal."""
    found = fingerprints(rows, by, place, value)
    common = found.groupBy("n", "sum1", "sum2").agg(F.count(by).alias("many"), F.min(by).alias("first"))
    common = common.orderBy(F.desc("many"), "first").limit(1).select(*[F.col(x).alias(f"_{x}") for x in ("n", "sum1", "sum2")])
    same = (F.col("n") == F.col("_n")) & (F.col("sum1") == F.col("_sum1")) & (F.col("sum2") == F.col("_sum2"))
    return found.join(F.broadcast(common), ~same).select(by, "n", F.col("_n").alias("expected"))  # one row is broadcast


def require_equal(table: DataFrame, by: str, axes: dict[str, DataFrame]) -> None:
    """An error that names what differs; ``axes`` holds (by, place, value) frames by the name of the axis."""
    for name, rows in axes.items():
        bad = differing(rows, by, "place", "value").orderBy(by).limit(10).collect()
        if bad:
            said = ", ".join(f"{r[by]} ({r['n']} values in place of {r['expected']})" for r in bad)
            raise ValueError(f"axes {name} differ: {said}")


def descents(rows: DataFrame, by: str, place: str, value: str) -> DataFrame:
    """(by, place, value, before): where an axis does not ascend strictly, nulls among it."""
    before = F.lag(value).over(Window.partitionBy(by).orderBy(place))
    first = F.row_number().over(Window.partitionBy(by).orderBy(place)) == 1
    marked = rows.select(by, place, value, before.alias("before"), first.alias("_first"))
    return marked.where((F.col(value).isNull() & F.col("_first")) | (~F.col("_first") & ~F.coalesce(F.col(value) > F.col("before"), F.lit(False)))).drop("_first")
