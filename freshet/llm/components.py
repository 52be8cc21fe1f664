"""Connected components of a link table by alternating large and small stars.

Links are first shortened inside tasks: a bounded run of links becomes the stars of its own components,
which keeps what is connected. No task or driver holds all links, and a node with many links is only the
key of aggregates with partial sums: its links meet it by broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.scratch import Scratch

#: Links that a task turns into stars at once.
RUN_LINKS = 500_000
MAX_ROUNDS = 40
#: Links that make a node a hub, and most hubs that are broadcast.
HUB, MAX_HUBS = 256, 100_000


def _plain(column) -> list:
    values = column.to_pylist()
    return [tuple(x.values()) for x in values] if pa.types.is_struct(column.type) else values


def _stars(links: list[tuple]) -> list[tuple]:
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in parent if root(x) != x]


def shortened(links: DataFrame) -> DataFrame:
    """Columns u, v; connects the same nodes by at most as many links, each towards a smaller node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        kind = None

        def rows():
            stars = _stars(held)
            names = [f.name for f in kind] if pa.types.is_struct(kind) else None
            cells = [[dict(zip(names, x)) for x in side] if names else list(side) for side in ([s[0] for s in stars], [s[1] for s in stars])]
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c in cells], names=["u", "v"])

        for batch in batches:
            kind = batch.column(0).type
            held += zip(_plain(batch.column(0)), _plain(batch.column(1)))
            if len(held) >= RUN_LINKS:
                yield rows()
                held = []
        if held:
            yield rows()

    kind = links.schema["u"].dataType.simpleString()
    return links.select("u", "v").mapInArrow(run, f"u {kind}, v {kind}")


def join_hubs(rows: DataFrame, keyed: DataFrame, key: str | list[str], few: int) -> DataFrame:
    """``rows`` with what ``keyed`` has of their key. ``keyed`` has a row a key, and as n the rows of that key: keys of
    more than ``few`` rows are met by broadcast, so none of them gathers its rows in one task; all others by shuffle.
    With a ``few`` from ``hub_size`` no more than MAX_HUBS keys are broadcast."""
    hubs = F.broadcast(keyed.where(F.col("n") > few))
    plain = rows.join(hubs.select(key), key, "left_anti").join(keyed.drop("n"), key)
    return plain.union(rows.join(hubs.drop("n"), key).select(plain.columns))


def hub_size(rows: int) -> int:
    return max(HUB, rows // MAX_HUBS)


def _with_least(links: DataFrame, few: int) -> DataFrame:
    """``links`` with m, the smallest v of their u."""
    return join_hubs(links, links.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n")), "u", few)


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node that has a link to another; component is its smallest node."""
    edges = scratch.save(shortened(links.where("u <> v")), f"{name}-0")
    seen, count = None, edges.count()
    for turn in range(1, MAX_ROUNDS + 1):
        few = hub_size(2 * count)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, few).withColumn("m", F.least("u", "m")).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.save(large, f"{name}-large{turn}")
        small = _with_least(large, few).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = scratch.save(small.select("e.u", "e.v").where("u <> v").distinct(), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}", f"{name}-large{turn}")
        state = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen, count = state, state[0]
    raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")
