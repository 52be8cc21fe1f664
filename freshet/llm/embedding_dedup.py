"""Near-duplicate embeddings: a small-world graph per shard, every shard queried by every block.

Equal vectors of one label are one node with a count, so a large group of copies costs one row. The
nodes of a label are dealt by hash to shards of bounded size and each shard is indexed once. A task loads a
shard's index once and streams a lane of query blocks past it; of two shards only one is queried by the other.
Similarities are checked in double precision. A node is named by the smallest vec_id of its copies and a
number of its own, so rows that share a vec_id but not the vector stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from freshet.llm.components import components, hub_size, join_hubs
from freshet.llm.hnsw import Graph
from freshet.llm.scratch import Scratch

#: Nodes a shard holds about, and query blocks that one loading of its index serves.
SHARD, LANE = 8192, 16
#: Single precision may be off by less than this.
SLACK = 1e-5
NODE = "struct<rep:bigint,tie:bigint>"


def unit_rows(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(1, keepdims=True))


def _index(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["rep", "tie"])
    raw = np.stack(group["vector"].to_numpy())
    graph = Graph.build(unit_rows(raw.astype(np.float64)).astype(np.float32))
    first = group.iloc[0]
    names = {x: [group[x].to_numpy(np.int64).tobytes()] for x in ("rep", "tie", "size")}
    return pd.DataFrame({"label": [first["label"]], "dim": [first["dim"]], "shard": [first["shard"]], **names, "vectors": [raw.tobytes()], "graph": [graph.dumps()]})


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component."""
    low = np.arange(n)
    while True:
        new = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _queried(least: float, recall: float, kind: str):
    """Reads an index (block -1) before the blocks that query it; returns, of each block, the links of nodes
    (weighted by copies), stars that connect them, and what the audit counted."""

    def nodes(row: dict) -> dict:
        out = {x: np.frombuffer(row[x], np.int64) for x in ("rep", "tie", "size")}
        out["unit"] = unit_rows(np.frombuffer(row["vectors"], kind).reshape(len(out["rep"]), -1).astype(np.float64))
        return out

    def pairs(own: dict, other: dict, q: np.ndarray, node: np.ndarray):
        near = [np.einsum("ij,ij->i", own["unit"][q[j : j + 100_000]], other["unit"][node[j : j + 100_000]]) >= least for j in range(0, len(q), 100_000)]
        ok = np.concatenate(near or [np.empty(0, bool)])
        return q[ok], node[ok]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = graph = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {x: batch.column(x)[i].as_py() for x in ("shard", "block", "rep", "tie", "size", "vectors", "graph")}
                if row["block"] < 0:
                    held = nodes(row)
                    graph = Graph.loads(held["unit"].astype(np.float32), row["graph"])
                    continue
                same = row["block"] == row["shard"]
                own = held if same else nodes(row)
                q, node, truth, got = graph.within(own["unit"].astype(np.float32), least - SLACK, recall=recall, own=same)
                yield _out(batch.schema.field("label").type, audit=(batch.column("label").slice(i, 1), row["shard"], truth, got))
                m = len(held["rep"])
                if same:  # a pair found from one side counts for both
                    q, node = (x[q != node] for x in (q, node))
                    both = np.unique(np.concatenate((q * m + node, node * m + q)))
                    q, node = pairs(own, held, both // m, both % m)
                    names, links = held, np.bincount(q, weights=held["size"][node], minlength=m)
                else:
                    q, node = pairs(own, held, q, node)
                    names = {x: np.concatenate((held[x], own[x])) for x in ("rep", "tie", "size")}
                    links = np.concatenate((np.bincount(node, weights=own["size"][q], minlength=m), np.bincount(q, weights=held["size"][node], minlength=len(own["rep"]))))
                    q = q + m
                order = np.lexsort((names["tie"], names["rep"]))
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                low = order[_lowest(len(order), place[q], place[node])[place]]
                linked, child = np.flatnonzero(links), np.flatnonzero(low != np.arange(len(low)))
                name = lambda at: (names["rep"][at], names["tie"][at])  # noqa: E731, B023
                if len(linked):
                    yield _out(batch.schema.field("label").type, name(linked), links=links[linked].astype(np.int64))
                if len(child):
                    yield _out(batch.schema.field("label").type, name(child), root=name(low[child]))

    return run


def _out(label: pa.DataType, node=None, links=None, root=None, audit=None) -> pa.RecordBatch:
    n = 1 if audit else len(node[0])
    pair = pa.struct([("rep", pa.int64()), ("tie", pa.int64())])

    def name(x):
        return pa.nulls(n, pair) if x is None else pa.StructArray.from_arrays([pa.array(y, pa.int64()) for y in x], fields=list(pair))

    where = [audit[0], *[pa.array([x], pa.int64()) for x in audit[1:]]] if audit else [pa.nulls(n, label), *[pa.nulls(n, pa.int64())] * 3]
    return pa.RecordBatch.from_arrays([name(node), pa.nulls(n, pa.int64()) if links is None else pa.array(links, pa.int64()), name(root), *where], names=["node", "links", "root", "label", "shard", "truth", "got"])


def _searched(vectors: DataFrame, scratch: Scratch, least: float, shard: int, recall: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, nodes, found): the rows with usable vectors, distinct vectors of a label, and what searches give."""
    element = getattr(vectors.schema["embedding"].dataType, "elementType", None)
    kind, cast = ("<f4", "float") if isinstance(element, FloatType) else ("<f8", "double")
    vector = F.transform("embedding", lambda x: x.cast(cast))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & good, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long"), "label", F.when(usable, vector).alias("vector"))
    nodes = rows.where("vector is not null").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("vec_id").alias("size"))
    nodes = scratch.save(nodes.withColumns({"dim": F.size("vector"), "tie": F.monotonically_increasing_id()}), "nodes")
    shards = nodes.groupBy("label", "dim").agg(F.ceil(F.count("rep") / shard).cast("int").alias("shards"))
    groups = shards.agg(F.sum(F.col("shards") * F.ceil(F.col("shards") / LANE))).first()[0] or 1
    dealt = nodes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int")).drop("shards")
    label = vectors.schema["label"].dataType.simpleString()
    index = dealt.groupBy("label", "dim", "shard").applyInPandas(_index, f"label {label}, dim int, shard int, rep binary, tie binary, size binary, vectors binary, graph binary")
    index = scratch.save(index, "index")
    last = index.groupBy("label", "dim").agg(F.max("shard").alias("last"))
    lanes = F.sequence(F.floor(F.col("shard") / LANE).cast("int"), F.floor(F.col("last") / LANE).cast("int"))
    loads = index.join(last, ["label", "dim"]).select("label", "dim", "shard", F.explode(lanes).alias("lane"), F.lit(-1).alias("block"), "rep", "tie", "size", "vectors", "graph")
    asks = index.select(
        "label", "dim", F.explode(F.sequence(F.lit(0), F.col("shard"))).alias("to"), F.floor(F.col("shard") / LANE).cast("int").alias("lane"), F.col("shard").alias("block"),
        *[F.when(F.col("to") != F.col("shard"), F.col(x)).alias(x) for x in ("rep", "tie", "size", "vectors")], F.lit(None).cast("binary").alias("graph"),
    )
    work = loads.union(asks).repartition(min(2 * int(groups), 20_000), "label", "dim", "shard", "lane").sortWithinPartitions("label", "dim", "shard", "lane", "block")
    found = work.mapInArrow(_queried(least, recall, kind), f"node {NODE}, links long, root {NODE}, label {label}, shard long, truth long, got long")
    return rows, nodes.withColumn("node", F.struct("rep", "tie")), scratch.save(found, "found")


def near_duplicates(vectors: DataFrame, least: float = 0.93, shard: int = SHARD, recall: float = 0.98) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id (smallest vec_id reachable), kept.

    ``vectors`` has vec_id (integer), embedding (array of numbers) and label. Vectors link if their labels
    are equal and not null and their cosine is at least ``least``. Null or zero vectors, vectors with null
    or non-finite components and rows of null label link with nothing; vectors of different length never
    do. Rows of equal vector and label are copies and link with each other; rows that share a vec_id too are
    rows of their own, and rows that share only the vec_id have links and components of their own. Other
    columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    rows, nodes, found = _searched(vectors, scratch, least, shard, recall)
    placed = components(found.where("root is not null").select(F.col("node").alias("u"), F.col("root").alias("v")), scratch, "components")
    links = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    whole = nodes.join(links, "node", "left").join(placed, "node", "left")
    whole = whole.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "node")["rep"].alias("component"), F.col("size").alias("n"))
    few = hub_size(nodes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    met = join_hubs(rows.where("vector is not null"), whole, ["label", "vector"], few).select("vec_id", "n_links", "component")
    alone = rows.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component"))
    out = met.union(alone).select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.col("component").cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"))
    return scratch.finish(out)


def audited_recall(vectors: DataFrame, least: float = 0.93, shard: int = SHARD, recall: float = 0.98) -> DataFrame:
    """(label, shard, n_true, n_found): of sampled queries, their true pairs with other nodes of each shard and
    those that its graph found, with the beams that ``near_duplicates`` ends with. Shards without true pairs
    have 0 of 0."""
    scratch = Scratch(vectors.sparkSession)
    _, _, found = _searched(vectors, scratch, least, shard, recall)
    return scratch.finish(found.where("truth is not null").groupBy("label", "shard").agg(F.sum("truth").alias("n_true"), F.sum("got").alias("n_found")))
