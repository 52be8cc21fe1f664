"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors, with a component that brings all to one length, and queries of that length are nearest where their inner
product is largest. Each table hashes them by K projections on Gaussian directions, cut into cells of one width. A query
visits its own cell of every table and then perturbed cells in the order of their estimated success: perturbations are
scored by what the distance to the cell's sides is expected to be by rank, so one template serves all queries.

How many cells a query visits is fitted: for a bounded sample of queries the true neighbours are found by comparing them
with every vector, and as many cells are visited as bring the wanted share of them up. All vectors are indexed, cells
are dealt to parts, and cells of many vectors are dealt over several. A part holds its vectors and streams the
queries past them. The candidates that tables bring up are merged and compared exactly, in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.scratch import Scratch

TABLES = 4
#: Vectors that fit directions and widths, and queries whose true neighbours fit the number of cells.
FIT_VECTORS, FIT_QUERIES = 4096, 128
#: Share of the sample's true neighbours to bring up; most cells that a query visits in a table.
TARGET, MOST_CELLS = 0.95, 512
#: Vectors that a cell holds about, and a part; cells of more than a part are dealt over several (at most so many).
CELL, PART, MOST_DEALT = 128, 16384, 1 << 20
#: Queries compared at once, and best candidates of queries that a task holds before it hands them on.
TOGETHER, HELD_QUERIES = 512, 20_000
SEED = 11
WORK = ["part", "q", "cell", "row", "id", "vector", "cells"]


def template(k: int, most: int) -> np.ndarray:
    """The ``most`` best perturbation sets (rows) over the 2k distances to sides by rank, as 0 or 1; the first is empty.

    The square of the distance of rank j is expected to be j (j + 1) up to a factor for j <= k, and by symmetry
    for the others; sets with both sides of one direction (ranks j and 2k + 1 - j) are left out."""
    cost = [0.0] * (2 * k + 1)
    for j in range(1, 2 * k + 1):
        i = 2 * k + 1 - j
        cost[j] = j * (j + 1) / (4 * (k + 1) * (k + 2)) if j <= k else 1 - i / (k + 1) + i * (i + 1) / (4 * (k + 1) * (k + 2))
    out, heap = [()], [(cost[1], (1,))]
    while heap and len(out) < most:
        sum_, ranks = heapq.heappop(heap)
        if not any(2 * k + 1 - j in ranks for j in ranks):
            out.append(ranks)
        last = ranks[-1]
        if last < 2 * k:
            heapq.heappush(heap, (sum_ - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (sum_ + cost[last + 1], (*ranks, last + 1)))
    rows = np.zeros((len(out), 2 * k), np.int64)
    for r, ranks in enumerate(out):
        rows[r, [j - 1 for j in ranks]] = 1
    return rows


class Hash:
    """Projections of vectors of one length: directions, widths and shifts of all tables."""

    def __init__(self, sample: np.ndarray, k: int, longest: float, tables: int = TABLES, wider: float = 1.0):
        self.centre, self.longest, self.k, self.tables = sample.mean(0), longest, k, tables
        draw = np.random.default_rng(SEED)
        self.directions = draw.standard_normal((sample.shape[1] + 1, tables * k))
        self.width = wider * (2 * float(np.median((self._even(sample) @ self.directions).std(0))) or 1.0)
        self.shift = draw.random(tables * k)
        self.factor = draw.integers(1, 1 << 63, (tables, k), np.int64).astype(np.uint64) | np.uint64(1)

    def _even(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors about the centre, and a component that makes all as long as the longest."""
        moved = vectors - self.centre
        rest = np.sqrt(np.maximum(self.longest**2 - (moved * moved).sum(1), 0))
        return np.concatenate((moved, rest[:, None]), 1)

    def _cells(self, places: np.ndarray) -> np.ndarray:
        whole = np.floor(places).astype(np.int64).reshape(len(places), self.tables, self.k)
        return self._named((whole.astype(np.uint64) * self.factor).sum(2, dtype=np.uint64))

    def _named(self, sums: np.ndarray) -> np.ndarray:
        """Sums of factors as names of cells: different tables, different names."""
        x = sums + np.arange(1, self.tables + 1, dtype=np.uint64)[:, None].reshape((self.tables,) + (1,) * (sums.ndim - 2)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))).view(np.int64)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """(vector, table): the cell of each vector."""
        return self._cells(self._even(vectors) @ self.directions / self.width + self.shift)

    def visits(self, queries: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """(query, table, visit): the cells that queries visit, in the order of ``sets``."""
        even = np.concatenate((queries * (self.longest / np.sqrt((queries * queries).sum(1, keepdims=True))), np.zeros((len(queries), 1))), 1)
        places = (even @ self.directions / self.width + self.shift).reshape(len(queries), self.tables, self.k)
        whole = np.floor(places)
        sides = np.concatenate((1 - (places - whole), places - whole), 2)  # up, down
        rank = np.argsort(np.argsort(sides, axis=2, kind="stable"), axis=2, kind="stable")
        steps = sets.T[rank[:, :, : self.k]] - sets.T[rank[:, :, self.k :]]  # (query, table, direction, visit)
        own = (whole.astype(np.int64).astype(np.uint64) * self.factor).sum(2, dtype=np.uint64)
        return self._named(own[:, :, None] + (steps.astype(np.uint64) * self.factor[None, :, :, None]).sum(2, dtype=np.uint64))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows; equal rows have equal products wherever they stand."""
    return np.add.reduce(queries * vectors, axis=1)


def _best(q: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(scores, ids) of each query's best, ties to the smaller id, without the query itself."""
    rough = q @ vectors.T
    if allowed is not None:
        rough[~allowed] = -np.inf
    wide = min(most + 1, len(ids))
    least = np.partition(rough, len(ids) - wide, axis=1)[:, len(ids) - wide]
    slack = 1e-9 * (np.abs(q).max(1) * np.abs(vectors).max(initial=1) * q.shape[1] + 1)
    row, col = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
    other = (ids[col] != query_ids[row]) | (q[row] != vectors[col]).any(1)
    row, col = row[other], col[other]
    score = products(q[row], vectors[col])
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    ends = np.searchsorted(row, np.arange(len(q) + 1))
    return [(score[a : min(b, a + most)], ids[col[a : min(b, a + most)]]) for a, b in zip(ends[:-1], ends[1:])]


def _lists(keys: list, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    cuts = pa.array(np.cumsum([0, *[len(s) for s, _ in found]]), pa.int32())
    score, ids = (np.concatenate([f[k] for f in found]) if found else np.empty(0) for k in (0, 1))
    lists = [pa.ListArray.from_arrays(cuts, pa.array(score, pa.float64())), pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int64), pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *lists], names=["q", "scores", "ids"])


def _merge(held: dict, key: int, score: np.ndarray, ids: np.ndarray, most: int) -> None:
    if key in held:
        score, ids = np.concatenate((held[key][0], score)), np.concatenate((held[key][1], ids))
        order = np.lexsort((ids, -score))
        score, ids = score[order], ids[order]
        first = np.concatenate(([True], (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])))  # from several tables
        score, ids = score[first], ids[first]
    held[key] = (score[:most], ids[:most])


def _scanned(shared, most: int):
    """The best of all vectors of a task for each query of a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, query_ids, q = shared.value
        held: dict = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            vectors = _matrix(batch.column(1))
            for begin in range(0, len(ids), PART):
                for key, (s, i) in zip(keys, _best(q, query_ids, vectors[begin : begin + PART], ids[begin : begin + PART], None, most)):
                    _merge(held, key, s, i, most)
        if held:
            yield _lists(list(held), list(held.values()))

    return run


def _hashed(shared):
    """A row for every vector and table: cell, row, id, vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_ = shared.value
        for batch in batches:
            cells = hash_.cells(_matrix(batch.column(2)))
            at = pa.array(np.tile(np.arange(batch.num_rows), hash_.tables))
            yield pa.RecordBatch.from_arrays([pa.array(cells.T.ravel()), *[batch.column(k).take(at) for k in range(3)]], names=["cell", "row", "id", "vector"])

    return run


def parts_of(cells: np.ndarray, dealt: np.ndarray, parts: int) -> np.ndarray:
    """The part of each cell, or of each deal of a cell."""
    x = cells.view(np.uint64) + dealt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


def _asked(shared, parts: int):
    """A row for every query and part that holds cells which it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_, sets, hot, deals = shared.value
        for whole in batches:
            for begin in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(begin, TOGETHER)
                cells = hash_.visits(_matrix(batch.column(2)), sets).reshape(batch.num_rows, -1)
                query = np.repeat(np.arange(batch.num_rows), cells.shape[1])
                cells = cells.ravel()
                at = np.minimum(np.searchsorted(hot, cells), max(len(hot) - 1, 0))
                n = np.where(hot[at] == cells, deals[at], 1) if len(hot) else np.ones(len(cells), np.int64)
                query, cells, ends = np.repeat(query, n), np.repeat(cells, n), np.cumsum(n)
                part = parts_of(cells, np.arange(len(cells)) - np.repeat(ends - n, n), parts)
                order = np.lexsort((part, query))
                query, cells, part = query[order], cells[order], part[order]
                first = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (query[1:] != query[:-1]))))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(cells)), pa.int32()), pa.array(cells))
                rows = batch.take(pa.array(query[first]))
                yield pa.RecordBatch.from_arrays([pa.array(part[first]), rows.column(0), *[pa.nulls(len(first), pa.int64())] * 2, rows.column(1), rows.column(2), lists], names=WORK)

    return run


def _searched(most: int):
    """Parts, each with its vectors before its queries: the best candidates of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        part, fresh, ready = None, [], None

        def index():
            """Cells by row, and each row once: where its cells begin, id, vector."""
            cells, rows, ids = (np.concatenate([f[k] for f in fresh]) for k in range(3))
            order = np.argsort(rows, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], np.diff(rows[order]) != 0)))
            return cells[order], first, ids[order][first], np.concatenate([f[3] for f in fresh])[order][first]

        for batch in batches:
            column = batch.column(0).to_numpy()
            is_query = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            change = np.flatnonzero(np.concatenate(([True], (column[1:] != column[:-1]) | (is_query[1:] != is_query[:-1]))))
            for a, b in zip(change, [*change[1:], batch.num_rows]):
                piece = batch.slice(a, b - a)
                if column[a] != part:
                    part, fresh, ready = column[a], [], None
                if not is_query[a]:
                    fresh.append((*[piece.column(k).to_numpy() for k in (2, 3, 4)], _matrix(piece.column(5))))
                    continue
                if not fresh:  # no vector in any cell that is visited here
                    continue
                ready = ready or index()
                for begin in range(0, b - a, TOGETHER):
                    some = piece.slice(begin, TOGETHER)
                    for key, (s, i) in zip(some.column(1).to_pylist(), _of_part(some, *ready, most)):
                        if len(i):
                            _merge(held, key, s, i, most)
                if len(held) > HELD_QUERIES:
                    yield _lists(list(held), list(held.values()))
                    held.clear()
        if held:
            yield _lists(list(held), list(held.values()))

    return run


def _of_part(queries: pa.RecordBatch, cells: np.ndarray, first: np.ndarray, ids: np.ndarray, vectors: np.ndarray, most: int):
    """The best of the vectors whose cell, in any table, each query visits."""
    lists = queries.column(6)
    asked = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    names, of = np.unique(cells, return_inverse=True)
    at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
    hit = names[at] == asked
    visited = np.zeros((len(lists), len(names)), bool)
    visited[row[hit], at[hit]] = True
    out = [(np.empty(0), np.empty(0, np.int64))] * len(lists)
    active = np.flatnonzero(visited.any(1))
    if len(active):
        allowed = np.logical_or.reduceat(visited[active][:, of], first, axis=1)
        some = np.flatnonzero(allowed.any(0))
        q, query_ids = _matrix(queries.column(5))[active], queries.column(4).to_numpy()[active]
        for k, found in zip(active, _best(q, query_ids, vectors[some], ids[some], allowed[:, some], most)):
            out[k] = found
    return out


def _merged(most: int):
    """Lists of the same query (neighbouring rows) made one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for key, s, i in zip(keys, batch.column(1), batch.column(2)):
                _merge(held, key, s.values.to_numpy(), i.values.to_numpy(), most)
            if len(held) > HELD_QUERIES:
                last = {keys[-1]: held.pop(keys[-1])}
                yield _lists(list(held), list(held.values()))
                held = last
        if held:
            yield _lists(list(held), list(held.values()))

    return run


def _reach(hash_: Hash, sets: np.ndarray, queries: np.ndarray, of: np.ndarray, vectors: np.ndarray, target: float) -> int | None:
    """How many sets bring up the wanted share of true neighbours (``vectors`` of the queries ``of``)."""
    first = np.full(len(of), len(sets))
    for begin in range(0, len(queries), 16):
        visits = hash_.visits(queries[begin : begin + 16], sets)
        here = np.flatnonzero((of >= begin) & (of < begin + 16))
        same = visits[of[here] - begin] == hash_.cells(vectors[here])[:, :, None]
        first[here] = np.where(same.any(2), same.argmax(2), len(sets)).min(1)
    need = int(np.ceil(target * len(of)))
    return int(np.sort(first)[need - 1]) + 1 if need and np.sort(first)[need - 1] < len(sets) else None if need else 1


def nearest(vectors: DataFrame, asked, most: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", target: float = TARGET, tables: int = TABLES, part: int = PART) -> DataFrame:
    """(query_id, rank, id, score): for every row where ``asked`` holds, the ``most`` other rows of largest inner product
    that were found, ties to the smaller id.

    ``score`` is the inner product in double precision. Null ids, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part; vectors of different length are not compared. Rows that repeat id and vector are
    one; rows that share only the id are queries, and candidates, of their own. Of rows of one vector only the
    ``most`` + 1 of smallest id can be among the nearest of any query, so only these are indexed. If a query's cells hold
    fewer than ``most`` others, it has fewer rows. Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    vector = F.transform(vector_col, lambda x: x.cast("double"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked")).where(F.col("id").isNotNull() & F.coalesce(good, F.lit(False)))
    rows = rows.groupBy("id", "vector").agg(F.max("asked").alias("asked")).withColumns({"q": F.monotonically_increasing_id(), "dim": F.size("vector")})
    rows = scratch.save(rows, "rows")
    smallest = Window.partitionBy("vector").orderBy("id")
    indexed = scratch.save(rows.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= most + 1).select("dim", F.col("q").alias("row"), "id", "vector"), "indexed")
    found = [_of_length(rows.where(F.col("dim") == d), indexed.where(F.col("dim") == d), scratch, d, most, target, tables, part) for d in (r["dim"] for r in rows.select("dim").distinct().collect())]
    if not found:
        return scratch.finish(spark.createDataFrame([], "query_id long, rank int, vec_id long, score double").withColumnRenamed("vec_id", id_col))
    whole = found[0]
    for other in found[1:]:
        whole = whole.union(other)
    lists = rows.where("asked").select("q", F.col("id").alias("query_id")).join(whole, "q")
    out = lists.select("query_id", F.posexplode(F.arrays_zip("scores", "ids")).alias("place", "x")).select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.ids").alias(id_col), F.col("x.scores").alias("score"))
    return scratch.finish(out)


def _drawn(rows: DataFrame, n: int) -> pa.Table:
    """The first ``n`` by a hash of the vector."""
    return rows.orderBy(F.xxhash64("vector"), "q").limit(n).toArrow()


def _of_length(rows: DataFrame, indexed: DataFrame, scratch: Scratch, dim: int, most: int, target: float, tables: int, part: int) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    queries = rows.where("asked").select("q", "id", "vector")
    sample = _drawn(indexed.select("id", "vector", F.col("row").alias("q")), FIT_VECTORS)
    fit = np.array(sample["vector"].to_pylist(), np.float64)
    from_centre = F.zip_with("vector", F.lit(fit.mean(0).tolist()), lambda x, y: (x - y) * (x - y))
    n, longest = indexed.agg(F.count("id"), F.sqrt(F.max(F.aggregate(from_centre, F.lit(0.0), lambda s, x: s + x)))).first()
    distinct = queries.groupBy("vector").agg(F.min(F.struct("q", "id")).alias("first"))  # copies ask the same
    drawn = _drawn(distinct.select("first.q", "first.id", "vector"), FIT_QUERIES)
    q, q_ids, q_keys = np.array(drawn["vector"].to_pylist(), np.float64).reshape(-1, dim), drawn["id"].to_numpy(), drawn["q"].to_pylist()
    shared = sc.broadcast((q_keys, q_ids, q))
    scans = indexed.select("id", "vector").mapInArrow(_scanned(shared, most), "q long, scores array<double>, ids array<long>")
    pairs = scans.select("q", F.explode(F.arrays_zip("scores", "ids")).alias("x")).select("q", "x.scores", F.col("x.ids").alias("id"))
    best = Window.partitionBy("q").orderBy(F.desc("scores"), "id")
    truth = scratch.save(pairs.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most).select("q", "id").distinct(), f"truth{dim}")
    true = truth.join(indexed.select("id", "vector"), "id").toArrow()
    shared.destroy()
    at = {k: i for i, k in enumerate(q_keys)}
    of, near = np.array([at[k] for k in true["q"].to_pylist()], np.int64), np.array(true["vector"].to_pylist(), np.float64).reshape(-1, dim)
    k = min(24, max(4, round(np.log2(max(n, 2) / CELL))))
    reach, wider = None, 1.0
    while True:  # cells grow with fewer directions, then in width, until those visited hold enough of the true neighbours
        hash_ = Hash(fit, k, longest or 1.0, tables, wider)
        sets = template(k, MOST_CELLS)
        reach = _reach(hash_, sets, q, of, near, target)
        if reach:
            break
        k, wider = (k - 1, wider) if k > 1 else (k, 2 * wider)
    sets = sets[:reach]
    hashed = sc.broadcast(hash_)
    cells = scratch.save(indexed.select("row", "id", "vector").mapInArrow(_hashed(hashed), "cell long, row long, id long, vector array<double>"), f"cells{dim}")
    total = n * tables
    parts = max(1, -(-total // part))
    most_in = max(part // 2, total // MOST_DEALT)
    hot = cells.groupBy("cell").count().where(F.col("count") > most_in).select("cell", F.ceil(F.col("count") / most_in).cast("long").alias("deals")).orderBy("cell").toArrow()
    hot_cells, deals = (hot[x].to_numpy().astype(np.int64) for x in ("cell", "deals"))
    plan = sc.broadcast((hash_, sets, hot_cells, deals))
    work = "part long, q long, cell long, row long, id long, vector array<double>, cells array<long>"
    dealt, asks = cells.mapInArrow(_dealt(plan, parts), work), queries.mapInArrow(_asked(plan, parts), work)
    work = dealt.union(asks).repartition(min(parts, 20_000), "part").sortWithinPartitions("part", F.col("q").isNotNull())
    lists = scratch.save(work.mapInArrow(_searched(most), "q long, scores array<double>, ids array<long>"), f"lists{dim}")
    return lists.repartition("q").sortWithinPartitions("q").mapInArrow(_merged(most), "q long, scores array<double>, ids array<long>")


def _dealt(plan, parts: int):
    """Vectors with the part of their cell; those of a hot cell are dealt over several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, hot, deals = plan.value
        for batch in batches:
            cells, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = np.minimum(np.searchsorted(hot, cells), max(len(hot) - 1, 0))
            n = np.where(hot[at] == cells, deals[at], 1) if len(hot) else np.ones(len(cells), np.int64)
            draw = place.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            deal = ((draw >> np.uint64(32)) % n.astype(np.uint64)).astype(np.int64)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(parts_of(cells, deal, parts)), pa.nulls(rows, pa.int64()), *[batch.column(k) for k in range(4)], pa.nulls(rows, pa.list_(pa.int64()))], names=WORK)

    return run
