"""Approximate nearest neighbours against a comparison of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import neighbours, queries


def brute(rows, asked, most=20):
    """{(query id, vector): [(score, id)]} of distinct usable rows (id, vector)."""
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in usable:
        if asked(i):
            near = [(float(neighbours.products(np.array([v]), np.array([w]))[0]), j) for j, w in usable if len(w) == len(v) and (i, v) != (j, w)]
            out[i, v] = sorted(near, key=lambda x: (-x[0], x[1]))[:most]
    return out


def lists(df, name="vec_id"):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r[name], r["score"]))
    return out


def recall(got, want):
    hit = sum(len({i for _, i, _ in got.get(q, [])} & {i for _, i in near}) for (q, _), near in want.items())
    return hit / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_scores_and_order_of_the_query(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 20 == 0)
    got = lists(queries.op13_nearest_neighbours(spark, f"/root/testdata/{sf}"))
    assert recall(got, want) >= 0.93
    by_id = {i: np.array([v], np.float64) for i, v in rows}
    assert set(got) == {q for q, _ in want}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in {i for _, i, _ in found}
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        for _, i, score in found:
            assert score == pytest.approx(float((by_id[q] * by_id[i]).sum()), abs=1e-12)


def test_hard_rows(spark):
    rng = np.random.default_rng(4)
    base = [[float(x) for x in rng.standard_normal(8)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(400)]  # copies
    rows += [(0, base[0]), (0, base[5]), (3, [x * 5 for x in base[3]])]  # repeated row, one id with other vectors
    rows += [(600, None), (601, []), (602, [0.0] * 8), (603, [None, *base[0][1:]]), (604, [math.nan, *base[0][1:]]), (605, [math.inf, *base[0][1:]]), (None, base[1]), (606, base[1][:3]), (607, base[2][:3]), (608, [1e-3] * 8)]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<double>, q string, score int").repartition(3)
    asked = lambda i: i % 3 == 0
    want = brute(rows, asked)
    found = neighbours.nearest(df, F.col("vec_id") % 3 == 0, part=64)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = lists(found)
    assert recall(got, want) >= 0.9
    assert set(got) <= {q for q, _ in want} and got[606] == [(1, 607, want[606, tuple(base[1][:3])][0][0])]
    assert [i for _, i, _ in got[102]][:3] == [0, 100, 101]  # ties among copies go by id, without the query's own row


def test_a_cell_of_many_vectors_is_dealt_over_parts(spark):
    rng = np.random.default_rng(5)
    near = rng.standard_normal(16) + 0.01 * rng.standard_normal((1500, 16))
    far = rng.standard_normal((1500, 16))
    rows = list(enumerate([[float(x) for x in v] for v in np.concatenate((near, far))]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, lambda i: i % 50 == 0)
    whole, split = (lists(neighbours.nearest(df, F.col("vec_id") % 50 == 0, part=p)) for p in (1 << 20, 256))
    assert whole == split and recall(split, want) >= 0.9


def test_empty_tables_and_few_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none, F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(one, F.lit(True)).count() == 0
    two = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, -1.0])], "vec_id long, embedding array<float>")
    assert lists(neighbours.nearest(two, F.lit(True))) == {1: [(1, 2, 1.0)], 2: [(1, 1, 1.0)]}
    assert neighbours.nearest(two, F.lit(False)).count() == 0


def test_cells_grow_until_enough_is_found(spark, monkeypatch):
    """With one visit a table and every true neighbour of the sample wanted, cells end up as large as it takes."""
    monkeypatch.setattr(neighbours, "MOST_CELLS", 1)
    rng = np.random.default_rng(8)
    rows = list(enumerate([[float(x) for x in v] for v in rng.standard_normal((300, 12)) * np.exp(rng.standard_normal((300, 1)))]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, lambda i: i % 3 == 0)
    assert recall(lists(neighbours.nearest(df, F.col("vec_id") % 3 == 0, target=1.0)), want) == 1.0


def test_template_orders_sets_by_expected_cost():
    sets = neighbours.template(4, 40)
    assert sets[0].sum() == 0 and sets[1].tolist() == [1, 0, 0, 0, 0, 0, 0, 0]
    assert len({tuple(r) for r in sets}) == len(sets)
    assert all(not (r[j] and r[7 - j]) for r in sets for j in range(4))  # never both sides of one direction
    cost = np.array([j * (j + 1) / 120 for j in range(1, 5)] + [1 - i / 5 + i * (i + 1) / 120 for i in range(4, 0, -1)])
    assert (np.diff(sets @ cost) >= -1e-9).all()
    assert len(neighbours.template(2, 100)) == 9  # all of 3 ** 2
