"""Near-duplicate embeddings and the small-world graph against all pairs."""

import numpy as np
import pytest

from freshet.llm import embedding_dedup, hnsw
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, size int, dim int"


def clusters(rng, n, dim=16):
    centers = rng.normal(size=(8, dim))
    v = centers[rng.integers(0, 8, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.15, 0.6], n)[:, None]
    return v.astype(np.float32)


def all_pairs(rows, least=0.93):
    ids, links = [r[0] for r in rows], {i: 0 for i in range(len(rows))}
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a], rows[b]
            if x[2] is None or x[2] != y[2] or not x[1] or not y[1] or len(x[1]) != len(y[1]) or None in x[1] or None in y[1]:
                continue
            u, v = np.array(x[1], float), np.array(y[1], float)
            if not (np.isfinite(u).all() and np.isfinite(v).all() and u.any() and v.any()):
                continue
            if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= least:
                links[a] += 1
                links[b] += 1
                pairs.append((ids[a], ids[b]))
    return links, brute.union_find(ids, pairs)


@pytest.mark.parametrize("shard", [8192, 60])
def test_all_pairs(spark, shard):
    rng = np.random.default_rng(1)
    v = clusters(rng, 300)
    rows = [(int(i) * 3, [float(x) for x in v[k]], int(k % 2)) for k, i in enumerate(rng.permutation(300))]
    rows += [(2000 + k, rows[0][1], rows[0][2]) for k in range(20)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [1.0, None] + [0.0] * 14, 1), (3004, rows[0][1], None), (3005, [], 1), (3006, [1.0] * 8, 1), (3007, [2.0] * 8, 1), (3008, [float("inf")] + [1.0] * 15, 1)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, shard=shard).collect()}
    links, roots = all_pairs(rows)
    wrong = [r[0] for i, r in enumerate(rows) if (got[r[0]].n_links, got[r[0]].component_id) != (links[i], roots[r[0]])]
    assert len(got) == len(rows) and len(wrong) <= 0.02 * len(rows), wrong
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert got[3006].n_links == 1 and got[2005].n_links >= 20


def test_empty_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 5, "x", 1, 2), (1, [1.0, 0.0], 5, "x", 1, 2), (7, [1.0, 0.01], 5, "x", 1, 2), (None, [1.0, 0.0], 5, "x", 1, 2)], SCHEMA)
    rows = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=str)
    assert rows == sorted([(1, 2, 1, True), (1, 2, 1, True), (7, 2, 1, False), (None, 0, None, True)], key=str)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(3)
    v = clusters(rng, 3000, 32)
    unit = embedding_dedup.unit_rows(v.astype(np.float64)).astype(np.float32)
    graph = hnsw.Graph.build(unit)
    graph = hnsw.Graph.loads(unit, graph.dumps())
    q, node = graph._within(unit, 0.93, 48)
    true = unit @ unit.T >= 0.93
    assert true[q, node].all() and len(q) >= 0.97 * true.sum()
    ids, _ = graph.nearest(unit[:200], 32)
    assert (ids[:, 0] == np.arange(200)).mean() > 0.9


def test_tiny_graphs():
    for n in (1, 2, 3, 5):
        unit = np.eye(8, dtype=np.float32)[:n]
        graph = hnsw.Graph.build(unit)
        q, node, truth, got = graph.within(unit, 0.93)
        assert sorted(zip(q, node)) == [(i, i) for i in range(n)] and truth == got
        assert graph.within(unit, 0.93, own=True)[2:] == (0, 0)


def test_audit_does_not_count_a_node_with_itself():
    """Two of six real pairs lost: the beams have to widen, however many nodes find themselves."""
    rng = np.random.default_rng(5)
    unit = embedding_dedup.unit_rows(rng.normal(size=(1024, 32)))
    for i in range(6):
        unit[64 * i + 1] = unit[64 * i]
    unit = unit.astype(np.float32)
    graph = hnsw.Graph.build(unit)
    beams = []

    def lossy(queries, least, beam, real=graph._within):
        beams.append(beam)
        q, node = real(queries, least, beam)
        lost = (q // 64 < 2) & (q % 64 == 0) & (node == q + 1) if beam < 100 else np.zeros(len(q), bool)
        return q[~lost], node[~lost]

    graph._within = lossy
    _, _, truth, got = graph.within(unit, 0.93, own=True)
    assert len(beams) > 1 and truth == got >= 6


def test_searches_go_through_the_graph(monkeypatch):
    """Scans serve audits only: with the graph's answers taken away, nothing but the last beam finds pairs."""
    rng = np.random.default_rng(6)
    for n in (40, 2000):
        unit = embedding_dedup.unit_rows(clusters(rng, n, 32).astype(np.float64)).astype(np.float32)
        graph = hnsw.Graph.build(unit)
        scanned = []
        graph.scan = lambda queries, least, real=graph.scan, scanned=scanned: (scanned.append(len(queries)), real(queries, least))[1]
        walked = []
        graph.nearest = lambda queries, beam, real=graph.nearest, walked=walked: (walked.append(len(queries)), real(queries, beam))[1]
        q, node = graph._within(unit, 0.93, 48)
        true = unit @ unit.T >= 0.93
        assert walked[0] == n and true[q, node].all() and len(q) >= 0.95 * true.sum()
        if n == 40:
            assert not scanned
        graph.nearest = lambda queries, beam: (np.full((len(queries), beam), -1), np.full((len(queries), beam), -2.0, np.float32))
        assert len(graph._within(unit, 0.93, 48)[0]) == 0


@pytest.mark.parametrize("shard", [8192, 400])
def test_recall_of_registered_parameters(spark, shard):
    """Against all pairs, and as the audit reports it by label and shard, at least 0.9."""
    rng = np.random.default_rng(7)
    v = clusters(rng, 2400, 32)
    rows = [(int(i), [float(x) for x in v[k]], int(k % 2)) for k, i in enumerate(rng.permutation(2400))]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, shard=shard).collect()}
    true = {}
    for label in (0, 1):
        own = [r for r in rows if r[2] == label]
        unit = embedding_dedup.unit_rows(np.array([r[1] for r in own], np.float32).astype(np.float64))
        for r, n in zip(own, (unit @ unit.T >= 0.93).sum(1) - 1):
            true[r[0]] = int(n)
    assert all(got[i] <= true[i] for i in true) and sum(got.values()) >= 0.98 * sum(true.values()) > 0
    audits = embedding_dedup.audited_recall(df, shard=shard).collect()
    assert {(r.label, r.shard) for r in audits} == {(x, s) for x in (0, 1) for s in range(-(-1200 // shard))}
    assert all(r.n_found >= 0.9 * r.n_true for r in audits) and sum(r.n_true for r in audits) > 100


def test_shared_ids_with_different_vectors(spark):
    rows = [(1, [1.0, 0.0], 5), (1, [0.0, 1.0], 5), (2, [1.0, 0.01], 5), (3, [0.01, 1.0], 6), (1, [-1.0, 0.0], 5), (9, [-1.0, 0.01], 5), (1, [1.0, 0.0], 6)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()))
    assert got == sorted([(1, 1, 1, True), (1, 0, 1, True), (2, 1, 1, False), (3, 0, 3, True), (1, 1, 1, True), (9, 1, 1, False), (1, 0, 1, True)])
    links, _ = all_pairs([(10 * i + r[0], *r[1:]) for i, r in enumerate(rows)])
    assert sorted((r[0], links[i]) for i, r in enumerate(rows)) == sorted(r[:2] for r in got)


def test_an_audit_with_pairs_at_the_limit_ends():
    """Products of one pair differ in the last bit with the shape of a block; the widest beam is the end."""
    from freshet.llm.hnsw import Graph

    for seed in range(15):
        unit = np.random.default_rng(seed).standard_normal((40, 16))
        unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)
        graph = Graph.build(unit)
        sims = np.unique((unit @ unit.T)[np.triu_indices(40, 1)])
        for least in (sims[-1], np.nextafter(sims[-1], np.float32(2)), sims[-2]):
            q, node, truth, found = graph.within(unit, float(least), own=True)
            assert found >= 0.98 * truth and len(q) == len(node)
