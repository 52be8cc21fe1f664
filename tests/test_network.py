import numpy as np
import pytest
from pyspark.errors import PySparkException

from freshet.operators import network as n
from freshet.operators import weights as w
from freshet.streaming import windows

SCHEMA = "region int, river int, next int, index int, k double, x double"
GOOD = [(1, 10, 30, 0, 2.0, 0.2), (1, 20, 30, 1, 2.0, 0.2), (1, 30, -1, 2, 3.0, 0.1), (2, 40, -1, 3, 1.0, 0.0)]


def test_checks(spark):
    checks = n.network_checks(spark.createDataFrame(GOOD, SCHEMA))
    assert n.require(checks).where("ok").count() == 2
    assert {r.n_outlets for r in checks.collect()} == {1}


@pytest.mark.parametrize("row, rule", [((1, 50, 60, 3, 1.0, 0.1), "n_open"), ((1, 50, 10, 3, 1.0, 0.1), "n_unordered"), ((1, 30, -1, 3, 1.0, 0.1), "n_repeated"), ((1, 50, -1, 4, 1.0, 0.1), "n_gaps"), ((1, 50, -1, 3, 0.0, 0.1), "n_invalid"), ((1, 50, -1, 3, 1.0, 0.6), "n_invalid"), ((1, 50, -1, 3, None, 0.1), "n_invalid")])
def test_broken_rules(spark, row, rule):
    checks = n.network_checks(spark.createDataFrame(GOOD[:3] + [row], SCHEMA))
    assert checks.first()[rule] > 0
    with pytest.raises(PySparkException):
        n.require(checks).collect()


def test_spans(spark):
    spans = n.region_spans(spark.createDataFrame(GOOD, SCHEMA))
    assert all(r.covered for r in spans.collect())
    assert not all(r.covered for r in n.region_spans(spark.createDataFrame(GOOD[:3] + [(2, 40, -1, 4, 1.0, 0.0)], SCHEMA)).collect())


def plain_route(rivers, lateral, steps, dt, state=None):
    order = sorted(rivers, key=lambda r: r[3])
    q, up = {}, {r[1]: np.zeros(steps) for r in order}
    for _, river, nxt, _, k, x in order:
        d = 2 * k * (1 - x) + dt
        out, last, before = np.zeros(steps), (state or {}).get(river, 0.0), 0.0
        for t in range(steps):
            last = (dt - 2 * k * x) / d * up[river][t] + (dt + 2 * k * x) / d * before + (2 * k * (1 - x) - dt) / d * last + lateral[river][t]
            before = up[river][t]
            out[t] = last
        q[river] = out
        if nxt in up:
            up[nxt] = up[nxt] + out
    return q


def test_route(spark):
    rng = np.random.default_rng(2)
    lateral = {r[1]: rng.random(6) for r in GOOD}
    inflow = spark.createDataFrame([(r[0], r[1], t, float(lateral[r[1]][t])) for r in GOOD for t in range(6)], "region int, river int, step int, inflow double")
    routed = n.route(inflow, spark.createDataFrame(GOOD, SCHEMA))
    want = plain_route(GOOD, lateral, 6, 1.0)
    for r in routed.collect():
        assert r.q == pytest.approx(want[r.river][r.step])


def test_years_carry_state(spark):
    rivers = spark.createDataFrame(GOOD, SCHEMA)
    one = lambda year: spark.createDataFrame([(r[0], r[1], t, 1.0) for r in GOOD for t in range(3)], "region int, river int, step int, inflow double")
    saved = {}

    def save(year, what, df):
        saved[year, what] = spark.createDataFrame(df.collect(), df.schema)
        return saved[year, what]

    windows.route_years([1, 2, 3], one, rivers, save, warm_up=1)
    assert (1, "discharge") not in saved and {(2, "discharge"), (3, "discharge"), (3, "state")} <= set(saved)
    first = {r.river: r.q for r in saved[2, "state"].collect()}
    again = n.route(one(3), rivers, state=saved[2, "state"])
    flows = [sorted((r.river, r.step, round(r.q, 9)) for r in df.collect()) for df in (again, saved[3, "discharge"])]
    assert flows[0] == flows[1] and len(first) == 4


def test_proportions_sum_to_one(spark):
    pieces = spark.createDataFrame([(r, c, float(r * c + 1)) for r in range(3) for c in range(5)] + [(0, 9, 0.0)], "river int, cell int, area double")
    rows = w.proportions(pieces).groupBy("river").sum("proportion").collect()
    assert [r[1] for r in rows] == pytest.approx([1.0] * 3, abs=1e-6)
    assert w.proportions(pieces).where("cell = 9").count() == 0


def test_overlap_equals_all_pairs(spark):
    rng = np.random.default_rng(8)

    def boxes(k):
        a = rng.random((k, 2)) * 20
        b = a + rng.random((k, 2)) * 5
        return [(i, *map(float, (*a[i], *b[i]))) for i in range(k)]

    one, two = boxes(40), boxes(60)
    schema = "id int, west double, south double, east double, north double"
    got = {(r.box, r.cell): r.area for r in w.overlaps(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), 3.0).collect()}
    want = {}
    for a in one:
        for b in two:
            dx, dy = min(a[3], b[3]) - max(a[1], b[1]), min(a[4], b[4]) - max(a[2], b[2])
            if dx > 0 and dy > 0:
                want[a[0], b[0]] = dx * dy
    assert got == pytest.approx(want)


def test_octahedral(spark):
    from pyspark.sql import functions as F

    good, bad = [20, 24, 28, 28, 24, 20], [20, 24, 28, 27, 24, 20]
    rows = spark.createDataFrame([(good,), (bad,)], "n array<int>").select(w.octahedral(F.col("n")).alias("o")).collect()
    assert [r.o for r in rows] == [True, False]


def saver(tmp_path):
    def save(df, name):
        path = f"{tmp_path}/{name}"
        df.write.mode("error").parquet(path)
        return df.sparkSession.read.parquet(path)

    return save


def test_a_long_chain_takes_few_rounds(spark, tmp_path):
    size = 10_000
    chain = spark.range(size).selectExpr("id river", f"if(id = {size - 1}, -1, id + 1) next", "cast(id as double) area")
    sums, cycles, rounds = n.upstream_sums(chain, saver(tmp_path))
    assert rounds <= 15 and cycles.count() == 0 and sums.count() == size
    assert sums.where("n_upstream <> river + 1 or area <> river * (river + 1) / 2").count() == 0


def test_trees_stars_and_cycles(spark, tmp_path):
    rng = np.random.default_rng(3)
    parent = {i: (-1 if i == 0 else int(rng.integers(0, i))) for i in range(300)}
    parent |= {1000 + i: 0 for i in range(500)}  # a star
    parent |= {2000: 2001, 2001: 2002, 2002: 2000, 2003: 2001, 2004: 2003, 2010: 2010, 2020: 9999, 2021: 2020}  # cycles; an outlet that is not there
    area = {r: None if r == 5 else float(r % 7) for r in parent}
    want, endless = {r: [0.0, 0] for r in parent}, set()
    for r in parent:
        path, at = [], r
        while at in parent and at not in path:
            path.append(at)
            at = parent[at]
        if at in parent:
            endless.add(r)
        for x in set(path):
            want[x][0] += area[r] or 0.0
            want[x][1] += 1
    df = spark.createDataFrame([(r, p, area[r], "x") for r, p in parent.items()], "river long, next long, area double, jump string")
    sums, cycles, _ = n.upstream_sums(df, saver(tmp_path / "sums"))
    got = {r.river: (r.area, r.n_upstream) for r in sums.collect()}
    assert {r.river for r in cycles.collect()} == endless == {2000, 2001, 2002, 2003, 2004, 2010}
    assert got == {r: tuple(x) for r, x in want.items() if r not in endless}
    assert sorted(map(tuple, n.cycles(df, saver(tmp_path / "cycles")).collect())) == [(2000, 2000), (2001, 2000), (2002, 2000), (2010, 2010)]
    none = df.limit(0)
    assert n.upstream_sums(none, saver(tmp_path / "none"))[0].count() == 0 and n.cycles(none, saver(tmp_path / "none2")).count() == 0


def test_places_number_rows_over_ranges(spark):
    keys = [int(x) for x in np.random.default_rng(1).permutation(5000) * 3]
    got = {r.key: r.place for r in n.places(spark.createDataFrame([(k,) for k in keys], "key long"), "key", 7).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    assert n.places(spark.createDataFrame([], "key long"), "key").count() == 0
