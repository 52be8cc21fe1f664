"""Well-known binary: round trips, byte orders, heights, faults, bounded batches."""

import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from freshet.sources import geometry as g

RINGS = f"river long, rings {g.RINGS}, note string"


def ring(rng, n):
    return [tuple(map(float, p)) for p in rng.normal(size=(n, 2))]


def wkb(polygons, order="<", z=False, m=False, extended=False, srid=None, multi=None):
    """Written out by the definition; polygons are lists of rings of (x, y)."""
    extra = z + m

    def head(kind):
        code = kind + (1000 * z + 2000 * m if not extended else 0)
        if extended:
            code |= (g.HAS_Z if z else 0) | (g.HAS_M if m else 0) | (g.HAS_SRID if srid is not None else 0)
        return struct.pack(order + "BI", order == "<", code) + (struct.pack(order + "I", srid) if extended and srid is not None else b"")

    def body(rings):
        return struct.pack(order + "I", len(rings)) + b"".join(struct.pack(order + "I", len(r)) + b"".join(struct.pack(f"{order}{2 + extra}d", *p, *[9.0] * extra) for p in r) for r in rings)

    if multi is None and len(polygons) == 1:
        return head(3) + body(polygons[0])
    return head(6) + struct.pack(order + "I", len(polygons)) + b"".join(head(3) + body(p) for p in polygons)


def plain(polygons):
    return [(k > 0, r[:-1] if len(r) > 1 and r[0] == r[-1] else r) for p in polygons for k, r in enumerate(p)]


def listed(column):
    return [None if x is None else [(r["hole"], [(p["x"], p["y"]) for p in r["points"]]) for r in x] for x in column.to_pylist()]


def test_every_form(spark):
    rng = np.random.default_rng(1)
    closed = lambda n: (lambda r: r + r[:1])(ring(rng, n))
    shapes = [[[closed(4)]], [[closed(5), closed(3), closed(3)]], [[closed(3)], [closed(4), closed(3)], [closed(6)]], [], [[]], [[[]]], [[ring(rng, 1)]]]
    forms, want = [], []
    for shape in shapes:
        for options in ({}, {"order": ">"}, {"z": True}, {"z": True, "m": True, "order": ">"}, {"extended": True, "z": True, "srid": 3857}, {"extended": True, "m": True}, {"multi": True}):
            forms.append(wkb(shape, **options))
            want.append(plain(shape))
    assert listed(g.decoded(pa.array([None, *forms, None], pa.binary()))) == [None, *want, None]
    assert listed(g.decoded(pa.array([None, *forms], pa.binary()).slice(3, 5))) == want[2:7]
    assert listed(g.decoded(pa.array([], pa.binary()))) == [] and listed(g.decoded(pa.array([None], pa.binary()))) == [None]


@pytest.mark.parametrize("bad", [b"", b"\x01\x03", wkb([[[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]]])[:-1], struct.pack("<BIdd", 1, 1, 0.0, 0.0), struct.pack("<BII", 1, 6, 1) + struct.pack("<BIdd", 1, 1, 0.0, 0.0)])
def test_faults_are_errors(spark, bad):
    with pytest.raises(ValueError):
        g.decoded(pa.array([wkb([[[(0.0, 0.0)]]]), bad], pa.binary()))
    with pytest.raises(PySparkException):
        g.with_rings(spark.createDataFrame([(1, bytearray(bad))], "river long, geometry binary"), "geometry").collect()


def test_another_reference_system_is_an_error(spark):
    shape = [[[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]]]
    rows = [wkb(shape, extended=True, srid=3857), wkb(shape), wkb(shape, order=">", extended=True, srid=3857)]
    assert listed(g.decoded(pa.array(rows), 3857)) == [plain(shape)] * 3
    with pytest.raises(ValueError, match="4326 in place of 3857"):
        g.decoded(pa.array([*rows, wkb(shape, order=">", extended=True, srid=4326)]), 3857)
    assert listed(g.decoded(pa.array([wkb(shape, extended=True, srid=4326)]))) == [plain(shape)]


def test_round_trip_in_bounded_batches(spark):
    rng = np.random.default_rng(2)
    rows = [(i, None if i % 50 == 0 else [(False, ring(rng, 3 + i % 9))] + [(True, ring(rng, 3))] * (i % 3) + [(False, ring(rng, 4))] * (i % 4), "x") for i in range(700)]
    df = spark.createDataFrame(rows, RINGS)
    want = {r.river: r.rings for r in df.collect()}
    binary = g.with_binary(df)
    assert binary.columns == ["river", "note", "geometry"]
    for n, size in ((g.BATCH_ROWS, g.BATCH_BYTES), (7, 1 << 20), (1000, 500)):
        assert {r.river: r.rings for r in g.with_rings(binary, "geometry", rows=n, size=size).collect()} == want
    sizes = [b.num_rows for b in g.bounded([pa.RecordBatch.from_arrays([pa.array([b"x" * k for k in (10, 10, 10, 50, 1, 1, 1)])], names=["a"])], 0, rows=2, size=25)]
    assert sizes == [2, 1, 1, 2, 1]
