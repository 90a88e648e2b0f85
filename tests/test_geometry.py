import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbflow.functions import geometry as G
from kerbflow.operators import spatial

SQUARE_WITH_HOLE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
MULTI = "MULTIPOLYGON (((20 0, 22 0, 22 2, 20 2, 20 0)), ((30 0, 36 0, 36 6, 30 6, 30 0)))"
OVERLAP = "POLYGON ((8 8, 12 8, 12 12, 8 12, 8 8))"


@pytest.fixture(scope="module")
def zones(spark):
    df = spark.createDataFrame([(1, SQUARE_WITH_HOLE), (2, MULTI), (3, OVERLAP)], "LocationID int, wkt string")
    return spatial.zones_from_wkt(df)


def test_within_cases(spark, zones):
    pts = spark.createDataFrame([
        (1, 1.0, 1.0),     # inside zone 1
        (2, 5.0, 5.0),     # in the hole
        (3, 0.0, 5.0),     # on the left edge
        (4, 10.0, 10.0),   # on a vertex of 1, inside 3? (8..12) -> inside 3 only
        (5, 50.0, 50.0),   # outside
        (6, 21.0, 1.0),    # first part of the multipolygon
        (7, 33.0, 3.0),    # second part
        (8, 9.0, 9.0),     # inside 1 and 3 (overlap)
        (9, 10.0, 5.0),    # right edge of 1
    ], "pid int, x double, y double")
    got = {}
    for r in spatial.point_in_zone_join(pts, zones).collect():
        got.setdefault(r["pid"], set()).add(r["LocationID"])
    assert got == {1: {1}, 2: {None}, 3: {None}, 4: {3}, 5: {None}, 6: {2}, 7: {2}, 8: {1, 3}, 9: {None}}


def test_grid_join_equals_brute_force(spark, zones):
    import random
    rnd = random.Random(3)
    pts = spark.createDataFrame([(i, rnd.uniform(-2, 40), rnd.uniform(-2, 14)) for i in range(400)],
                                "pid int, x double, y double")
    grid = {(r["pid"], r["LocationID"]) for r in spatial.point_in_zone_join(pts, zones).collect()}
    z = zones.select("LocationID", "geom").collect()
    brute = set()
    for r in pts.crossJoin(spark.createDataFrame(z)).where(G.within("x", "y", F.col("geom"))).collect():
        brute.add((r["pid"], r["LocationID"]))
    matched = {p for p, zid in grid if zid is not None}
    assert {(p, zid) for p, zid in grid if zid is not None} == brute
    assert {p for p, zid in grid if zid is None} == set(range(400)) - matched


def ring_text(points):
    return "(" + ", ".join(f"{x!r} {y!r}" for x, y in points) + ")"


def star(cx, cy, r, n, seed, squeeze=1.0, low=0.55):
    """A ring of n vertices around a centre, at radii that jump about."""
    rng = random.Random(seed)
    pts = [(cx + squeeze * r * rng.uniform(low, 1.0) * math.cos(2 * math.pi * k / n), cy + r * rng.uniform(low, 1.0) * math.sin(2 * math.pi * k / n))
           for k in range(n)]
    return pts + pts[:1]


def brute(points, rings_by_part):
    """Strictly inside by the definition, over all edges of all parts, in numpy."""
    x, y = np.array(points).T
    inside, touch = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for rings in rings_by_part:
        odd = np.zeros(len(x), bool)
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                if y1 != y2:
                    odd ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
                touch |= (((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0) & (x >= min(x1, x2)) & (x <= max(x1, x2))
                          & (y >= min(y1, y2)) & (y <= max(y1, y2)))
        inside |= odd
    return inside & ~touch


def test_index_equals_brute_force_on_large_rings(spark):
    shapes = {
        1: [[star(0.3, -0.2, 1.0, 10_000, 1, low=0.97)]],                                         # 10,000 vertices
        2: [[star(0.0, 0.0, 2.0, 1000, 2), star(0.1, 0.0, 0.7, 200, 3)]],                         # with a hole
        3: [[star(1.5, 1.5, 0.4, 700, 4)], [star(-1.5, 1.0, 0.05, 40, 5)], [star(1.4, 1.5, 0.3, 60, 6)]],   # parts, overlapping
        4: [[star(1e6 + 3, -1e6, 50.0, 900, 7, squeeze=0.01)]],                                   # thin, far off
        5: [[[(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5), (-0.5, -0.5)]]],                # edges on cell borders
        6: [[star(0.0, 0.0, 100.0, 12, 8)]],                                                      # holds most others
        7: [[[(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]],                      # crosses itself
    }
    wkt = [(k, "MULTIPOLYGON (" + ", ".join("(" + ", ".join(ring_text(r) for r in rings) + ")" for rings in parts) + ")") for k, parts in shapes.items()]
    zones = spatial.zones_from_wkt(spark.createDataFrame(wkt, "LocationID int, wkt string"))
    rng = random.Random(12)
    pts = [(rng.uniform(-2.2, 2.2), rng.uniform(-2.2, 2.2)) for _ in range(1500)] + [(rng.uniform(-1e2, 1e2), rng.uniform(-1e2, 1e2)) for _ in range(200)]
    pts += [(1e6 + 3 + rng.uniform(-1, 1), -1e6 + rng.uniform(-50, 50)) for _ in range(300)]
    pts += [v for k in (1, 3, 5, 7) for parts in shapes[k] for v in parts[0][:60]]                # on vertices
    pts += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(shapes[5][0][0], shapes[5][0][0][1:])]
    pts += [(i / 4, j / 4) for i in range(-8, 9) for j in range(-8, 9)]                           # on cell borders
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid int, x double, y double")
    for max_edges, max_depth in ((12, 9), (3, 2)):
        index = spatial.zone_index(zones, max_edges=max_edges, max_depth=max_depth)
        got = {(r.pid, r.LocationID) for r in spatial.point_in_zone_join(df, zones, index=index).collect()}
        want = {(i, k) for k, parts in shapes.items() for i in np.flatnonzero(brute(pts, parts)).tolist()}
        assert {x for x in got if x[1] is not None} == want, (max_edges, max_depth)
        assert {p for p, _ in got} == set(range(len(pts)))


def test_joined_rows_hold_few_edges_and_inner_cells_none(spark):
    ring = star(0.0, 0.0, 1.0, 10_000, 1, low=0.97)
    zones = spatial.zones_from_wkt(spark.createDataFrame([(1, f"POLYGON ({ring_text(ring)})")], "LocationID int, wkt string"))
    table, levels = spatial.zone_index(zones)
    rows = [leaf for r in table.collect() for leaf in r.found]
    assert len(levels) >= 3 and sum(r.inside for r in rows) > 50
    sizes = sorted(sum(len(p.edges) for p in r.parts) for r in rows)
    assert sizes[len(sizes) // 2] <= 12 and sizes[-1] <= 24


def test_points_without_coordinates_and_zones_without_shape(spark, zones):
    pts = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, float("inf"), 1.0), (4, 1e300, 1.0), (5, 1.0, 1.0)], "pid int, x double, y double")
    got = {r.pid: r.LocationID for r in spatial.point_in_zone_join(pts, zones).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: 1}
    none = zones.where("LocationID < 0")
    assert [r.LocationID for r in spatial.point_in_zone_join(pts, none).collect()] == [None] * 5
    blank = zones.withColumn("geom", F.when(F.lit(False), F.col("geom")))
    assert [r.LocationID for r in spatial.point_in_zone_join(pts, blank).collect()] == [None] * 5


def test_area_centroid_largest_part(spark, zones):
    r = {x["LocationID"]: x for x in spatial.zone_centroids(zones).collect()}
    assert r[1]["cx"] == pytest.approx(5.0) and r[1]["cy"] == pytest.approx(5.0)
    # multipolygon: areas 4 at (21,1) and 36 at (33,3)
    assert r[2]["cx"] == pytest.approx((4 * 21 + 36 * 33) / 40)
    lp = {x["LocationID"]: x for x in spatial.zone_largest_part(zones).collect()}
    assert lp[2]["part_idx"] == 1 and lp[2]["area"] == pytest.approx(36.0)
    assert lp[1]["area"] == pytest.approx(96.0)


def test_wkt_point_and_garbage(spark):
    df = spark.createDataFrame([("POINT (-73.9 40.7)",), ("point(1 2)",), ("LINESTRING (0 0, 1 1)",)], "w string")
    out = [r["p"] for r in df.select(G.parse_wkt_point("w").alias("p")).collect()]
    assert (out[0]["x"], out[0]["y"]) == (-73.9, 40.7)
    assert (out[1]["x"], out[1]["y"]) == (1.0, 2.0)
    assert out[2] is None


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(-74.0, 40.7), (-73.78, 40.64), (-73.95, 40.78)], "lon double, lat double")
    fwd = df.select("lon", "lat", G.lcc_forward("lon", "lat").alias("p"))
    back = fwd.select("lon", "lat", G.lcc_inverse(F.col("p.x"), F.col("p.y")).alias("q"), "p").collect()
    for r in back:
        assert r["q"]["lon"] == pytest.approx(r["lon"], abs=1e-9)
        assert r["q"]["lat"] == pytest.approx(r["lat"], abs=1e-9)
    # on the central meridian the easting is the false easting
    assert back[0]["p"]["x"] == pytest.approx(984250.0, abs=1e-6)
    assert math.isfinite(back[1]["p"]["y"])


def test_wkt_with_z_empty_and_garbage(spark):
    from kerbflow.functions import geometry as G
    texts = {"POLYGON Z ((0 0 5, 2 0 5, 2 2 5, 0 2 5, 0 0 5))": 4.0, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))": 4.0,
             "MULTIPOLYGON ZM (((0 0 1 2, 1 0 1 2, 1 1 1 2, 0 0 1 2)), ((5 5 1 1, 6 5 1 1, 6 6 1 1, 5 5 1 1)))": 0.5,
             "POLYGON EMPTY": None, "MULTIPOLYGON EMPTY": None, "POLYGON ((0 0, 1 x, 1 1, 0 0))": None, "POLYGON ((0 0, 1, 1 1, 0 0))": None,
             "POLYGON": None, "POLYGON (": None, "LINESTRING (0 0, 1 1)": None, "": None, "nonsense": None}
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").withColumn("g", G.parse_wkt_multipolygon("t")).cache()
    got = {r.t: r.a for r in df.select("t", G.polygon_area(F.col("g")[0]).alias("a")).where("t is not null and g is not null").collect()}
    assert got == {t: a for t, a in texts.items() if a is not None}
    pts = {"POINT (1 2)": (1.0, 2.0), "point z (1 2 3)": (1.0, 2.0), "POINT EMPTY": None, "POINT (1)": None, "POINT (a b)": None, "POINT (1e1 -.5)": (10.0, -0.5)}
    rows = spark.createDataFrame([(t,) for t in pts], "t string").select("t", G.parse_wkt_point("t").alias("p")).collect()
    assert {r.t: tuple(r.p) if r.p else None for r in rows} == pts
