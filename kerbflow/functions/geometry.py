"""Planar geometry as Catalyst expressions.

Representation: a point is ``STRUCT<x DOUBLE, y DOUBLE>``; a ring is an array
of points whose last point repeats the first; a polygon is an array of rings
(outer first, then holes); every areal geometry is carried as a multipolygon
``ARRAY<ARRAY<ARRAY<STRUCT<x,y>>>>`` (parts -> rings -> points).

Spark 4.1 has no containment predicate, so the tests are folds over ring
segments with ``aggregate`` / ``exists`` (no Python in the data path).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(x, y) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


# ---------------------------------------------------------------- WKT parsing

def _number(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i)).try_cast("double")


def _parse_coords(text: Column) -> Column:
    """'x y, x y, ...' -> array<struct<x,y>>; further values of a place (z, m) are left out."""
    pts = F.split(F.trim(text), r"\s*,\s*")
    return F.transform(pts, lambda p: F.struct(_number(F.split(F.trim(p), r"\s+"), 0).alias("x"),
                                               _number(F.split(F.trim(p), r"\s+"), 1).alias("y")))


# A WKT tag: the kind, an optional z/m mark, and what follows.
_TAG = r"^\s*{}\s*(?:ZM|Z|M)?\s*(\(.*\))\s*$"
_NUM = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"


def parse_wkt_point(c) -> Column:
    """'POINT (x y)', also with z and m values -> struct<x,y>; anything else (EMPTY too) -> null."""
    rx = rf"(?i)^\s*POINT\s*(?:ZM|Z|M)?\s*\(\s*{_NUM}\s+{_NUM}(?:\s+{_NUM}){{0,2}}\s*\)\s*$"
    x, y = (F.regexp_extract(_col(c), rx, i).try_cast("double") for i in (1, 2))
    return F.when(x.isNotNull() & y.isNotNull(), point(x, y))


def parse_wkt_multipolygon(c) -> Column:
    """POLYGON or MULTIPOLYGON WKT, also with z and m values -> parts/rings/points.

    Null for other kinds, for EMPTY, and for text with any place that isn't two
    numbers: a geometry with missing vertices would have a wrong area.
    """
    t = F.trim(F.upper(_col(c)))
    multi = F.regexp_extract(t, _TAG.format("MULTIPOLYGON"), 1)
    single = F.regexp_extract(t, _TAG.format("POLYGON"), 1)
    body = F.when(multi != "", multi).otherwise(F.concat(F.lit("("), single, F.lit(")")))
    inner = F.regexp_replace(body, r"^\(\s*\(\s*\(|\)\s*\)\s*\)$", "")
    geom = F.transform(F.split(inner, r"\)\s*\)\s*,\s*\(\s*\("),
                       lambda part: F.transform(F.split(part, r"\)\s*,\s*\("), _parse_coords))
    whole = F.forall(F.flatten(F.flatten(geom)), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    return F.when(((multi != "") | (single != "")) & whole, geom)


# ------------------------------------------------------------ ring arithmetic

def _seg_fold(ring: Column, init, fn) -> Column:
    """Fold ``fn(acc, a, b)`` over consecutive vertex pairs of a ring."""
    n = F.size(ring)
    return F.aggregate(
        F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), init,
        lambda acc, i: F.when(i < n - 1, fn(acc, F.get(ring, i), F.get(ring, i + 1))).otherwise(acc))


def ring_cross_sum(ring: Column) -> Column:
    """Twice the signed area (shoelace)."""
    return _seg_fold(ring, F.lit(0.0), lambda acc, a, b: acc + (a["x"] * b["y"] - b["x"] * a["y"]))


def ring_parity(px: Column, py: Column, ring: Column) -> Column:
    """Crossing-number parity of a horizontal ray from (px, py)."""
    def step(acc, a, b):
        crosses = ((a["y"] > py) != (b["y"] > py)) & \
            (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"])
        return acc != crosses
    return _seg_fold(ring, F.lit(False), step)


def ring_touches(px: Column, py: Column, ring: Column) -> Column:
    """True when the point lies on a segment of the ring (exact test)."""
    def step(acc, a, b):
        cross = (b["x"] - a["x"]) * (py - a["y"]) - (b["y"] - a["y"]) * (px - a["x"])
        inside_box = (px >= F.least(a["x"], b["x"])) & (px <= F.greatest(a["x"], b["x"])) & \
            (py >= F.least(a["y"], b["y"])) & (py <= F.greatest(a["y"], b["y"]))
        return acc | ((cross == 0.0) & inside_box)
    return _seg_fold(ring, F.lit(False), step)


def covers(px, py, geom) -> Column:
    """Even-odd rule per part (holes subtract), any part counts; boundary included
    only as the half-open crossing rule decides."""
    px, py, geom = _col(px), _col(py), _col(geom)
    return F.exists(geom, lambda part: F.aggregate(
        part, F.lit(False), lambda acc, ring: acc != ring_parity(px, py, ring)))


def on_boundary(px, py, geom) -> Column:
    px, py, geom = _col(px), _col(py), _col(geom)
    return F.exists(geom, lambda part: F.exists(part, lambda ring: ring_touches(px, py, ring)))


def within(px, py, geom) -> Column:
    """Point strictly inside the (multi)polygon: boundary points are excluded."""
    return covers(px, py, geom) & ~on_boundary(px, py, geom)


def bbox(geom) -> Column:
    """struct(minx, miny, maxx, maxy) over every vertex."""
    pts = F.flatten(F.flatten(_col(geom)))
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                    F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def _ring_moments(ring: Column) -> Column:
    """struct(a2, sx, sy): shoelace sum and first moments of one ring."""
    def step(acc, a, b):
        cr = a["x"] * b["y"] - b["x"] * a["y"]
        return F.struct((acc["a2"] + cr).alias("a2"),
                        (acc["sx"] + (a["x"] + b["x"]) * cr).alias("sx"),
                        (acc["sy"] + (a["y"] + b["y"]) * cr).alias("sy"))
    zero = F.struct(F.lit(0.0).alias("a2"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))
    return _seg_fold(ring, zero, step)


def polygon_area(part) -> Column:
    """Area of one polygon: outer ring minus holes."""
    part = _col(part)
    return F.aggregate(
        F.transform(part, lambda ring, j: F.when(j == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
                    * F.abs(ring_cross_sum(ring)) / 2.0),
        F.lit(0.0), lambda acc, a: acc + a)


def area(geom) -> Column:
    return F.aggregate(F.transform(_col(geom), polygon_area), F.lit(0.0), lambda acc, a: acc + a)


def centroid(geom) -> Column:
    """Area-weighted centroid over parts and rings (holes weigh negative)."""
    rings = F.flatten(F.transform(_col(geom), lambda part: F.transform(
        part, lambda ring, j: F.struct(
            F.when(j == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("s"),
            _ring_moments(ring).alias("m")))))
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"))

    def add(acc, r):
        a2 = r["m"]["a2"]
        w = r["s"] * F.abs(a2) / 2.0
        return F.struct((acc["w"] + w).alias("w"),
                        (acc["wx"] + w * r["m"]["sx"] / (a2 * 3.0)).alias("wx"),
                        (acc["wy"] + w * r["m"]["sy"] / (a2 * 3.0)).alias("wy"))
    tot = F.aggregate(F.filter(rings, lambda r: r["m"]["a2"] != 0.0), zero, add)
    return F.struct((tot["wx"] / tot["w"]).alias("x"), (tot["wy"] / tot["w"]).alias("y"))


def largest_part(geom) -> Column:
    """struct(idx, area, ring) of the part with the largest area; ring = its outer ring."""
    g = _col(geom)
    scored = F.transform(g, lambda part, i: F.struct(
        polygon_area(part).alias("area"), (-i).alias("neg_idx"), part.getItem(0).alias("ring")))
    best = F.array_max(scored)   # largest area, first index on ties
    return F.struct((-best["neg_idx"]).alias("idx"), best["area"].alias("area"), best["ring"].alias("ring"))


# ----------------------------------------------------------------- projection

@dataclass(frozen=True)
class LambertConformalConic:
    """Ellipsoidal Lambert conformal conic, two standard parallels (Snyder 1987)."""
    a: float
    inv_f: float
    lat1: float
    lat2: float
    lat0: float
    lon0: float
    x0: float        # false easting, output units
    y0: float        # false northing, output units
    unit: float      # metres per output unit

    @property
    def e(self) -> float:
        f = 1.0 / self.inv_f
        return math.sqrt(2 * f - f * f)

    def _m(self, phi):
        e = self.e
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def _t(self, phi):
        e = self.e
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    def constants(self):
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        m1, m2 = self._m(p1), self._m(p2)
        t1, t2, t0 = self._t(p1), self._t(p2), self._t(p0)
        n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        big_f = m1 / (n * t1 ** n)
        rho0 = self.a * big_f * t0 ** n / self.unit
        return n, big_f, rho0


# NAD83 / New York Long Island (US survey feet), GRS80 ellipsoid.
NY_LONG_ISLAND_FTUS = LambertConformalConic(
    a=6378137.0, inv_f=298.257222101,
    lat1=41.0 + 2.0 / 60.0, lat2=40.0 + 40.0 / 60.0, lat0=40.0 + 10.0 / 60.0, lon0=-74.0,
    x0=984250.0, y0=0.0, unit=1200.0 / 3937.0)


def lcc_forward(lon, lat, proj: LambertConformalConic = NY_LONG_ISLAND_FTUS) -> Column:
    """(lon, lat) degrees -> struct(x, y) in the projection's units."""
    n, big_f, rho0 = proj.constants()
    e = proj.e
    phi = F.radians(_col(lat))
    lam = F.radians(_col(lon))
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2))
    rho = F.lit(proj.a * big_f / proj.unit) * F.pow(t, F.lit(n))
    theta = F.lit(n) * (lam - F.lit(math.radians(proj.lon0)))
    return F.struct((F.lit(proj.x0) + rho * F.sin(theta)).alias("x"),
                    (F.lit(proj.y0 + rho0) - rho * F.cos(theta)).alias("y"))


def lcc_inverse(x, y, proj: LambertConformalConic = NY_LONG_ISLAND_FTUS, iterations: int = 6) -> Column:
    """struct(x, y) in projection units -> struct(lon, lat) degrees."""
    n, big_f, rho0 = proj.constants()
    e = proj.e
    dx = _col(x) - F.lit(proj.x0)
    dy = F.lit(rho0) - (_col(y) - F.lit(proj.y0))
    rho = F.sqrt(dx * dx + dy * dy) * F.lit(1.0 if n > 0 else -1.0)
    theta = F.atan2(dx, dy) if n > 0 else F.atan2(-dx, -dy)
    t = F.pow(rho * F.lit(proj.unit) / F.lit(proj.a * big_f), F.lit(1.0 / n))
    phi = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(iterations):
        es = F.lit(e) * F.sin(phi)
        phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2)))
    lam = theta / F.lit(n) + F.lit(math.radians(proj.lon0))
    return F.struct(F.degrees(lam).alias("lon"), F.degrees(phi).alias("lat"))
