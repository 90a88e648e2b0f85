"""Geometry queries: WKT parsing, projection, point-in-zone join, centroids."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from kerbflow.functions import geometry as G
from kerbflow.operators import spatial
from kerbflow.plans.registry import register
from kerbflow.plans.standins import POINTS_SQL, ZONE_VERTICES_SQL, points, with_ctes, zones_wkt


def zones(spark, sf_dir):
    return spatial.zones_from_wkt(zones_wkt(spark, sf_dir))


@register("wkt_points", with_ctes(POINTS_SQL, body="SELECT vec_id, x, y FROM pts"))
def q_wkt_points(spark, sf_dir):
    p = points(spark, sf_dir)
    text = F.concat(F.lit("POINT ("), F.col("x").cast("string"), F.lit(" "), F.col("y").cast("string"), F.lit(")"))
    g = G.parse_wkt_point(text)
    return p.select("vec_id", g["x"].alias("x"), g["y"].alias("y"))


def _projection_sql() -> str:
    proj = G.NY_LONG_ISLAND_FTUS
    n, big_f, rho0 = proj.constants()
    e = proj.e
    k = proj.a * big_f / proj.unit
    return with_ctes(POINTS_SQL, f"""ll AS (
  SELECT vec_id, radians(40.7 + y) AS phi, radians(-74.0 + x) AS lam FROM pts)""", f"""pr AS (
  SELECT vec_id,
    {k!r} * pow(tan({math.pi / 4!r} - phi / 2) / pow((1.0 - {e!r} * sin(phi)) / (1.0 + {e!r} * sin(phi)), {e / 2!r}), {n!r}) AS rho,
    {n!r} * (lam - {math.radians(proj.lon0)!r}) AS theta
  FROM ll)""", body=f"""
SELECT vec_id, round({proj.x0!r} + rho * sin(theta), 3) AS x_ft,
       round({proj.y0 + rho0!r} - rho * cos(theta), 3) AS y_ft
FROM pr""")


@register("project_points", _projection_sql())
def q_project_points(spark, sf_dir):
    p = points(spark, sf_dir)
    xy = G.lcc_forward(F.lit(-74.0) + F.col("x"), F.lit(40.7) + F.col("y"))
    return p.select("vec_id", F.round(xy["x"], 3).alias("x_ft"), F.round(xy["y"], 3).alias("y_ft"))


PIP_CTES = ("""cand AS (
  SELECT p.vec_id, s.zone, s.part,
    sum(CASE WHEN ((s.y1 > p.y) <> (s.y2 > p.y))
              AND p.x < (s.x2 - s.x1) * (p.y - s.y1) / (s.y2 - s.y1) + s.x1 THEN 1 ELSE 0 END) AS crossings,
    max(CASE WHEN (s.x2 - s.x1) * (p.y - s.y1) - (s.y2 - s.y1) * (p.x - s.x1) = 0
              AND p.x BETWEEN least(s.x1, s.x2) AND greatest(s.x1, s.x2)
              AND p.y BETWEEN least(s.y1, s.y2) AND greatest(s.y1, s.y2) THEN 1 ELSE 0 END) AS touches
  FROM pts p, zone_segments s GROUP BY 1, 2, 3)""", """inside AS (
  SELECT vec_id, zone FROM cand GROUP BY vec_id, zone
  HAVING max(crossings % 2) = 1 AND max(touches) = 0)""")

PIP_SQL = with_ctes(POINTS_SQL, ZONE_VERTICES_SQL, *PIP_CTES, body="""
SELECT p.vec_id, p.x, p.y, i.zone AS LocationID FROM pts p LEFT JOIN inside i ON p.vec_id = i.vec_id""")


@register("zone_pip_join", PIP_SQL)
def q_zone_pip_join(spark, sf_dir):
    j = spatial.point_in_zone_join(points(spark, sf_dir), zones(spark, sf_dir).select("LocationID", "geom", "bbox"))
    return j.select("vec_id", "x", "y", F.col("LocationID").cast("int").alias("LocationID"))


RING_MOMENTS_SQL = """rm AS (
  SELECT zone, part, ring, sum(x1 * y2 - x2 * y1) AS a2,
         sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS sx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS sy
  FROM zone_segments GROUP BY 1, 2, 3)"""


@register("zone_centroid", with_ctes(ZONE_VERTICES_SQL, RING_MOMENTS_SQL, """wt AS (
  SELECT zone, CASE WHEN ring = 0 THEN 1.0 ELSE -1.0 END * abs(a2) / 2 AS w,
         sx / (a2 * 3.0) AS cx, sy / (a2 * 3.0) AS cy FROM rm WHERE a2 <> 0)""", body="""
SELECT zone AS LocationID, round(sum(w * cx) / sum(w), 9) + 0.0 AS cx, round(sum(w * cy) / sum(w), 9) + 0.0 AS cy
FROM wt GROUP BY zone"""))
def q_zone_centroid(spark, sf_dir):
    c = spatial.zone_centroids(zones(spark, sf_dir))
    return c.select("LocationID", (F.round("cx", 9) + 0.0).alias("cx"), (F.round("cy", 9) + 0.0).alias("cy"))


@register("largest_part", with_ctes(ZONE_VERTICES_SQL, RING_MOMENTS_SQL, """pa AS (
  SELECT zone, part, sum(CASE WHEN ring = 0 THEN 1.0 ELSE -1.0 END * abs(a2) / 2) AS area
  FROM rm GROUP BY 1, 2)""", """best AS (
  SELECT zone, part, area, row_number() OVER (PARTITION BY zone ORDER BY area DESC, part) AS rk FROM pa)""",
    """nv AS (SELECT zone, part, count(*) AS n_vertices FROM zone_vertices WHERE ring = 0 GROUP BY 1, 2)""", body="""
SELECT b.zone AS LocationID, CAST(b.part AS INTEGER) AS part_idx, round(b.area, 12) AS area,
       CAST(nv.n_vertices AS INTEGER) AS n_vertices
FROM best b JOIN nv ON b.zone = nv.zone AND b.part = nv.part WHERE b.rk = 1"""))
def q_largest_part(spark, sf_dir):
    lp = spatial.zone_largest_part(zones(spark, sf_dir))
    return lp.select("LocationID", F.col("part_idx").cast("int").alias("part_idx"),
                     F.round("area", 12).alias("area"), F.size("ring").alias("n_vertices"))
