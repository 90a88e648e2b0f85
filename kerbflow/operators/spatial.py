"""Point-in-zone join by a cell-and-edge index.

Every zone gets a quadtree of its own. Cells are squares whose side is a power of
two, so that a point's cell is exact; the tree starts at about the zone's size and
splits a cell while many edges meet it. A leaf without edges lies inside (it is
kept, and its points need no test) or outside (it is dropped). A leaf with
edges keeps only those, and what the rest of the zone adds to the count of
crossings to the right: a parity, and the heights at which it changes, which are
those of the kept edges' ends to the right of the cell.

A point joins the leaves of its cell at each level in use by an equi join; no
geometry of a whole zone is in a joined row. A point inside several (overlapping)
zones yields one row per zone; a point in none keeps one row with a null zone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions import geometry as G
from kerbflow.session import checkpoint_root, scratch_path

MAX_EDGES = 12          # a leaf with more is split
MAX_DEPTH = 9           # times; edges that meet in one point can't be told apart by splitting
SPLIT = 2               # a split halves the sides so often: levels differ by it, so that zones share them


def zones_from_wkt(df: DataFrame, id_col: str = "LocationID", wkt_col: str = "wkt",
                   materialize: bool = True) -> DataFrame:
    """Parse zone WKT once. The zone table is dimension-sized; it is written
    to the checkpoint folder so later expressions read a column instead of
    re-inlining the parser into each of them."""
    parsed = df.withColumn("geom", G.parse_wkt_multipolygon(F.col(wkt_col)))
    if materialize:
        checkpoint_root(df.sparkSession)
        parsed = parsed.checkpoint(eager=True)
    out = parsed.withColumn("bbox", G.bbox("geom"))
    return out.checkpoint(eager=True) if materialize else out


# -- the index -------------------------------------------------------------------------------------------------

PART = "struct<odd:boolean,heights:array<double>,edges:array<struct<x1:double,y1:double,x2:double,y2:double>>>"


def _crossings(edges, x: float, y: float) -> int:
    """Edges that a ray from (x, y) to the right crosses; the rule of ``geometry.ring_parity``."""
    x1, y1, x2, y2 = edges.T
    e = edges[(y1 > y) != (y2 > y)]
    return int((x < (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0]).sum())


def _parity(part, x: float, y: float) -> bool:
    edges, odd, heights = part
    return bool((_crossings(edges, x, y) + int((heights > y).sum()) + odd) % 2)


def _meeting(edges, box, slack: float):
    """Edges that meet the box widened by ``slack`` (some more do no harm)."""
    import numpy as np
    x0, y0, x1, y1 = box[0] - slack, box[1] - slack, box[2] + slack, box[3] + slack
    ax, ay, bx, by = edges.T
    near = (np.maximum(ax, bx) >= x0) & (np.minimum(ax, bx) <= x1) & (np.maximum(ay, by) >= y0) & (np.minimum(ay, by) <= y1)
    edges = edges[near]
    ax, ay, bx, by = edges.T
    side = lambda px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)         # noqa: E731
    corners = [side(px, py) for px in (x0, x1) for py in (y0, y1)]
    return edges[(np.minimum.reduce(corners) <= 0) & (np.maximum.reduce(corners) >= 0)]


def _inner(part, box, slack: float):
    """The part of a zone as a box within its own sees it: (edges, parity, heights)."""
    import numpy as np
    edges = _meeting(part[0], box, slack)
    # Beyond the box, edges that are left out only matter where they end at one that is kept.
    ends = np.concatenate([edges[:, :2], edges[:, 2:]])
    right = ends[(ends[:, 0] > box[2]) & (ends[:, 1] >= box[1] - slack) & (ends[:, 1] <= box[3] + slack), 1]
    heights, n = np.unique(right, return_counts=True)
    out = [edges, False, heights[n % 2 == 1]]
    x, y = (box[0] + box[2]) / 2, (box[1] + box[3]) / 2
    out[1] = _parity(out, x, y) != _parity(part, x, y)
    return out


def leaves(parts, max_edges: int = MAX_EDGES, max_depth: int = MAX_DEPTH):
    """(level, cx, cy, inside, parts) of the leaves of one zone; ``parts`` are arrays of edges (x1, y1, x2, y2)."""
    import numpy as np
    every = np.concatenate(parts) if parts else np.zeros((0, 4))
    if not len(every) or not np.isfinite(every).all():
        return
    xs, ys = every[:, ::2], every[:, 1::2]
    extent = max(xs.max() - xs.min(), ys.max() - ys.min())
    reach = float(np.abs(every).max())
    level = SPLIT * math.ceil(math.log2(extent or reach or 1.0) / SPLIT)
    side = 2.0 ** level
    whole = [[e, False, np.zeros(0)] for e in parts]
    todo = [(level, i, j, 0, whole) for i in range(math.floor(xs.min() / side), math.floor(xs.max() / side) + 1)
            for j in range(math.floor(ys.min() / side), math.floor(ys.max() / side) + 1)]
    while todo:
        level, i, j, depth, above = todo.pop()
        side = 2.0 ** level
        box = (i * side, j * side, (i + 1) * side, (j + 1) * side)
        here = [_inner(p, box, side * 1e-9 + reach * 1e-13) for p in above]
        here = [p for p in here if len(p[0]) or p[1]]
        n = sum(len(p[0]) for p in here)
        if n == 0:
            if here:
                yield level, i, j, True, []
        elif n <= max_edges or depth == max_depth:
            yield level, i, j, False, here
        else:
            k = 1 << SPLIT
            todo += [(level - SPLIT, i * k + a, j * k + b, depth + 1, here) for a in range(k) for b in range(k)]


def _zone_leaves(zones: DataFrame, id_col: str, max_edges: int, max_depth: int) -> DataFrame:
    """(zone, level, cx, cy, inside, parts) of all zones, each zone's tree built in one task."""
    import pyarrow as pa

    def build(batches):
        import numpy as np
        for b in batches:
            for r in range(b.num_rows):
                geom = b.column("geom").slice(r, 1)
                if geom.null_count:
                    continue
                rings = geom.flatten()                                  # of each part
                points = rings.flatten()                                # of each ring
                xy = np.column_stack([points.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("x", "y")])
                ring = np.concatenate([[0], np.cumsum(np.diff(points.offsets.to_numpy()))])
                part = np.concatenate([[0], np.cumsum(np.diff(rings.offsets.to_numpy()))])
                edges = [[np.hstack([xy[a:e - 1], xy[a + 1:e]]) for a, e in zip(ring[p:q], ring[p + 1:q + 1])] for p, q in zip(part, part[1:])]
                found = list(leaves([np.concatenate(x) for x in edges if x], max_edges, max_depth))
                shape = lambda p: {"odd": p[1], "heights": p[2], "edges": [dict(zip(("x1", "y1", "x2", "y2"), e)) for e in p[0].tolist()]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("zone")[r].as_py()] * len(found), b.schema.field("zone").type),
                     *(pa.array([f[k] for f in found], t) for k, t in ((0, pa.int32()), (1, pa.int64()), (2, pa.int64()), (3, pa.bool_()))),
                     pa.array([[shape(p) for p in f[4]] for f in found], part_type)],
                    names=["zone", "level", "cx", "cy", "inside", "parts"])

    edge = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
    part_type = pa.list_(pa.struct([("odd", pa.bool_()), ("heights", pa.list_(pa.float64())), ("edges", pa.list_(edge))]))
    rows = zones.select(F.col(id_col).alias("zone"), "geom")
    return rows.mapInArrow(build, f"zone {dict(rows.dtypes)['zone']}, level int, cx long, cy long, inside boolean, parts array<{PART}>")


def zone_index(zones: DataFrame, id_col: str = "LocationID", max_edges: int = MAX_EDGES, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, list[int]]:
    """((level, cx, cy, found), the levels in use): the leaves of all zones by cell, as a written table by level."""
    spark = zones.sparkSession
    cells = _zone_leaves(zones, id_col, max_edges, max_depth).groupBy("level", "cx", "cy").agg(
        F.collect_list(F.struct("zone", "inside", "parts")).alias("found"))         # as many as zones overlap there
    path = scratch_path(spark, "zone-index")
    cells.write.partitionBy("level").parquet(path)
    table = spark.read.schema(cells.schema).parquet(path)
    return table, sorted(r["level"] for r in table.select("level").distinct().collect())


def _part_holds(px, py, part):
    def cross(e):
        return ((e["y1"] > py) != (e["y2"] > py)) & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
    odd = F.aggregate(part["edges"], part["odd"], lambda acc, e: acc != cross(e))
    return F.aggregate(part["heights"], odd, lambda acc, h: acc != (h > py))


def _part_touches(px, py, part):
    def on(e):
        cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
        return ((cross == 0.0) & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
                & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))
    return F.exists(part["edges"], on)


def leaf_holds(px, py, leaf):
    """Whether a leaf's zone holds a point of the leaf's cell strictly inside."""
    return leaf["inside"] | (F.exists(leaf["parts"], lambda p: _part_holds(px, py, p)) & ~F.exists(leaf["parts"], lambda p: _part_touches(px, py, p)))


def point_in_zone_join(points: DataFrame, zones: DataFrame, x_col: str = "x", y_col: str = "y", id_col: str = "LocationID",
                       index: tuple[DataFrame, list[int]] | None = None) -> DataFrame:
    """points LEFT JOIN zones ON within(point, zone); adds ``id_col``. Points without finite coordinates are in no zone.

    ``index``: that of the zones (``zone_index``), if it has been built already.
    """
    table, levels = index or zone_index(zones, id_col)
    px, py = F.col(x_col), F.col(y_col)
    whole = (F.abs(px) < F.lit(2.0 ** 1000)) & (F.abs(py) < F.lit(2.0 ** 1000))
    kind, lists = table.schema["found"].dataType.simpleString(), []
    for level in levels:
        cells = table.where(F.col("level") == level).select("cx", "cy", F.col("found").alias(f"_leaves{len(lists)}"))
        # A factor of two loses nothing, so the cell is exact; cells beyond a long's range hold no zone.
        cell = lambda c: F.when(whole & (F.abs(c * F.lit(2.0 ** -level)) < 2.0 ** 62), F.floor(c * F.lit(2.0 ** -level)))       # noqa: E731
        points = points.withColumns({"_cx": cell(px), "_cy": cell(py)}).join(
            cells, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy")), "left").drop("_cx", "_cy", "cx", "cy")
        lists.append(f"_leaves{len(lists)}")
    found = F.concat(*[F.coalesce(F.col(c), F.array().cast(kind)) for c in lists]) if lists else F.array().cast(kind)
    held = F.transform(F.filter(found, lambda leaf: leaf_holds(px, py, leaf)), lambda leaf: leaf["zone"])
    return points.withColumn("_zones", held).drop(*lists).withColumn(id_col, F.explode_outer("_zones")).drop("_zones")


def zone_centroids(zones: DataFrame, id_col: str = "LocationID") -> DataFrame:
    c = G.centroid("geom")
    return zones.select(F.col(id_col), c["x"].alias("cx"), c["y"].alias("cy"))


def zone_largest_part(zones: DataFrame, id_col: str = "LocationID") -> DataFrame:
    lp = G.largest_part("geom")
    return zones.select(F.col(id_col), lp["idx"].alias("part_idx"), lp["area"].alias("area"),
                        lp["ring"].alias("ring"))
