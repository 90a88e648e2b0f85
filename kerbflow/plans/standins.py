"""Trip-shaped stand-ins built from the driver's tables.

Nothing in the test tables is a taxi trip; these mappings only supply the
types and shapes the operators expect. Every Spark builder here has a DuckDB
twin (``*_SQL``) so the oracle sees exactly the same input rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# trips_ev: events as trips (hourly work: 30 days x 24 hours x 25 zones)
# --------------------------------------------------------------------------

# Measures are scaled by irrational constants so that means never terminate
# exactly at a rounding digit (rounded results stay comparable across engines).
DIST_SCALE = 0.1414213562373095     # sqrt(2) / 10
TOTAL_SCALE = 1.7320508075688772    # sqrt(3)
TIP_SCALE = 0.4472135954999579      # sqrt(5) / 5


def trips_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    v = F.col("value")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return ev.select(
        F.col("event_id").alias("trip_id"),
        F.col("event_type").alias("service"),
        F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("MICROSECOND", F.round(v * 6e7).cast("bigint"), "ts").alias("dropoff_datetime"),
        # a null pickup zone every 97th id exercises the null-key rules
        F.when(F.col("event_id") % 97 != 0, (F.col("user_id") % 25).cast("int")).alias("pulocationid"),
        (k % 25).cast("int").alias("dolocationid"),
        (v * DIST_SCALE).alias("trip_distance"),
        (v * TOTAL_SCALE).alias("total_amount"),
        (v * TIP_SCALE).alias("tip_amount"),
    )


TRIPS_EV_SQL = """trips_ev AS (
  SELECT event_id AS trip_id, event_type AS service, ts AS pickup_datetime,
         ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS dropoff_datetime,
         CASE WHEN event_id % 97 <> 0 THEN CAST(user_id % 25 AS INTEGER) END AS pulocationid,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 25 AS INTEGER) AS dolocationid,
         value * 0.1414213562373095 AS trip_distance, value * 1.7320508075688772 AS total_amount,
         value * 0.4472135954999579 AS tip_amount
  FROM events)"""


# --------------------------------------------------------------------------
# trips_li: lineitem x orders as trips, dates shifted so the 2011 bound cuts
# --------------------------------------------------------------------------

LI_SHIFT_YEARS = 12


def trips_li(spark: SparkSession, sf_dir: str, shift_years: int = LI_SHIFT_YEARS) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    shift = F.expr(f"INTERVAL {int(shift_years)} YEARS")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trip_id"),
        F.when(F.col("l_returnflag") == "A", "yellow")
         .when(F.col("l_returnflag") == "N", "green")
         .when(F.col("l_linenumber") % 2 == 0, "fhv").otherwise("fhvhv").alias("service"),
        (F.col("o_orderdate") + shift).alias("pickup_datetime"),
        (F.col("l_shipdate") + shift).alias("dropoff_datetime"),
        (F.col("o_custkey") % 25).cast("int").alias("pulocationid"),
        (F.col("l_suppkey") % 25).cast("int").alias("dolocationid"),
        (F.col("l_quantity") * 2000).alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.lit(0.0).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.0).alias("improvement_surcharge"),
        F.lit(0.0).alias("congestion_surcharge"),
        # no nulls in the source columns: add some by key
        F.when(F.col("l_linenumber") != 7, F.lit(0.0)).alias("airport_fee"),
        (F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax") - F.col("l_discount"))).alias("total_amount"),
    )


def trips_li_sql(shift_years: int = LI_SHIFT_YEARS) -> str:
    return f"""trips_li AS (
  SELECT l_orderkey * 8 + l_linenumber AS trip_id,
         CASE WHEN l_returnflag = 'A' THEN 'yellow' WHEN l_returnflag = 'N' THEN 'green'
              WHEN l_linenumber % 2 = 0 THEN 'fhv' ELSE 'fhvhv' END AS service,
         o_orderdate + INTERVAL {int(shift_years)} YEAR AS pickup_datetime,
         l_shipdate + INTERVAL {int(shift_years)} YEAR AS dropoff_datetime,
         CAST(o_custkey % 25 AS INTEGER) AS pulocationid,
         CAST(l_suppkey % 25 AS INTEGER) AS dolocationid,
         l_quantity * 2000 AS trip_distance,
         l_extendedprice AS fare_amount, l_discount AS extra, l_tax AS mta_tax,
         0.0::DOUBLE AS tip_amount, 0.0::DOUBLE AS tolls_amount,
         0.0::DOUBLE AS improvement_surcharge, 0.0::DOUBLE AS congestion_surcharge,
         CASE WHEN l_linenumber <> 7 THEN 0.0::DOUBLE END AS airport_fee,
         l_extendedprice * (1.0 + l_tax - l_discount) AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


TRIPS_LI_SQL = trips_li_sql()


def trips_li_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trips_li with money columns as text, including garbage values."""
    t = trips_li(spark, sf_dir)
    ln = (F.col("trip_id") % 8)

    def garble(c: str, bad_line: int, bad_text: str):
        return F.when(ln == bad_line, F.lit(bad_text)).otherwise(F.col(c).cast("string")).alias(c)

    return t.select(
        "trip_id", "service", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid",
        "trip_distance",
        garble("fare_amount", 3, "n/a"),
        garble("extra", 4, ""),
        garble("mta_tax", 5, "NaN"),
        garble("tip_amount", 6, " 1.5 "),
        F.col("tolls_amount").cast("string").alias("tolls_amount"),
        F.col("improvement_surcharge").cast("string").alias("improvement_surcharge"),
        F.col("congestion_surcharge").cast("string").alias("congestion_surcharge"),
        F.col("airport_fee").cast("string").alias("airport_fee"),
        garble("total_amount", 2, "12,50"),
    )


# --------------------------------------------------------------------------
# Zones: 5 x 5 grid of rotated squares from nation; boroughs from region.
# Coordinates are integers in micro-units so WKT text round-trips exactly.
# --------------------------------------------------------------------------

# Fixed test geometry: rotation (a, b, den) per n % 4, from Pythagorean triples.
ZONE_ROTATIONS = [(1, 0, 1), (12, 5, 13), (4, 3, 5), (3, 4, 5)]
ZONE_HALF_U = 65000      # half side of the outer square, micro-units
HOLE_HALF_U = 26000      # half side of the hole (even zones)
EXTRA_HALF_U = 20000     # half side of the second part (zones with n % 4 == 3)
GRID_STEP_U = 100000
GRID_ORIGIN_U = -200000
CORNERS = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]


def _ring_text(cx, cy, half: int, rot, reverse: bool = False):
    a = F.element_at(rot, 1)
    b = F.element_at(rot, 2)
    den = F.element_at(rot, 3)
    corners = CORNERS[::-1] if reverse else CORNERS
    pts = []
    for su, sv in corners:
        x = cx + F.lit(su * half) * a / den - F.lit(sv * half) * b / den
        y = cy + F.lit(su * half) * b / den + F.lit(sv * half) * a / den
        pts.append(F.concat_ws(" ", (x / 1e6).cast("string"), (y / 1e6).cast("string")))
    return F.concat(F.lit("("), F.concat_ws(", ", *pts), F.lit(")"))


def zones_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(LocationID, zone_name, borough, wkt) from nation and region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    rot = F.element_at(F.array(*[F.array(*[F.lit(v) for v in t]) for t in ZONE_ROTATIONS]),
                       (key % 4 + 1).cast("int"))
    cx = F.lit(GRID_ORIGIN_U) + (key % 5) * GRID_STEP_U
    cy = F.lit(GRID_ORIGIN_U) + (key / 5).cast("int") * GRID_STEP_U
    ident = F.array(F.lit(1), F.lit(0), F.lit(1))
    outer = _ring_text(cx, cy, ZONE_HALF_U, rot)
    hole = _ring_text(cx, cy, HOLE_HALF_U, rot, reverse=True)
    main = F.when(key % 2 == 0, F.concat(F.lit("("), outer, F.lit(", "), hole, F.lit(")"))) \
        .otherwise(F.concat(F.lit("("), outer, F.lit(")")))
    extra = F.concat(F.lit("("), _ring_text(cx + 30000, cy - 300000, EXTRA_HALF_U, ident), F.lit(")"))
    wkt = F.when(key % 4 == 3, F.concat(F.lit("MULTIPOLYGON ("), main, F.lit(", "), extra, F.lit(")"))) \
        .otherwise(F.concat(F.lit("POLYGON "), main))
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(key.alias("LocationID"), F.col("n_name").alias("zone_name"),
                     F.col("r_name").alias("borough"), wkt.alias("wkt")))


def _zone_vertices_sql() -> str:
    """DuckDB: one row per ring vertex (zone, part, ring, idx, x, y)."""
    rot_case_a = "CASE n_nationkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 12 WHEN 2 THEN 4 ELSE 3 END"
    rot_case_b = "CASE n_nationkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 3 ELSE 4 END"
    rot_case_d = "CASE n_nationkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 13 ELSE 5 END"
    corners = ", ".join(f"({i}, {su}, {sv})" for i, (su, sv) in enumerate(CORNERS))
    rcorners = ", ".join(f"({i}, {su}, {sv})" for i, (su, sv) in enumerate(CORNERS[::-1]))
    return f"""zone_base AS (
  SELECT n_nationkey AS zone,
         {GRID_ORIGIN_U} + (n_nationkey % 5) * {GRID_STEP_U} AS cx,
         {GRID_ORIGIN_U} + (n_nationkey // 5) * {GRID_STEP_U} AS cy,
         {rot_case_a} AS ra, {rot_case_b} AS rb, {rot_case_d} AS rd
  FROM nation),
corners(idx, su, sv) AS (VALUES {corners}),
rcorners(idx, su, sv) AS (VALUES {rcorners}),
zone_vertices AS (
  SELECT zone, 0 AS part, 0 AS ring, idx,
         (cx + su * {ZONE_HALF_U} * ra / rd - sv * {ZONE_HALF_U} * rb / rd) / 1e6 AS x,
         (cy + su * {ZONE_HALF_U} * rb / rd + sv * {ZONE_HALF_U} * ra / rd) / 1e6 AS y
  FROM zone_base, corners
  UNION ALL
  SELECT zone, 0, 1, idx,
         (cx + su * {HOLE_HALF_U} * ra / rd - sv * {HOLE_HALF_U} * rb / rd) / 1e6,
         (cy + su * {HOLE_HALF_U} * rb / rd + sv * {HOLE_HALF_U} * ra / rd) / 1e6
  FROM zone_base, rcorners WHERE zone % 2 = 0
  UNION ALL
  SELECT zone, 1, 0, idx,
         (cx + 30000 + su * {EXTRA_HALF_U}) / 1e6, (cy - 300000 + sv * {EXTRA_HALF_U}) / 1e6
  FROM zone_base, corners WHERE zone % 4 = 3),
zone_segments AS (
  SELECT a.zone, a.part, a.ring, a.idx, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM zone_vertices a JOIN zone_vertices b
    ON a.zone = b.zone AND a.part = b.part AND a.ring = b.ring AND b.idx = a.idx + 1)"""


ZONE_VERTICES_SQL = _zone_vertices_sql()


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, x, y) from the first two embedding entries."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id",
                    F.element_at("embedding", 1).cast("double").alias("x"),
                    F.element_at("embedding", 2).cast("double").alias("y"))


POINTS_SQL = """pts AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y
  FROM embeddings)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
