"""Hourly movement tables, hour slice, net movement and demand forecasting."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbflow.operators import forecast, mobility, spatial
from kerbflow.plans.q_geo import RING_MOMENTS_SQL, zones
from kerbflow.plans.registry import register
from kerbflow.session import produced_once, scratch_path
from kerbflow.sources import files
from kerbflow.plans.standins import (TRIPS_EV_SQL, ZONE_VERTICES_SQL, table, trips_ev, trips_li,
                                     trips_li_sql, with_ctes)

# The hour of day the movement map aggregates.
TARGET_HOUR = "10:00:00"

COUNTS_SQL = """pu AS (
  SELECT date_trunc('hour', pickup_datetime) AS hour, pulocationid AS location_id, count(*) AS count
  FROM trips_ev WHERE pulocationid IS NOT NULL GROUP BY 1, 2)""", """dro AS (
  SELECT date_trunc('hour', dropoff_datetime) AS hour, dolocationid AS location_id, count(*) AS count
  FROM trips_ev WHERE dolocationid IS NOT NULL GROUP BY 1, 2)"""


def _slice_sql(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT s.location_id, CAST(sum(s.count) AS BIGINT) AS total_count, d.num_days,
         CASE WHEN d.num_days > 0 THEN sum(s.count) / d.num_days ELSE 0.0 END AS avg_per_day
  FROM {src} s, (SELECT count(DISTINCT CAST(hour AS DATE)) AS num_days FROM {src}
                 WHERE strftime(hour, '%H:%M:%S') = '{TARGET_HOUR}') d
  WHERE strftime(s.hour, '%H:%M:%S') = '{TARGET_HOUR}'
  GROUP BY s.location_id, d.num_days)"""


@register("hourly_pickups", with_ctes(TRIPS_EV_SQL, *COUNTS_SQL, body="SELECT hour, location_id, count FROM pu"))
def q_hourly_pickups(spark, sf_dir):
    return mobility.hourly_counts(trips_ev(spark, sf_dir), "pickup")


@register("hourly_dropoffs", with_ctes(TRIPS_EV_SQL, *COUNTS_SQL, body="SELECT hour, location_id, count FROM dro"))
def q_hourly_dropoffs(spark, sf_dir):
    return mobility.hourly_counts(trips_ev(spark, sf_dir), "dropoff")


@register("hourly_movement", with_ctes(TRIPS_EV_SQL, *COUNTS_SQL, body="""
SELECT 'pickup' AS kind, hour, location_id, count FROM pu
UNION ALL SELECT 'dropoff', hour, location_id, count FROM dro"""))
def q_hourly_movement(spark, sf_dir):
    return mobility.movement_counts(trips_ev(spark, sf_dir))


@register("hour_slice_avg", with_ctes(TRIPS_EV_SQL, *COUNTS_SQL, _slice_sql("pu", "pu_slice"), body="""
SELECT location_id, total_count, num_days, round(avg_per_day, 9) AS avg_per_day FROM pu_slice"""))
def q_hour_slice_avg(spark, sf_dir):
    """The gather step writes the hourly table as CSV; the map step reads it
    back with a declared schema (bad rows -> null -> dropped) and slices it."""
    path = files.write_csv(mobility.hourly_counts(trips_ev(spark, sf_dir), "pickup"), scratch_path(spark, "pickups-csv"))
    counts = files.read_csv(spark, path, "hour timestamp_ntz, location_id int, count bigint") \
        .dropna(subset=["hour"])
    s = mobility.hour_slice_avg(counts, TARGET_HOUR)
    return s.select("location_id", "total_count", "num_days", F.round("avg_per_day", 9).alias("avg_per_day"))


def movement(spark, sf_dir):
    """The hourly movement table, written once: both slices and the scale read it, the trips are read once."""
    path = scratch_path(spark, "movement")
    mobility.movement_counts(trips_ev(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@register("net_movement", with_ctes(TRIPS_EV_SQL, *COUNTS_SQL, _slice_sql("pu", "pu_slice"),
                                    _slice_sql("dro", "do_slice"), """st AS (
  SELECT n.n_nationkey AS LocationID, n.n_name AS zone_name,
         coalesce(d.avg_per_day, 0.0) AS incoming, coalesce(p.avg_per_day, 0.0) AS outgoing,
         coalesce(d.avg_per_day, 0.0) - coalesce(p.avg_per_day, 0.0) AS net
  FROM nation n LEFT JOIN do_slice d ON n.n_nationkey = d.location_id
                LEFT JOIN pu_slice p ON n.n_nationkey = p.location_id)""", """nm AS (
  SELECT *, CASE WHEN max(abs(net)) OVER () <> 0 THEN net / max(abs(net)) OVER () ELSE 0.0 END AS norm FROM st)""",
    body="""
SELECT LocationID, zone_name, round(incoming, 9) AS incoming, round(outgoing, 9) AS outgoing,
       round_even(net, 1) AS net_movement, round(norm, 9) AS net_movement_norm,
       CAST(trunc(255.0 * greatest(0.0, -norm)) AS INTEGER) AS red,
       CAST(trunc(255.0 * (1.0 - abs(norm))) AS INTEGER) AS green,
       CAST(trunc(255.0 * greatest(0.0, norm)) AS INTEGER) AS blue, 180 AS alpha
FROM nm"""))
def q_net_movement(spark, sf_dir):
    counts = movement(spark, sf_dir)
    pu = mobility.hour_slice_avg(counts.where(F.col("kind") == "pickup"), TARGET_HOUR)
    do = mobility.hour_slice_avg(counts.where(F.col("kind") == "dropoff"), TARGET_HOUR)
    z = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("LocationID"),
                                              F.col("n_name").alias("zone_name"))
    nm = mobility.net_movement(z, pu, do)
    return nm.select("LocationID", "zone_name", F.round("incoming", 9).alias("incoming"),
                     F.round("outgoing", 9).alias("outgoing"), "net_movement",
                     F.round("net_movement_norm", 9).alias("net_movement_norm"),
                     F.col("fill_color")[0].alias("red"), F.col("fill_color")[1].alias("green"),
                     F.col("fill_color")[2].alias("blue"), F.col("fill_color")[3].alias("alpha"))


# ------------------------------------------------------------------ demand

CENTROID_SQL = (ZONE_VERTICES_SQL, RING_MOMENTS_SQL, """wt AS (
  SELECT zone, CASE WHEN ring = 0 THEN 1.0 ELSE -1.0 END * abs(a2) / 2 AS w,
         sx / (a2 * 3.0) AS cx, sy / (a2 * 3.0) AS cy FROM rm WHERE a2 <> 0)""", """cen AS (
  SELECT zone, sum(w * cy) / sum(w) AS lat, sum(w * cx) / sum(w) AS lon FROM wt GROUP BY zone)""")


def centroids(spark, sf_dir):
    c = spatial.zone_centroids(zones(spark, sf_dir))
    return c.select(F.col("LocationID").cast("int").alias("zone"), F.col("cy").alias("lat"), F.col("cx").alias("lon"))


@register("hourly_demand", with_ctes(TRIPS_EV_SQL, *CENTROID_SQL, """dem AS (
  SELECT date_trunc('hour', pickup_datetime) AS pickup_hour, pulocationid AS pickup_zone, count(*) AS trip_count
  FROM trips_ev WHERE pulocationid IS NOT NULL GROUP BY 1, 2)""", body="""
SELECT d.pickup_hour, d.pickup_zone, d.trip_count, round(c.lat, 9) + 0.0 AS lat, round(c.lon, 9) + 0.0 AS lon
FROM dem d LEFT JOIN cen c ON d.pickup_zone = c.zone"""))
def q_hourly_demand(spark, sf_dir):
    d = forecast.hourly_demand(trips_ev(spark, sf_dir), centroids(spark, sf_dir))
    return d.select("pickup_hour", "pickup_zone", "trip_count", (F.round("lat", 9) + 0.0).alias("lat"),
                    (F.round("lon", 9) + 0.0).alias("lon"))


@register("demand_features", with_ctes(TRIPS_EV_SQL, """dem AS (
  SELECT date_trunc('hour', pickup_datetime) AS pickup_hour, pulocationid AS pickup_zone, count(*) AS trip_count
  FROM trips_ev WHERE pulocationid IS NOT NULL GROUP BY 1, 2)""", body="""
SELECT pickup_hour, pickup_zone, trip_count, hour(pickup_hour)::INTEGER AS hour,
       (isodow(pickup_hour) - 1)::INTEGER AS dow, month(pickup_hour)::INTEGER AS month,
       year(pickup_hour)::INTEGER AS year
FROM dem"""))
def q_demand_features(spark, sf_dir):
    f = forecast.demand_features(forecast.hourly_demand(trips_ev(spark, sf_dir)))
    return f.select("pickup_hour", "pickup_zone", "trip_count", "hour", "dow", "month", "year")


SPLIT_SHIFT_YEARS = 24


def _split_frame(spark, sf_dir, with_centroids: bool):
    t = trips_li(spark, sf_dir, shift_years=SPLIT_SHIFT_YEARS)
    d = forecast.hourly_demand(t, centroids(spark, sf_dir) if with_centroids else None)
    return forecast.split_by_year(forecast.demand_features(d))


@register("demand_split", with_ctes(trips_li_sql(SPLIT_SHIFT_YEARS), """dem AS (
  SELECT date_trunc('hour', pickup_datetime) AS pickup_hour, pulocationid AS pickup_zone, count(*) AS trip_count
  FROM trips_li WHERE pulocationid IS NOT NULL GROUP BY 1, 2)""", body="""
SELECT pickup_hour, pickup_zone, trip_count, year(pickup_hour)::INTEGER AS year,
  CASE WHEN year(pickup_hour) IN (2019, 2020, 2021, 2022) THEN 'train'
       WHEN year(pickup_hour) = 2023 THEN 'validation' ELSE 'test' END AS split
FROM dem WHERE year(pickup_hour) IN (2019, 2020, 2021, 2022, 2023, 2024)"""))
def q_demand_split(spark, sf_dir):
    s = _split_frame(spark, sf_dir, with_centroids=False)
    return s.select("pickup_hour", "pickup_zone", "trip_count", "year", "split")


def _metrics(spark, sf_dir):
    """The models' metrics: fitted once per application, read by both queries."""
    def build():
        out = scratch_path(spark, "forecast-metrics")
        forecast.forecast_metrics(_split_frame(spark, sf_dir, with_centroids=True), save_dir=scratch_path(spark, "models")).write.parquet(out)
        return out
    return spark.read.parquet(produced_once(spark, "forecast", sf_dir, build))


@register("forecast_metrics")
def q_forecast_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@register("forecast_baseline", with_ctes(trips_li_sql(SPLIT_SHIFT_YEARS), """dem AS (
  SELECT date_trunc('hour', pickup_datetime) AS pickup_hour, count(*) AS y
  FROM trips_li WHERE pulocationid IS NOT NULL GROUP BY date_trunc('hour', pickup_datetime), pulocationid)""", """mean AS (
  SELECT avg(y) AS m FROM dem WHERE year(pickup_hour) BETWEEN 2019 AND 2022)""", body="""
SELECT CASE WHEN year(pickup_hour) = 2023 THEN 'validation' ELSE 'test' END AS split, count(*) AS n,
       round(avg((y - m) * (y - m)), 6) AS mean_mse, round(avg(abs(y - m)), 6) AS mean_mae,
       'gbt linear ordered_sgd' AS models, true AS near_mean
FROM dem, mean WHERE year(pickup_hour) IN (2023, 2024) GROUP BY 1"""))
def q_forecast_baseline(spark, sf_dir):
    """Rows and the mean-only error of both splits, which models were scored on all of them, and whether the linear
    ones come within 1.25 times that error (the stand-in's demand hangs on none of the features; boosted trees
    learn its noise)."""
    m = _metrics(spark, sf_dir)
    base = m.where("model = 'mean'").select("split", "n", F.col("mse").alias("b"), F.col("mae").alias("a"))
    others = m.where("model <> 'mean'").select("split", F.col("n").alias("n_model"), "model", "mse")
    return base.join(others, "split").groupBy("split", "n").agg(
        F.round(F.first("b"), 6).alias("mean_mse"), F.round(F.first("a"), 6).alias("mean_mae"),
        F.array_join(F.array_sort(F.collect_set("model")), " ").alias("models"),
        F.every(((F.col("mse") < 1.25 * F.col("b")) | (F.col("model") == "gbt")) & (F.col("n_model") == F.col("n"))).alias("near_mean"))


@register("net_movement_map", with_ctes(TRIPS_EV_SQL, *COUNTS_SQL, _slice_sql("pu", "pu_slice"),
                                        _slice_sql("dro", "do_slice"), ZONE_VERTICES_SQL, RING_MOMENTS_SQL, """pa AS (
  SELECT zone, part, sum(CASE WHEN ring = 0 THEN 1.0 ELSE -1.0 END * abs(a2) / 2) AS area FROM rm GROUP BY 1, 2)""",
    """best AS (SELECT zone, part, row_number() OVER (PARTITION BY zone ORDER BY area DESC, part) AS rk FROM pa)""",
    """nv AS (SELECT v.zone, count(*) AS n_vertices FROM zone_vertices v
            JOIN best b ON v.zone = b.zone AND v.part = b.part AND b.rk = 1 WHERE v.ring = 0 GROUP BY v.zone)""",
    """st AS (
  SELECT n.n_nationkey AS LocationID, n.n_name AS zone_name,
         coalesce(d.avg_per_day, 0.0) - coalesce(p.avg_per_day, 0.0) AS net
  FROM nation n LEFT JOIN do_slice d ON n.n_nationkey = d.location_id
                LEFT JOIN pu_slice p ON n.n_nationkey = p.location_id)""", """nm AS (
  SELECT *, CASE WHEN max(abs(net)) OVER () <> 0 THEN net / max(abs(net)) OVER () ELSE 0.0 END AS norm FROM st)""",
    body="""
SELECT nm.LocationID, nm.zone_name, round_even(nm.net, 1) AS net_movement,
       CAST(trunc(255.0 * greatest(0.0, -nm.norm)) AS INTEGER) AS red,
       CAST(trunc(255.0 * (1.0 - abs(nm.norm))) AS INTEGER) AS green,
       CAST(trunc(255.0 * greatest(0.0, nm.norm)) AS INTEGER) AS blue,
       CAST(nv.n_vertices AS INTEGER) AS n_vertices
FROM nm JOIN nv ON nm.LocationID = nv.zone"""))
def q_net_movement_map(spark, sf_dir):
    """Net movement per zone with the outer ring of the zone's largest part,
    written as GeoJSON-like rows (JSON) and read back."""
    counts = movement(spark, sf_dir)
    pu = mobility.hour_slice_avg(counts.where(F.col("kind") == "pickup"), TARGET_HOUR)
    do = mobility.hour_slice_avg(counts.where(F.col("kind") == "dropoff"), TARGET_HOUR)
    z = zones(spark, sf_dir)
    rings = spatial.zone_largest_part(z).select("LocationID", "ring")
    base = z.select("LocationID", "zone_name").join(rings, "LocationID", "left")
    nm = mobility.net_movement(base, pu, do)
    rows = nm.select("LocationID", "zone_name", "net_movement", "fill_color",
                     F.transform("ring", lambda p: F.array(p["x"], p["y"])).alias("coordinates"))
    path = files.write_summary_json(rows, scratch_path(spark, "net-movement-map"))
    back = spark.read.schema(rows.schema).json(path)
    return back.select("LocationID", "zone_name", "net_movement", F.col("fill_color")[0].alias("red"),
                       F.col("fill_color")[1].alias("green"), F.col("fill_color")[2].alias("blue"),
                       F.size("coordinates").alias("n_vertices"))
