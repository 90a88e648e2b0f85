"""Ingest-free batch queries: quality rules and EDA summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbflow.operators import eda, quality
from kerbflow.plans.registry import register
from kerbflow.session import scratch_path
from kerbflow.plans.standins import (TRIPS_EV_SQL, TRIPS_LI_SQL, trips_ev, trips_li,
                                     trips_li_text, with_ctes)


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


# ------------------------------------------------------------------ quality

@register("quality_flags", with_ctes(TRIPS_LI_SQL, body="""
SELECT trip_id,
  coalesce(pickup_datetime < dropoff_datetime
    AND (year(dropoff_datetime) = year(pickup_datetime)
         OR (year(dropoff_datetime) - year(pickup_datetime) = 1 AND month(pickup_datetime) = 12
             AND day(pickup_datetime) = 31 AND month(dropoff_datetime) = 1 AND day(dropoff_datetime) = 1))
    AND year(pickup_datetime) BETWEEN 2011 AND 2025, false) AS time_valid,
  coalesce(trip_distance > 0 AND trip_distance <
    date_diff('microsecond', pickup_datetime, dropoff_datetime) / 3.6e9 * 75.0, false) AS distance_valid,
  coalesce(total_amount > 0 AND extra >= 0 AND mta_tax >= 0 AND tip_amount >= 0 AND tolls_amount >= 0
    AND improvement_surcharge >= 0 AND congestion_surcharge >= 0 AND airport_fee >= 0
    AND fare_amount + mta_tax + improvement_surcharge + tolls_amount + congestion_surcharge + airport_fee > 0
    AND fare_amount + mta_tax + improvement_surcharge + tolls_amount + congestion_surcharge + airport_fee
        <= total_amount, false) AS price_valid
FROM trips_li"""))
def q_quality_flags(spark, sf_dir):
    f = quality.quality_flags(trips_li(spark, sf_dir))
    return f.select("trip_id", "time_valid", "distance_valid", "price_valid")


QUALITY_FLAGS_CTE = """flags AS (
SELECT trip_id, year(pickup_datetime)::INTEGER AS year,
  coalesce(pickup_datetime < dropoff_datetime
    AND (year(dropoff_datetime) = year(pickup_datetime)
         OR (year(dropoff_datetime) - year(pickup_datetime) = 1 AND month(pickup_datetime) = 12
             AND day(pickup_datetime) = 31 AND month(dropoff_datetime) = 1 AND day(dropoff_datetime) = 1))
    AND year(pickup_datetime) BETWEEN 2011 AND 2025, false) AS time_valid,
  coalesce(trip_distance > 0 AND trip_distance <
    date_diff('microsecond', pickup_datetime, dropoff_datetime) / 3.6e9 * 75.0, false) AS distance_valid,
  coalesce(total_amount > 0 AND extra >= 0 AND mta_tax >= 0 AND tip_amount >= 0 AND tolls_amount >= 0
    AND improvement_surcharge >= 0 AND congestion_surcharge >= 0 AND airport_fee >= 0
    AND fare_amount + mta_tax + improvement_surcharge + tolls_amount + congestion_surcharge + airport_fee > 0
    AND fare_amount + mta_tax + improvement_surcharge + tolls_amount + congestion_surcharge + airport_fee
        <= total_amount, false) AS price_valid
FROM trips_li)"""


@register("quality_stats", with_ctes(TRIPS_LI_SQL, QUALITY_FLAGS_CTE, body="""
SELECT year, count(*) AS total_trips,
  count(*) FILTER (WHERE NOT time_valid) AS invalid_timestamps,
  count(*) FILTER (WHERE NOT distance_valid) AS invalid_distances,
  count(*) FILTER (WHERE NOT price_valid) AS invalid_prices,
  count(*) FILTER (WHERE time_valid AND distance_valid AND price_valid) AS valid_trip_count
FROM flags GROUP BY year ORDER BY year"""))
def q_quality_stats(spark, sf_dir):
    t = trips_li(spark, sf_dir).withColumn("year", F.year("pickup_datetime"))
    return quality.quality_stats(quality.quality_flags(t))


@register("coerce_numeric", with_ctes(TRIPS_LI_SQL, """lt AS (
  SELECT trip_id,
    CASE WHEN trip_id % 8 = 3 THEN 'n/a' ELSE CAST(fare_amount AS VARCHAR) END AS fare_amount,
    CASE WHEN trip_id % 8 = 4 THEN '' ELSE CAST(extra AS VARCHAR) END AS extra,
    CASE WHEN trip_id % 8 = 5 THEN 'NaN' ELSE CAST(mta_tax AS VARCHAR) END AS mta_tax,
    CASE WHEN trip_id % 8 = 6 THEN ' 1.5 ' ELSE CAST(tip_amount AS VARCHAR) END AS tip_amount,
    CASE WHEN trip_id % 8 = 2 THEN '12,50' ELSE CAST(total_amount AS VARCHAR) END AS total_amount
  FROM trips_li)""", """c AS (
  SELECT trip_id, TRY_CAST(fare_amount AS DOUBLE) AS fare_amount, TRY_CAST(extra AS DOUBLE) AS extra,
    TRY_CAST(mta_tax AS DOUBLE) AS mta_tax, TRY_CAST(trim(tip_amount) AS DOUBLE) AS tip_amount,
    TRY_CAST(total_amount AS DOUBLE) AS total_amount FROM lt)""", body="""
SELECT trip_id,
  CASE WHEN isnan(fare_amount) THEN NULL ELSE fare_amount END AS fare_amount,
  CASE WHEN isnan(extra) THEN NULL ELSE extra END AS extra,
  CASE WHEN isnan(mta_tax) THEN NULL ELSE mta_tax END AS mta_tax,
  CASE WHEN isnan(tip_amount) THEN NULL ELSE tip_amount END AS tip_amount,
  CASE WHEN isnan(total_amount) THEN NULL ELSE total_amount END AS total_amount
FROM c"""))
def q_coerce_numeric(spark, sf_dir):
    c = quality.coerce_numeric(trips_li_text(spark, sf_dir))
    return c.select("trip_id", "fare_amount", "extra", "mta_tax", "tip_amount", "total_amount")


# ---------------------------------------------------------------------- EDA

@register("trips_per_year", with_ctes(TRIPS_LI_SQL, body="""
SELECT service, year(pickup_datetime)::INTEGER AS year, count(*) AS num_trips
FROM trips_li GROUP BY 1, 2 ORDER BY 1, 2"""))
def q_trips_per_year(spark, sf_dir):
    return eda.trips_per_year(trips_li(spark, sf_dir), by=["service"])


@register("trips_per_hour", with_ctes(TRIPS_EV_SQL, body="""
SELECT service, hour(pickup_datetime)::INTEGER AS hour, count(*) AS num_trips
FROM trips_ev GROUP BY 1, 2 ORDER BY 1, 2"""))
def q_trips_per_hour(spark, sf_dir):
    return eda.trips_per_hour(trips_ev(spark, sf_dir), by=["service"])


@register("trips_per_month", with_ctes(TRIPS_EV_SQL, body="""
SELECT service, year(pickup_datetime)::INTEGER AS year, month(pickup_datetime)::INTEGER AS month,
       count(*) AS num_trips
FROM trips_ev GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""))
def q_trips_per_month(spark, sf_dir):
    return eda.trips_per_month(trips_ev(spark, sf_dir), by=["service"])


@register("distance_summary", with_ctes(TRIPS_EV_SQL, body="""
SELECT service, count(trip_distance) AS count, round(avg(trip_distance), 6) AS mean,
  round(stddev_samp(trip_distance), 6) AS std, round(min(trip_distance), 6) AS min,
  round(quantile_cont(trip_distance, 0.25), 6) AS q25, round(quantile_cont(trip_distance, 0.5), 6) AS q50,
  round(quantile_cont(trip_distance, 0.75), 6) AS q75, round(max(trip_distance), 6) AS max
FROM trips_ev GROUP BY service"""))
def q_distance_summary(spark, sf_dir):
    d = eda.distance_summary(trips_ev(spark, sf_dir), by=["service"], exact=True)
    return d.select("service", "count", *[_r(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@register("top_od", with_ctes(TRIPS_EV_SQL, body="""
SELECT pulocationid, dolocationid, count(*) AS num_trips
FROM trips_ev GROUP BY 1, 2
ORDER BY num_trips DESC, pulocationid ASC NULLS FIRST, dolocationid ASC NULLS FIRST LIMIT 10"""))
def q_top_od(spark, sf_dir):
    return eda.top_od(trips_ev(spark, sf_dir), k=10)


HOURLY_PROFILE_CTE = """prof AS (
  SELECT service, hour(pickup_datetime)::INTEGER AS hour, count(*) AS num_trips
  FROM trips_ev GROUP BY 1, 2),
prof_share AS (
  SELECT service, hour, num_trips, num_trips / sum(num_trips) OVER (PARTITION BY service) AS share
  FROM prof)"""


@register("hourly_profile", with_ctes(TRIPS_EV_SQL, HOURLY_PROFILE_CTE, body="""
SELECT service, hour, num_trips, round(share, 9) AS share FROM prof_share"""))
def q_hourly_profile(spark, sf_dir):
    p = eda.hourly_profile(trips_ev(spark, sf_dir))
    return p.select("service", "hour", "num_trips", _r("share", 9))


@register("profile_corr", with_ctes(TRIPS_EV_SQL, HOURLY_PROFILE_CTE, """grid AS (
  SELECT s.service, h.hour FROM (SELECT DISTINCT service FROM prof_share) s,
                               (SELECT DISTINCT hour FROM prof_share) h)""", """full_prof AS (
  SELECT g.service, g.hour, coalesce(p.share, 0.0) AS share
  FROM grid g LEFT JOIN prof_share p ON g.service = p.service AND g.hour = p.hour)""", body="""
SELECT a.service AS service_a, b.service AS service_b, round(corr(a.share, b.share), 6) AS corr
FROM full_prof a JOIN full_prof b ON a.hour = b.hour
GROUP BY 1, 2"""))
def q_profile_corr(spark, sf_dir):
    c = eda.profile_corr(eda.hourly_profile(trips_ev(spark, sf_dir)))
    return c.select("service_a", "service_b", _r("corr"))


@register("zone_profile_corr", with_ctes(TRIPS_EV_SQL, """prof AS (
  SELECT pulocationid AS zone, hour(pickup_datetime) AS hour, count(*) AS n FROM trips_ev WHERE pulocationid IS NOT NULL GROUP BY 1, 2),
sh AS (SELECT zone, hour, n / sum(n) OVER (PARTITION BY zone) AS share FROM prof),
full_prof AS (
  SELECT z.zone, h.hour, coalesce(share, 0.0) AS share FROM (SELECT DISTINCT zone FROM prof) z CROSS JOIN (SELECT DISTINCT hour FROM prof) h
  LEFT JOIN sh ON sh.zone = z.zone AND sh.hour = h.hour)""", body="""
SELECT a.zone AS zone_a, b.zone AS zone_b, round(corr(a.share, b.share), 6) AS corr
FROM full_prof a JOIN full_prof b ON a.hour = b.hour GROUP BY 1, 2"""))
def q_zone_profile_corr(spark, sf_dir):
    """Correlations between the hourly profiles of all zones."""
    t = trips_ev(spark, sf_dir).withColumn("zone", F.col("pulocationid"))
    c = eda.profile_corr(eda.hourly_profile(t, by="zone"), by="zone")
    return c.select("zone_a", "zone_b", _r("corr"))


@register("distance_sketch", with_ctes(TRIPS_EV_SQL, body="""
SELECT service, count(trip_distance) AS count, round(avg(trip_distance), 6) AS mean, round(stddev_samp(trip_distance), 6) AS std,
       round(min(trip_distance), 6) AS min, round(max(trip_distance), 6) AS max, true AS quartiles_near
FROM trips_ev GROUP BY service"""))
def q_distance_sketch(spark, sf_dir):
    """Summaries from stored sketches by (service, year, month), without reading a trip; then the share of the trips
    below each quartile, which must be within 0.02 of it."""
    trips = trips_ev(spark, sf_dir)
    path = scratch_path(spark, "distance-sketches")
    eda.distance_sketches(trips).write.parquet(path)
    s = eda.merged_distance_summary(spark.read.parquet(path), ["service"])
    q = s.select(F.col("service").alias("_s"), "q25", "q50", "q75")
    below = trips.join(q, F.col("service") == F.col("_s")).groupBy("_s").agg(*[
        F.avg((F.col("trip_distance") <= F.col(c)).cast("double")).alias(c) for c in ("q25", "q50", "q75")])
    near = F.greatest(*[F.abs(F.col(c) - p) for c, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]) < 0.02
    return s.drop("q25", "q50", "q75").join(below, F.col("service") == F.col("_s")).select(
        "service", "count", *[_r(c) for c in ("mean", "std", "min", "max")], near.alias("quartiles_near"))


PROFILE_SERVICES = ("click", "error", "purchase", "signup", "view")


@register("profile_matrix", with_ctes(TRIPS_EV_SQL, HOURLY_PROFILE_CTE, body="SELECT hour, " + ", ".join(
    f"round(coalesce(max(CASE WHEN service = '{s}' THEN share END), 0.0), 9) AS {s}" for s in PROFILE_SERVICES)
    + " FROM prof_share GROUP BY hour"))
def q_profile_matrix(spark, sf_dir):
    m = eda.profile_matrix(eda.hourly_profile(trips_ev(spark, sf_dir)))
    return m.select("hour", *[_r(c, 9) for c in m.columns if c != "hour"])
