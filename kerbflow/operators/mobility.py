"""Hourly pickup/dropoff tables, the hour-of-day slice and net movement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.numeric import colour_triple
from kerbflow.functions.timefn import floor_hour


def movement_counts(trips: DataFrame, pickup_time: str = "pickup_datetime", dropoff_time: str = "dropoff_datetime",
                    pu_col: str = "pulocationid", do_col: str = "dolocationid") -> DataFrame:
    """(kind, hour, location_id, count) for pickups and dropoffs in ONE shuffle:
    each trip is unpivoted into its two (kind, hour, zone) rows, then grouped.
    Null hours / zones are dropped (group-by-drop-na)."""
    rows = F.array(
        F.struct(F.lit("pickup").alias("kind"), floor_hour(pickup_time).alias("hour"),
                 F.col(pu_col).cast("int").alias("location_id")),
        F.struct(F.lit("dropoff").alias("kind"), floor_hour(dropoff_time).alias("hour"),
                 F.col(do_col).cast("int").alias("location_id")))
    long = trips.select(F.inline(rows))
    return (long.where(F.col("hour").isNotNull() & F.col("location_id").isNotNull())
                .groupBy("kind", "hour", "location_id").agg(F.count(F.lit(1)).alias("count")))


def hourly_counts(trips: DataFrame, kind: str = "pickup") -> DataFrame:
    """(hour, location_id, count) for one side; prunes the scan to two columns."""
    t, z = ("pickup_datetime", "pulocationid") if kind == "pickup" else ("dropoff_datetime", "dolocationid")
    return (trips.select(floor_hour(t).alias("hour"), F.col(z).cast("int").alias("location_id"))
                 .where(F.col("hour").isNotNull() & F.col("location_id").isNotNull())
                 .groupBy("hour", "location_id").agg(F.count(F.lit(1)).alias("count")))


def hour_slice_avg(counts: DataFrame, target_hour: str = "10:00:00") -> DataFrame:
    """Per location: total at the target hour of day, days seen (over all
    locations) and the average per day (0 when no day was seen)."""
    f = counts.where(F.date_format("hour", "HH:mm:ss") == target_hour)
    days = f.agg(F.count_distinct(F.to_date("hour"))).scalar()             # scalar subquery, run once
    tot = f.groupBy("location_id").agg(F.sum("count").alias("total_count"))
    out = tot.withColumn("num_days", days)
    return out.withColumn("avg_per_day", F.when(F.col("num_days") > 0,
                                                F.col("total_count") / F.col("num_days")).otherwise(F.lit(0.0)))


def net_movement(zones: DataFrame, pickups_avg: DataFrame, dropoffs_avg: DataFrame,
                 id_col: str = "LocationID", value_col: str = "avg_per_day") -> DataFrame:
    """Net inflow per zone over the full zone list (missing sides are 0),
    normalised by the largest absolute value, with a display colour.

    ``zones`` is the zone dimension (id, name, optional geometry columns)."""
    z = zones
    out_ = pickups_avg.select(F.col("location_id").alias("_o_id"), F.col(value_col).alias("outgoing"))
    in_ = dropoffs_avg.select(F.col("location_id").alias("_i_id"), F.col(value_col).alias("incoming"))
    stats = (z.join(in_, F.col(id_col) == F.col("_i_id"), "left")
              .join(out_, F.col(id_col) == F.col("_o_id"), "left")
              .drop("_i_id", "_o_id")
              .fillna(0.0, subset=["incoming", "outgoing"])
              .withColumn("net", F.col("incoming") - F.col("outgoing")))
    stats = stats.withColumn("_max_abs", stats.agg(F.max(F.abs("net"))).scalar())   # scalar subquery
    norm = F.when(F.col("_max_abs") != 0, F.col("net") / F.col("_max_abs")).otherwise(F.lit(0.0))
    return (stats.withColumn("net_movement_norm", norm)
                 .withColumn("fill_color", colour_triple("net_movement_norm"))
                 .withColumn("net_movement", F.bround("net", 1))
                 .drop("_max_abs", "net"))
