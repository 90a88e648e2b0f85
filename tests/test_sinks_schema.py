import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbflow.schema import Service, conform, require_columns
from kerbflow.sources import files
from kerbflow.streaming.replay import select_present


def test_dynamic_partition_overwrite_keeps_other_years(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2019), (2, 2020), (3, 2020)], "trip_id int, year int")
    path = files.write_year_partitioned(df, f"{tmp_dir}/t")
    files.write_year_partitioned(spark.createDataFrame([(9, 2020)], "trip_id int, year int"), path)
    got = sorted((r["trip_id"], r["year"]) for r in files.read_trips(spark, path).collect())
    assert got == [(1, 2019), (9, 2020)]
    assert [r["trip_id"] for r in files.read_partition(spark, path, 2019).collect()] == [1]


def test_service_discovery(spark, tmp_dir):
    spark.createDataFrame([(1, 2019)], "trip_id int, year int").write.partitionBy("year") \
        .parquet(f"{tmp_dir}/green_partitioned")
    spark.createDataFrame([(2, 2020, 1.5)], "trip_id int, year int, airport_fee double").write.partitionBy("year") \
        .parquet(f"{tmp_dir}/yellow_partitioned")
    spark.createDataFrame([(3,)], "x int").write.parquet(f"{tmp_dir}/notes")
    assert files.list_dirs(spark, tmp_dir, "_partitioned") == ["green_partitioned", "yellow_partitioned"]
    got = sorted((r["service"], r["trip_id"], r["year"], r["airport_fee"]) for r in files.read_services(spark, tmp_dir).collect())
    assert got == [("green", 1, 2019, None), ("yellow", 2, 2020, 1.5)]


def test_conform_and_select_present(spark):
    svc = Service("green", 2016, 2025, "lpep_pickup_datetime", "lpep_dropoff_datetime")
    raw = spark.createDataFrame([(dt.datetime(2020, 1, 1, 10), dt.datetime(2020, 1, 1, 11), 5)],
                                "LPEP_Pickup_Datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, PULocationID int")
    c = conform(raw, svc)
    assert c.columns == ["pickup_datetime", "dropoff_datetime", "pulocationid", "year"]
    assert c.first()["year"] == 2020
    with pytest.raises(ValueError):
        conform(raw.drop("lpep_dropoff_datetime"), svc)
    with pytest.raises(ValueError):
        require_columns(c, ["trip_distance"])
    sel = select_present(c, ["tip_amount", "pulocationid", "pickup_datetime"])
    assert sel.columns == ["pickup_datetime", "pulocationid"]


def test_rebalanced_and_csv_round_trip(spark, tmp_dir):
    df = spark.range(0, 5000).select(F.col("id").alias("trip_id"),
                                     F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("hour"))
    p = files.write_rebalanced(df, f"{tmp_dir}/r")
    assert spark.read.parquet(p).count() == 5000
    c = files.write_csv(df, f"{tmp_dir}/c", gzip=True)
    back = files.read_csv(spark, c, "trip_id long, hour timestamp_ntz")
    assert back.where(F.col("hour").isNull()).count() == 0
    assert sorted(r["trip_id"] for r in back.collect()) == list(range(5000))
