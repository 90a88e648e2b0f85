import datetime as dt

import pytest

from kerbflow.operators import mobility

T = dt.datetime


def zones(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "LocationID int, zone_name string")


def avg(spark, rows):
    return spark.createDataFrame(rows, "location_id int, avg_per_day double")


def test_net_movement_all_zero(spark):
    out = mobility.net_movement(zones(spark), avg(spark, []), avg(spark, [])).collect()
    assert {r["LocationID"]: (r["net_movement"], r["net_movement_norm"], list(r["fill_color"])) for r in out} == \
        {i: (0.0, 0.0, [0, 255, 0, 180]) for i in (1, 2, 3)}


def test_net_movement_in_only_and_unseen(spark):
    out = {r["LocationID"]: r for r in mobility.net_movement(
        zones(spark), avg(spark, [(2, 1.0)]), avg(spark, [(1, 4.25), (2, 1.0)])).collect()}
    assert out[1]["incoming"] == 4.25 and out[1]["outgoing"] == 0.0
    assert out[1]["net_movement"] == 4.2                      # half-even rounding
    assert out[1]["net_movement_norm"] == 1.0 and list(out[1]["fill_color"]) == [0, 0, 255, 180]
    assert out[3]["net_movement"] == 0.0                      # zone never seen


def test_hour_slice(spark):
    counts = spark.createDataFrame([
        (T(2024, 1, 1, 10), 1, 4), (T(2024, 1, 2, 10), 1, 2), (T(2024, 1, 2, 10), 2, 3), (T(2024, 1, 2, 11), 2, 9)],
        "hour timestamp_ntz, location_id int, count bigint")
    out = {r["location_id"]: (r["total_count"], r["num_days"], r["avg_per_day"])
           for r in mobility.hour_slice_avg(counts, "10:00:00").collect()}
    assert out == {1: (6, 2, 3.0), 2: (3, 2, 1.5)}


def test_movement_counts_drop_null_keys(spark):
    trips = spark.createDataFrame([
        (T(2024, 1, 1, 10, 5), T(2024, 1, 1, 10, 50), 1, 2),
        (T(2024, 1, 1, 10, 15), T(2024, 1, 1, 11, 5), None, 2)],
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pulocationid int, dolocationid int")
    out = sorted((r["kind"], r["hour"].hour, r["location_id"], r["count"]) for r in mobility.movement_counts(trips).collect())
    assert out == [("dropoff", 10, 2, 1), ("dropoff", 11, 2, 1), ("pickup", 10, 1, 1)]
