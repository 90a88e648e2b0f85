import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbflow.operators import eda


def test_block_correlation_equals_corr(spark):
    rng = np.random.default_rng(4)
    rows = []
    for s in range(60):
        hours = range(24) if s % 7 else range(0, 24, 5)                 # some series lack hours
        w = rng.random(24) if s % 11 else np.ones(24)                   # some have no spread
        rows += [(f"s{s}", h, float(w[h])) for h in hours]
    rows.append((None, 3, 0.5))
    p = spark.createDataFrame(rows, "service string, hour int, share double")
    x = np.zeros((60, 24))
    for s, h, v in rows[:-1]:
        x[int(s[1:]), h] = v
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(x)
    for block in (7, 256):
        got = eda.profile_corr(p, block=block).collect()
        assert len(got) == 3600 and len({(r.service_a, r.service_b) for r in got}) == 3600
        for r in got:
            w = want[int(r.service_a[1:]), int(r.service_b[1:])]
            assert (r["corr"] is None) == bool(np.isnan(w)) and (r["corr"] is None or abs(r["corr"] - w) < 1e-9)


def test_two_thousand_series_take_one_shuffle_of_their_rows(spark):
    p = (spark.range(2000 * 24).select((F.col("id") % 2000).alias("zone"), F.floor(F.col("id") / 2000).cast("int").alias("hour"),
                                       F.rand(5).alias("share")))
    c = eda.profile_corr(p, by="zone")
    assert c.count() == 4_000_000 and c.where("abs(corr) > 1").count() == 0
    assert c.where("zone_a = zone_b").agg(F.min("corr")).first()[0] == pytest.approx(1.0)


def test_sketches_merge_over_any_range(spark):
    rng = np.random.default_rng(6)
    rows = [(f"s{i % 2}", f"{2019 + i % 4}-0{1 + i % 9}-05 10:00:00", float(v) if i % 50 else None) for i, v in enumerate(rng.lognormal(size=20_000))]
    df = spark.createDataFrame(rows, "service string, t string, trip_distance double").withColumn("pickup_datetime", F.col("t").cast("timestamp_ntz"))
    sketches = eda.distance_sketches(df).cache()
    assert sketches.count() == 2 * 4 * 9 / 2                            # years of one parity for each service
    for where, keep in (("true", lambda r: True), ("year >= 2021", lambda r: r[1] >= "2021"), ("service = 's1' and month < 4", lambda r: r[0] == "s1" and r[1][6] < "4")):
        x = np.array([r[2] for r in rows if keep(r) and r[2] is not None])
        m = eda.merged_distance_summary(sketches.where(where)).first()
        assert (m["count"], m["min"], m["max"]) == (len(x), x.min(), x.max())
        assert m["mean"] == pytest.approx(x.mean()) and m["std"] == pytest.approx(x.std(ddof=1))
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            assert abs((x <= m[q]).mean() - p) < 0.01                   # rank error
    assert eda.merged_distance_summary(sketches.where("false"), ["service"]).count() == 0
    big = spark.createDataFrame([("a", "2020-01-01 00:00:00", 1e9 + v) for v in (0.0, 1.0, 2.0)], "service string, t string, trip_distance double")
    s = eda.merged_distance_summary(eda.distance_sketches(big.withColumn("pickup_datetime", F.col("t").cast("timestamp_ntz")))).first()
    assert s["mean"] == pytest.approx(1e9 + 1)


def test_a_summary_scans_its_trips_once_for_all_counts(spark, tmp_dir):
    spark.range(500).select(F.lit("a").alias("service"), F.timestamp_seconds(F.col("id") * 9999).cast("timestamp_ntz").alias("pickup_datetime"),
                            (F.col("id") % 5).cast("int").alias("pulocationid"), (F.col("id") % 3).cast("int").alias("dolocationid")).write.parquet(f"{tmp_dir}/t")
    s = eda.service_summary(spark.read.parquet(f"{tmp_dir}/t"))
    r = s.first()
    assert r.total_trips == 500 and sum(x.num_trips for x in r.trips_per_hour) == 500
    assert s._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1       # for the pairs of zones
