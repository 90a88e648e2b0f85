import datetime as dt

from pyspark.sql import functions as F

from kerbflow.operators import quality

COLS = ("trip_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, trip_distance double, "
        "fare_amount string, extra double, mta_tax double, tip_amount double, tolls_amount double, "
        "improvement_surcharge double, congestion_surcharge double, airport_fee double, total_amount double")


def T(*a):
    return dt.datetime(*a)


def row(i, p, d, dist=1.0, fare="10", total=12.0, **kw):
    base = dict(extra=0.0, mta_tax=0.5, tip_amount=0.0, tolls_amount=0.0, improvement_surcharge=0.3,
                congestion_surcharge=0.0, airport_fee=0.0)
    base.update(kw)
    return (i, p, d, dist, fare, base["extra"], base["mta_tax"], base["tip_amount"], base["tolls_amount"],
            base["improvement_surcharge"], base["congestion_surcharge"], base["airport_fee"], total)


def flags(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    return {r["trip_id"]: (r["time_valid"], r["distance_valid"], r["price_valid"])
            for r in quality.quality_flags(df).collect()}


def test_time_rule_edges(spark):
    f = flags(spark, [
        row(1, T(2020, 5, 1, 10), T(2020, 5, 1, 10)),            # dropoff = pickup
        row(2, T(2020, 12, 31, 23), T(2021, 1, 1, 0, 30)),      # 31 Dec -> 1 Jan
        row(3, T(2020, 12, 30, 23), T(2021, 1, 1, 0, 30), dist=1.0),  # 30 Dec -> 1 Jan
        row(4, T(2010, 5, 1, 10), T(2010, 5, 1, 11)),
        row(5, T(2011, 5, 1, 10), T(2011, 5, 1, 11)),
        row(6, T(2025, 5, 1, 10), T(2025, 5, 1, 11)),
        row(7, T(2026, 5, 1, 10), T(2026, 5, 1, 11)),
        row(8, None, T(2020, 5, 1, 11)),
    ])
    assert [f[i][0] for i in range(1, 9)] == [False, True, False, False, True, True, False, False]


def test_distance_rule_open_bounds(spark):
    p, d = T(2020, 5, 1, 10), T(2020, 5, 1, 12)              # 2 hours -> limit 150
    f = flags(spark, [row(1, p, d, dist=0.0), row(2, p, d, dist=150.0), row(3, p, d, dist=149.99),
                      row(4, p, d, dist=None), row(5, p, d, dist=float("nan"))])
    assert [f[i][1] for i in range(1, 6)] == [False, False, True, False, False]


def test_price_rule_and_coercion(spark):
    p, d = T(2020, 5, 1, 10), T(2020, 5, 1, 11)
    f = flags(spark, [
        row(1, p, d, fare="11.2", total=12.0),                  # charges = 11.2 + 0.5 + 0.3 = total
        row(2, p, d, fare="0", total=12.0, mta_tax=0.0, improvement_surcharge=0.0),  # charges = 0
        row(3, p, d, fare="n/a"),                               # text money -> null -> invalid
        row(4, p, d, fare="NaN"),                               # NaN -> invalid
        row(5, p, d, airport_fee=None),                         # null fee -> invalid
        row(6, p, d, tip_amount=-1.0),
        row(7, p, d, total=0.0, fare="0"),
        row(8, p, d, fare=" 5 ", total=6.0),
    ])
    assert [f[i][2] for i in range(1, 9)] == [True, False, False, False, False, False, False, True]


def test_stats_partition_total(spark):
    p = T(2020, 5, 1, 10)
    rows = [row(i, p, T(2020, 5, 1, 11), dist=float(i % 3)) for i in range(20)]
    df = spark.createDataFrame(rows, COLS).withColumn("year", F.year("pickup_datetime"))
    st = quality.quality_stats(quality.quality_flags(df)).collect()
    assert len(st) == 1 and st[0]["total_trips"] == 20
    clean = quality.clean_trips(df).count()
    assert clean == st[0]["valid_trip_count"]
    assert clean + df.count() - clean == 20


def test_aliases_and_odd_numbers_are_coerced(spark):
    import datetime as dt

    from kerbflow.operators import quality
    p = dt.datetime(2024, 1, 1, 10)
    rows = [("10", "2.0"), ("NaN", "2.0"), ("12d", "2.0"), ("0x1p3", "2.0"), ("abc", "2.0"), ("10", "x"), (" 1e1 ", "2"), (None, "2")]
    df = spark.createDataFrame([(p, p + dt.timedelta(hours=1), a, b) for a, b in rows],
                               "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, driver_pay string, trip_miles string")
    got = [(r.price_valid, r.distance_valid) for r in quality.quality_flags(df).collect()]
    assert got == [(True, True), (False, True), (False, True), (False, True), (False, True), (True, False), (True, True), (False, True)]
