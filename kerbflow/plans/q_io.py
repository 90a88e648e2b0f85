"""Ingest, partition scans, clean write, summaries, formats, file health and
scalar-function queries. Files go to a fresh folder under the shared
checkpoint directory and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kerbflow.functions import numeric as N
from kerbflow.functions import timefn as T
from kerbflow.operators import eda, quality
from kerbflow.plans.registry import register
from kerbflow.plans.q_batch import QUALITY_FLAGS_CTE
from kerbflow.plans.standins import TRIPS_EV_SQL, TRIPS_LI_SQL, table, trips_ev, trips_li, with_ctes
from kerbflow.schema import Service
from kerbflow.session import produced_once, scratch_path
from kerbflow.sources import files, formats, ledger

# Test catalogue: the stand-in trips span 2007-2013, so the year windows are
# moved into that span; names and time columns are the real services'.
TEST_SERVICES = (
    Service("yellow", 2008, 2013, "tpep_pickup_datetime", "tpep_dropoff_datetime"),
    Service("green", 2010, 2013, "lpep_pickup_datetime", "lpep_dropoff_datetime"),
    Service("fhv", 2009, 2013, "pickup_datetime", "dropOff_datetime"),
    Service("fhvhv", 2011, 2013, "pickup_datetime", "dropoff_datetime"),
)
SERVICE_YEARS_SQL = "(VALUES ('yellow', 2008, 2013), ('green', 2010, 2013), ('fhv', 2009, 2013), ('fhvhv', 2011, 2013)) AS sy(service, y0, y1)"


def write_raw(spark, sf_dir) -> str:
    """Raw files per service with the service's own column names (mixed
    case), one folder per <service>_tripdata_<year> 'file'."""
    raw = scratch_path(spark, "raw")
    # Every service and kind of file is a write of its own: the trips are joined once for all of them.
    t = trips_li(spark, sf_dir).where(F.col("service").isin([x.name for x in TEST_SERVICES])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for svc in TEST_SERVICES:
            write_raw_service(t, svc, raw)
    finally:
        t.unpersist()
    truncated_copy(spark, f"{raw}/green_tripdata_bad/file=green_tripdata_2012", "cut.parquet", formats.TINY_FILE_BYTES)
    return raw


def write_raw_service(t, svc: Service, raw: str) -> None:
    part = t.where(F.col("service") == svc.name).drop("service")
    renamed = (part.withColumnRenamed("pickup_datetime", svc.pickup_col.upper() if svc.name == "yellow"
                                      else svc.pickup_col)
                   .withColumnRenamed("dropoff_datetime", svc.dropoff_col)
                   .withColumnRenamed("pulocationid", "PULocationID")
                   .withColumnRenamed("dolocationid", "DOLocationID"))
    year = F.year(F.col(renamed.columns[1]))
    tag = F.concat(F.lit(f"{svc.name}_tripdata_"), year.cast("string"))
    # Types change from year to year, as they do in real files: the fee's, the zones' and the drop-off time's.
    for k, (fee, zone, time) in enumerate((("int", "int", "timestamp_ntz"), ("double", "bigint", "timestamp"), ("string", "int", "timestamp_ntz"))):
        (renamed.where(year % 3 == k).withColumn("airport_fee", F.col("airport_fee").cast(fee))
            .withColumn("PULocationID", F.col("PULocationID").cast(zone)).withColumn(svc.dropoff_col, F.col(svc.dropoff_col).cast(time))
            .withColumn("file", tag).write.mode("append").partitionBy("file").parquet(f"{raw}/{svc.name}_tripdata_all"))
    (part.limit(3).select("trip_id").coalesce(1).write                              # without the time columns
        .parquet(f"{raw}/{svc.name}_tripdata_bad/file={svc.name}_tripdata_2012"))


INGEST_SQL = with_ctes(TRIPS_LI_SQL, body=f"""
SELECT t.service, t.trip_id, t.pickup_datetime, t.dropoff_datetime, t.pulocationid::BIGINT AS pulocationid, t.dolocationid,
       t.airport_fee, year(t.pickup_datetime)::INTEGER AS year
FROM trips_li t JOIN {SERVICE_YEARS_SQL} ON t.service = sy.service
WHERE year(t.pickup_datetime) BETWEEN sy.y0 AND sy.y1""")


@register("scan_year_filter", with_ctes(TRIPS_LI_SQL, body=f"""
SELECT t.service, t.trip_id FROM trips_li t JOIN {SERVICE_YEARS_SQL} ON t.service = sy.service
WHERE year(t.pickup_datetime) BETWEEN sy.y0 AND sy.y1"""))
def q_scan_year_filter(spark, sf_dir):
    """The raw files that the ledger of the shared ingest names, read again; no footer is."""
    base, out = ingested(spark, sf_dir), None
    for svc in TEST_SERVICES:
        df = files.scan_service(spark, svc, ledger.read_ledger(spark, base, svc.name))
        df = df.select(F.lit(svc.name).alias("service"), "trip_id")
        out = df if out is None else out.unionByName(df)
    return out


def raw_files(spark, sf_dir) -> str:
    return produced_once(spark, "raw", sf_dir, lambda: write_raw(spark, sf_dir))


def ingested(spark, sf_dir) -> str:
    """The ingested year-partitioned tables: produced once per application and
    read by the scans that follow ingest (partition scan, formats)."""
    def build():
        out = scratch_path(spark, "ingest")
        files.ingest_all(spark, raw_files(spark, sf_dir), out, TEST_SERVICES)
        return out
    return produced_once(spark, "ingest", sf_dir, build)


@register("ingest_trips", INGEST_SQL)
def q_ingest_trips(spark, sf_dir):
    """Ingest runs inside this query (fresh output), then reads every service back."""
    base = scratch_path(spark, "ingest-run")
    files.ingest_all(spark, raw_files(spark, sf_dir), base, TEST_SERVICES)
    df = files.read_services(spark, base)
    return df.select("service", "trip_id", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid",
                     "airport_fee", "year")


@register("ingest_ledger", with_ctes(TRIPS_LI_SQL, body=f"""
SELECT t.service, year(t.pickup_datetime)::INTEGER AS year, count(*) AS trips, count(*) AS ledger_rows, sum(t.pulocationid)::BIGINT AS zone_sum,
       'bigint timestamp_ntz double' AS types
FROM trips_li t JOIN {SERVICE_YEARS_SQL} ON t.service = sy.service
WHERE year(t.pickup_datetime) BETWEEN sy.y0 AND sy.y1 GROUP BY 1, 2"""))
def q_ingest_ledger(spark, sf_dir):
    """Three runs over growing raw folders: the files of even years first, all files next, and all files again.

    Trips by service and year as the table has them, beside the rows that the ledger has of the year's files.
    """
    base, raw, out = scratch_path(spark, "ingest-ledger"), raw_files(spark, sf_dir), None
    for run in (0, 1, 1):
        for svc in TEST_SERVICES:
            files.ingest_service(spark, raw, svc, base, [y for y in svc.years if run or y % 2 == 0])
    for svc in TEST_SERVICES:
        table_ = files.read_ingested(spark, base, svc.name)
        types = " ".join(table_.schema[c].dataType.simpleString() for c in ("pulocationid", "dropoff_datetime", "airport_fee"))
        trips = table_.groupBy("year").agg(F.count("*").alias("trips"), F.sum("pulocationid").alias("zone_sum"))
        kept = (ledger.read_ledger(spark, base, svc.name).where("reason IS NULL")
                .groupBy(F.regexp_extract("path", r"_tripdata_(\d+)[^/]*/[^/]*$", 1).cast("int").alias("year")).agg(F.sum("rows").alias("ledger_rows")))
        rows = trips.join(kept, "year", "full").select(F.lit(svc.name).alias("service"), "year", "trips", "ledger_rows", "zone_sum",
                                                       F.lit(types).alias("types"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("ingest_rejects", """
SELECT s AS service, kind, 1::BIGINT AS files
FROM (VALUES ('yellow', 'without'), ('green', 'without'), ('green', 'unreadable'), ('fhv', 'without'), ('fhvhv', 'without')) AS v(s, kind)""")
def q_ingest_rejects(spark, sf_dir):
    """Raw files that the ingest of the shared tables left out, with the kind of reason."""
    r = files.ingest_rejects(spark, ingested(spark, sf_dir), TEST_SERVICES)
    return r.groupBy("service", F.regexp_extract("reason", r"^(\w+)", 1).alias("kind")).agg(F.count("*").alias("files"))


@register("scan_partition", with_ctes(TRIPS_LI_SQL, body="""
SELECT trip_id, pickup_datetime, year(pickup_datetime)::INTEGER AS year FROM trips_li
WHERE service = 'yellow' AND year(pickup_datetime) = 2012"""))
def q_scan_partition(spark, sf_dir):
    return files.read_ingested_year(spark, ingested(spark, sf_dir), "yellow", 2012).select("trip_id", "pickup_datetime", "year")


@register("clean_trips", with_ctes(TRIPS_LI_SQL, QUALITY_FLAGS_CTE, body="""
SELECT trip_id, year FROM flags WHERE time_valid AND distance_valid AND price_valid"""))
def q_clean_trips(spark, sf_dir):
    t = trips_li(spark, sf_dir).withColumn("year", F.year("pickup_datetime"))
    path = files.write_year_partitioned(quality.clean_trips(t), scratch_path(spark, "clean"))
    return files.read_trips(spark, path).select("trip_id", "year")


@register("service_summary", with_ctes(TRIPS_EV_SQL, """base AS (
  SELECT service, count(*) AS total_trips, count(DISTINCT year(pickup_datetime)) AS years,
         count(DISTINCT hour(pickup_datetime)) AS hours,
         count(DISTINCT (year(pickup_datetime), month(pickup_datetime))) AS months,
         round(avg(trip_distance), 6) AS mean_distance
  FROM trips_ev GROUP BY service)""", """od AS (
  SELECT service, count(*) AS n FROM trips_ev GROUP BY service, pulocationid, dolocationid)""", body="""
SELECT b.service, b.total_trips, CAST(b.years AS INTEGER) AS years, CAST(b.hours AS INTEGER) AS hours,
       CAST(b.months AS INTEGER) AS months, CAST(least(10, (SELECT count(*) FROM od WHERE od.service = b.service)) AS INTEGER) AS od_pairs,
       (SELECT max(n) FROM od WHERE od.service = b.service) AS top_od_trips, b.mean_distance
FROM base b"""))
def q_service_summary(spark, sf_dir):
    """The per-service JSON summary document, written and read back."""
    doc = eda.service_summary(trips_ev(spark, sf_dir))
    path = files.write_summary_json(doc, scratch_path(spark, "summary-json"))
    s = spark.read.schema(doc.schema).json(path)
    return s.select("service", "total_trips", F.size("trips_per_year").alias("years"),
                    F.size("trips_per_hour").alias("hours"), F.size("trips_per_month").alias("months"),
                    F.size("top10_od_pairs").alias("od_pairs"),
                    F.col("top10_od_pairs")[0]["num_trips"].alias("top_od_trips"),
                    F.round("trip_distance_summary.mean", 6).alias("mean_distance"))


@register("format_compare", with_ctes(TRIPS_LI_SQL, body="""
SELECT format, n_rows, sum_trip_id, sum_total FROM (
  SELECT count(*) AS n_rows, sum(trip_id)::BIGINT AS sum_trip_id, round(sum(total_amount), 2) AS sum_total
  FROM trips_li WHERE service = 'yellow' AND year(pickup_datetime) = 2012),
  (SELECT unnest(['csv', 'csv_gzip', 'json', 'orc', 'parquet_snappy', 'parquet_zstd']) AS format)"""))
def q_format_compare(spark, sf_dir):
    """One year of the ingested yellow table in six formats: what each gives back. (Sizes and read
    times are in the table that ``formats.format_compare`` returns; each format must have a size.)"""
    base, out = ingested(spark, sf_dir), scratch_path(spark, "formats")
    year = files.read_ingested_year(spark, base, "yellow", 2012)
    measured = formats.format_compare(year, out)
    rows = None
    for name in formats.FORMATS:
        r = formats.read_back(spark, out, name, year.schema).agg(
            F.lit(name).alias("format"), F.count("*").alias("n_rows"), F.sum("trip_id").alias("sum_trip_id"),
            F.round(F.sum("total_amount"), 2).alias("sum_total"))
        rows = r if rows is None else rows.unionByName(r)
    return rows.join(measured.where("size_mb > 0").select("format"), "format")


def truncated_copy(spark, folder: str, name: str, most: int) -> None:
    """Half of the folder's first data file under a new name, through the folder's own file system."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    first = min((st.getPath().getName(), st.getLen()) for st in fs.listStatus(root) if st.getPath().getName().endswith(".parquet"))
    half = min(first[1], most) // 2
    read = fs.open(sc._jvm.org.apache.hadoop.fs.Path(root, first[0]))
    try:
        data = bytes(sc._jvm.org.apache.commons.io.IOUtils.toByteArray(read, half))
    finally:
        read.close()
    out = fs.create(sc._jvm.org.apache.hadoop.fs.Path(root, name), True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


@register("file_health", """
SELECT folder, n AS files, tiny AS tiny_files, bad AS bad_files
FROM (VALUES ('tiny', 2::BIGINT, 2::BIGINT, 1::BIGINT)) AS v(folder, n, tiny, bad)
UNION ALL SELECT 'trips', 4::BIGINT, NULL, 0::BIGINT FROM region WHERE r_regionkey = 0""")
def q_file_health(spark, sf_dir):
    """Four healthy files of a written table, a tiny file and a truncated copy of
    the tiny file (a bounded number of bytes, whatever the scale). A file of the
    table is a folder of parts: every task deals its rows among the four in turn,
    so that none gets a quarter of the table."""
    path = scratch_path(spark, "health")
    turn = F.pmod(F.spark_partition_id() + F.monotonically_increasing_id(), F.lit(4))
    trips_li(spark, sf_dir).withColumn("file", turn).write.partitionBy("file").parquet(f"{path}/trips")
    table(spark, sf_dir, "region").coalesce(1).write.parquet(f"{path}/tiny")
    truncated_copy(spark, f"{path}/tiny", "truncated-copy.parquet", formats.TINY_FILE_BYTES)
    h = formats.whole_files(formats.file_health(spark, path))
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return h.groupBy(folder.alias("folder")).agg(
        F.count("*").alias("files"), F.when(folder == "tiny", F.count_if("is_tiny")).alias("tiny_files"),
        F.count_if("is_bad").alias("bad_files"))


# ------------------------------------------------------------------- scalars

@register("scalar_time", with_ctes(TRIPS_EV_SQL, body="""
SELECT trip_id, year(pickup_datetime)::INTEGER AS year, month(pickup_datetime)::INTEGER AS month,
  day(pickup_datetime)::INTEGER AS day, hour(pickup_datetime)::INTEGER AS hour,
  (isodow(pickup_datetime) - 1)::INTEGER AS weekday, date_trunc('hour', pickup_datetime) AS pickup_hour,
  CAST(pickup_datetime AS DATE) AS pickup_date,
  round(date_diff('microsecond', pickup_datetime, dropoff_datetime) / 3.6e9, 9) AS hours,
  pickup_datetime - INTERVAL 1 HOUR AS minus_1h, dropoff_datetime + INTERVAL 1 HOUR AS plus_1h,
  strftime(pickup_datetime, '%H:%M:%S') AS hms,
  CASE WHEN strftime(pickup_datetime, '%f') = '000000' THEN strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S') || '.' || strftime(pickup_datetime, '%f') END AS iso,
  pickup_datetime AS reparsed
FROM trips_ev"""))
def q_scalar_time(spark, sf_dir):
    t = trips_ev(spark, sf_dir)
    p = F.col("pickup_datetime")
    return t.select(
        "trip_id", F.year(p).alias("year"), F.month(p).alias("month"), F.dayofmonth(p).alias("day"),
        F.hour(p).alias("hour"), T.weekday_mon0(p).alias("weekday"), T.floor_hour(p).alias("pickup_hour"),
        F.to_date(p).alias("pickup_date"),
        F.round(T.hours_between(p, "dropoff_datetime"), 9).alias("hours"),
        (p - F.expr("INTERVAL 1 HOUR")).alias("minus_1h"),
        (F.col("dropoff_datetime") + F.expr("INTERVAL 1 HOUR")).alias("plus_1h"),
        F.date_format(p, "HH:mm:ss").alias("hms"), T.iso_text(p).alias("iso"),
        T.parse_time(T.iso_text(p)).alias("reparsed"))


SCALAR_TEXT_SQL = """tx AS (
  SELECT trip_id, total_amount AS v,
    CASE trip_id % 5 WHEN 0 THEN CAST(total_amount AS VARCHAR) WHEN 1 THEN 'NaN' WHEN 2 THEN ''
         WHEN 3 THEN ' ' || CAST(total_amount AS VARCHAR) || ' ' ELSE 'abc' END AS t1,
    CAST(total_amount / 2 AS VARCHAR) AS t2
  FROM trips_ev)"""


@register("scalar_numeric", with_ctes(TRIPS_EV_SQL, SCALAR_TEXT_SQL, """px AS (
  SELECT trip_id, v, t2,
    CASE WHEN isfinite(TRY_CAST(trim(t1) AS DOUBLE)) THEN TRY_CAST(trim(t1) AS DOUBLE) END AS c1,
    CASE WHEN isfinite(TRY_CAST(t2 AS DOUBLE)) THEN TRY_CAST(t2 AS DOUBLE) END AS c2
  FROM tx)""", body="""
SELECT trip_id,
  coalesce(CASE WHEN c1 >= 5.0 THEN c1 END, CASE WHEN c2 >= 5.0 THEN c2 END, 0.0) AS picked,
  CAST(trunc(v) AS INTEGER) AS as_int,
  greatest(0.0, v - 100.0) AS clamped,
  round_even((trip_id % 40) / 4.0, 1) AS rounded,
  CASE WHEN v - v <> 0 THEN v / (v - v) END AS guarded,
  CAST(trunc(255.0 * greatest(0.0, -((v - 50.0) / 500.0))) AS INTEGER) AS red,
  CAST(trunc(255.0 * (1.0 - abs((v - 50.0) / 500.0))) AS INTEGER) AS green
FROM px"""))
def q_scalar_numeric(spark, sf_dir):
    t = trips_ev(spark, sf_dir)
    v = F.col("total_amount")
    tid = F.col("trip_id")
    t1 = (F.when(tid % 5 == 0, v.cast("string")).when(tid % 5 == 1, F.lit("NaN")).when(tid % 5 == 2, F.lit(""))
           .when(tid % 5 == 3, F.concat(F.lit(" "), v.cast("string"), F.lit(" "))).otherwise(F.lit("abc")))
    t2 = (v / 2).cast("string")
    norm = (v - 50.0) / 500.0
    colour = N.colour_triple(norm)
    return t.select(
        "trip_id",
        N.pick_float(t1, t2, default=0.0, min_value=5.0).alias("picked"),
        N.to_int(v).alias("as_int"),
        F.greatest(F.lit(0.0), v - 100.0).alias("clamped"),
        F.bround((tid % 40) / 4.0, 1).alias("rounded"),
        F.try_divide(v, v - v).alias("guarded"),
        colour[0].alias("red"), colour[1].alias("green"))
