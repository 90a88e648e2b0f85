import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kerbflow.sources import files, formats, ledger
from kerbflow.schema import Service


def test_file_health(spark, tmp_dir):
    spark.range(0, 50000).withColumn("x", F.rand(1)).repartition(2).write.parquet(f"{tmp_dir}/t")
    spark.range(0, 3).write.parquet(f"{tmp_dir}/tiny")
    part = sorted(f for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".parquet"))[0]
    data = open(f"{tmp_dir}/t/{part}", "rb").read()
    open(f"{tmp_dir}/t/cut.parquet", "wb").write(data[: len(data) // 2])
    h = {os.path.basename(r["path"]): r for r in formats.file_health(spark, tmp_dir).collect()}
    assert h["cut.parquet"]["is_bad"]
    assert sum(1 for k, r in h.items() if not r["is_bad"]) >= 3
    assert any(r["is_tiny"] for k, r in h.items() if k != "cut.parquet")
    counts, examples = formats.file_health_report(formats.file_health(spark, tmp_dir))
    c = counts.first()
    assert c["bad_files"] == 1 and c["tiny_files"] >= 1
    assert examples.where("kind = 'bad'").count() == 1


def test_whole_files_join_the_parts_of_a_folder(spark, tmp_dir):
    spark.range(0, 40000, 1, 3).withColumn("x", F.rand(1)).withColumn("file", F.expr("id % 2")).write.partitionBy("file").parquet(f"{tmp_dir}/t")
    spark.range(0, 3).coalesce(1).write.parquet(f"{tmp_dir}/small")
    parts = sorted(f for f in os.listdir(f"{tmp_dir}/t/file=1") if f.endswith(".parquet"))
    data = open(f"{tmp_dir}/t/file=1/{parts[0]}", "rb").read()
    open(f"{tmp_dir}/t/file=1/cut.parquet", "wb").write(data[: len(data) // 2])
    parts_ = formats.file_health(spark, tmp_dir).collect()
    got = {r["path"].split(tmp_dir)[1].split("/part-")[0]: r for r in formats.whole_files(formats.file_health(spark, tmp_dir)).collect()}
    assert {k: (r["parts"], r["is_bad"], r["is_tiny"]) for k, r in got.items()} == {
        "/t/file=0": (3, False, False), "/t/file=1": (4, True, False), "/small": (1, False, True)}
    assert sum(r["length"] for r in got.values()) == sum(r["length"] for r in parts_) and got["/t/file=1"]["error"]


def test_no_task_writes_a_quarter_of_the_table_whose_health_is_asked(spark, tmp_dir, monkeypatch):
    from kerbflow.plans import q_io
    trips = spark.range(0, 800, 1, 16).selectExpr("CAST(NULL AS long) AS trip_id", "id % 3 AS x")
    monkeypatch.setattr(q_io, "trips_li", lambda *_: trips)
    monkeypatch.setattr(q_io, "scratch_path", lambda *_: f"{tmp_dir}/h")
    got = {r["folder"]: (r["files"], r["tiny_files"], r["bad_files"]) for r in q_io.q_file_health(spark, SF_SMALL).collect()}
    assert got == {"trips": (4, None, 0), "tiny": (2, 2, 1)}
    sizes = (spark.read.parquet(f"{tmp_dir}/h/trips").groupBy(F.input_file_name()).count()).collect()
    assert sum(r["count"] for r in sizes) == 800 and max(r["count"] for r in sizes) <= 800 // 16


def test_ingest_skips_and_renames(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    df = spark.createDataFrame([(1, "2019-03-01 10:00:00", "2019-03-01 10:20:00", 5),
                                (2, "2018-03-01 10:00:00", "2018-03-01 10:20:00", 6)],
                               "id int, a string, b string, PULocationID int")
    df = df.selectExpr("id", "cast(a as timestamp_ntz) as Tpep_Pickup_Datetime",
                       "cast(b as timestamp_ntz) as tpep_dropoff_datetime", "PULocationID",
                       "concat('yellow_tripdata_', year(cast(a as timestamp_ntz))) as file")
    df.write.partitionBy("file").parquet(f"{raw}/yellow_tripdata_x")
    df.select("id", "file").write.partitionBy("file").parquet(f"{raw}/green_tripdata_x")   # no time columns
    cat = (Service("yellow", 2019, 2025, "tpep_pickup_datetime", "tpep_dropoff_datetime"),
           Service("green", 2016, 2025, "lpep_pickup_datetime", "lpep_dropoff_datetime"))
    res = files.ingest_all(spark, raw, f"{tmp_dir}/out", cat)
    assert res["green"] is None
    back = files.read_trips(spark, res["yellow"]).collect()
    assert [(r["id"], r["year"], r["pulocationid"]) for r in back] == [(1, 2019, 5)]
    assert "pickup_datetime" in back[0].asDict()


def test_ingest_reads_each_file_by_itself(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    base = "select 1L id, timestamp_ntz'{y}-03-01 10:00:00' pickup_datetime, timestamp_ntz'{y}-03-01 10:20:00' Dropoff_Datetime, {f} airport_fee"
    for y, fee in ((2019, "2"), (2020, "2.5D"), (2021, "'3.5'"), (2022, "'x'")):
        spark.sql(base.format(y=y, f=fee)).coalesce(1).write.parquet(f"{raw}/fhv_tripdata_{y}-01.parquet")
    spark.sql("select 1L id").coalesce(1).write.parquet(f"{raw}/fhv_tripdata_2023-01.parquet")
    os.makedirs(f"{raw}/fhv_tripdata_2024-01.parquet")
    with open(f"{raw}/fhv_tripdata_2024-01.parquet/cut.parquet", "wb") as f:
        f.write(b"PAR1 not a parquet file")
    cat = (Service("fhv", 2016, 2025, "pickup_datetime", "dropoff_datetime"), Service("green", 2016, 2025, "a", "b"))
    res = files.ingest_all(spark, raw, f"{tmp_dir}/out", cat)
    back = {r.year: r.airport_fee for r in files.read_trips(spark, res["fhv"]).collect()}
    assert back == {2019: 2.0, 2020: 2.5, 2021: 3.5, 2022: None} and res["green"] is None
    left = {r.path.split("/")[-2][:16]: r.reason for r in files.ingest_rejects(spark, f"{tmp_dir}/out", cat).collect()}
    assert set(left) == {"fhv_tripdata_202"} and len(files.ingest_rejects(spark, f"{tmp_dir}/out", cat).collect()) == 2
    reasons = sorted(r.reason for r in files.ingest_rejects(spark, f"{tmp_dir}/out", cat).collect())
    assert reasons[0].startswith("unreadable") and reasons[1] == "without pickup_datetime, dropoff_datetime"


def trips_file(spark, raw, year, zone="1", name="fhv", more=(), rows=5):
    (spark.range(rows).selectExpr("id", f"timestamp_ntz'{year}-03-01 10:00:00' as pickup_datetime",
                                  f"timestamp_ntz'{year}-03-01 10:20:00' as dropoff_datetime", f"{zone} as PUlocationID", *more)
     .coalesce(1).write.mode("overwrite").parquet(f"{raw}/{name}_tripdata_{year}-01.parquet"))


FHV = (Service("fhv", 2016, 2025, "pickup_datetime", "dropoff_datetime"),)


def table(spark, out):
    return sorted(tuple(r) for r in files.read_ingested(spark, out, "fhv").select("id", "pulocationid", "year").collect())


def test_a_second_run_adds_only_what_is_new(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    assert files.ingest_all(spark, raw, out, FHV) == {"fhv": None}
    assert files.read_ingested(spark, out, "fhv") is None
    trips_file(spark, raw, 2019)
    files.ingest_all(spark, raw, out, FHV)
    once = table(spark, out)
    assert len(once) == 5
    for _ in range(2):
        files.ingest_all(spark, raw, out, FHV)
        assert table(spark, out) == once
    trips_file(spark, raw, 2020, rows=2)
    files.ingest_all(spark, raw, out, FHV)
    assert len(table(spark, out)) == 7
    assert sum(r.rows for r in ledger.read_ledger(spark, out, "fhv").collect()) == 7


def test_a_run_cut_off_before_its_ledger_is_not_seen_and_is_written_over(spark, tmp_dir, monkeypatch):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    trips_file(spark, raw, 2019)

    def lost(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(ledger, "commit", lost)
        with pytest.raises(RuntimeError):
            files.ingest_all(spark, raw, out, FHV)
    assert len(spark.read.parquet(f"{out}/fhv_partitioned").collect()) == 5
    assert files.read_ingested(spark, out, "fhv") is None
    trips_file(spark, raw, 2020)                        # a later run has other files: the rows left over stay unseen
    files.ingest_all(spark, raw, out, FHV)
    assert len(table(spark, out)) == 10


def test_types_widen_over_files_and_runs(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    trips_file(spark, raw, 2019, "cast(7 as int)", more=["cast(1 as smallint) n", "date'2020-01-01' d", "true b"])
    trips_file(spark, raw, 2020, "cast(8 as bigint)", more=["1.5f n", "timestamp_ntz'2020-01-01 01:00:00' d", "'x' b"])
    files.ingest_all(spark, raw, out, FHV)
    df = files.read_ingested(spark, out, "fhv")
    kind = {x.name: x.dataType.simpleString() for x in df.schema}
    assert (kind["pulocationid"], kind["n"], kind["d"], kind["b"]) == ("bigint", "double", "timestamp_ntz", "string")
    assert {r[1] for r in table(spark, out)} == {7, 8}
    trips_file(spark, raw, 2021, "'9'")                 # text from now on; the batch before keeps its own files
    files.ingest_all(spark, raw, out, FHV)
    assert {r[1] for r in table(spark, out)} == {"7", "8", "9"}
    trips_file(spark, raw, 2022, "10")                  # a narrower type later changes nothing
    files.ingest_all(spark, raw, out, FHV)
    assert {r[1] for r in table(spark, out)} == {"7", "8", "9", "10"}
    assert files.read_ingested(spark, out, "fhv").where("n is not null").count() == 10


def test_changed_files_are_told_and_rejects_looked_at_again(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    trips_file(spark, raw, 2019)
    spark.range(3).coalesce(1).write.parquet(f"{raw}/fhv_tripdata_2020-01.parquet")
    files.ingest_all(spark, raw, out, FHV)
    assert [r.reason for r in files.ingest_rejects(spark, out, FHV).collect()] == ["without pickup_datetime, dropoff_datetime"]
    part = next(f for f in os.listdir(f"{raw}/fhv_tripdata_2020-01.parquet") if f.endswith(".parquet"))
    good = next(f for f in os.listdir(f"{raw}/fhv_tripdata_2019-01.parquet") if f.endswith(".parquet"))
    trips_file(spark, raw, 2023)
    new = next(f for f in os.listdir(f"{raw}/fhv_tripdata_2023-01.parquet") if f.endswith(".parquet"))
    data = open(f"{raw}/fhv_tripdata_2023-01.parquet/{new}", "rb").read()
    for folder, name in (("2020", part), ("2019", good)):
        crc = f"{raw}/fhv_tripdata_{folder}-01.parquet/.{name}.crc"
        if os.path.exists(crc):
            os.remove(crc)
        open(f"{raw}/fhv_tripdata_{folder}-01.parquet/{name}", "wb").write(data)
        os.utime(f"{raw}/fhv_tripdata_{folder}-01.parquet/{name}", (2e9, 2e9))
    files.ingest_all(spark, raw, out, FHV)
    assert len(table(spark, out)) == 15                 # 2019 as it was, the mended file, 2023
    assert [r.reason for r in files.ingest_rejects(spark, out, FHV).collect()] == ["changed since it was ingested"]


@pytest.mark.parametrize("a,b,want", [("int", "bigint", "bigint"), ("bigint", "double", "double"), ("int", "float", "double"),
                                      ("float", "double", "double"), ("double", "string", "string"), ("timestamp_ntz", "timestamp", "timestamp"),
                                      ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "timestamp", "string"), ("boolean", "int", "string"),
                                      ("void", "int", "int"), ("decimal(10,2)", "int", "double"), ("decimal(10,2)", "decimal(10,2)", "decimal(10,2)"),
                                      ("tinyint", "smallint", "smallint"), ("array<int>", "array<bigint>", "string")])
def test_the_order_of_types(a, b, want):
    assert ledger.wider(a, b) == ledger.wider(b, a) == want


def test_the_order_of_types_is_a_lattice():
    kinds = ["void", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp_ntz", "timestamp", "boolean", "string", "decimal(5,1)"]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                assert ledger.wider(ledger.wider(a, b), c) == ledger.wider(a, ledger.wider(b, c)), (a, b, c)


def test_reading_back_a_damaged_table_fails(spark, tmp_dir):
    spark.range(1000).repartition(4).write.parquet(f"{tmp_dir}/t")
    part = sorted(f for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".parquet"))[0]
    os.remove(f"{tmp_dir}/t/.{part}.crc")
    data = open(f"{tmp_dir}/t/{part}", "rb").read()
    open(f"{tmp_dir}/t/{part}", "wb").write(data[: len(data) // 2])
    with pytest.raises(Exception):
        files.read_trips(spark, f"{tmp_dir}/t").count()


def test_format_compare(spark, tmp_dir):
    df = spark.range(0, 2000).withColumn("x", F.col("id") * 1.5)
    out = {r["format"]: r for r in formats.format_compare(df, tmp_dir, ["csv", "csv_gzip", "parquet_zstd"]).collect()}
    assert set(out) == {"csv", "csv_gzip", "parquet_zstd"}
    assert out["csv_gzip"]["size_mb"] < out["csv"]["size_mb"]


def test_raw_files_join_the_trips_once(spark, tmp_dir, monkeypatch):
    import datetime as dt

    from kerbflow.plans import q_io
    day = lambda i: dt.datetime(1998, 1, 1) + dt.timedelta(days=200 * (i % 8))       # noqa: E731
    orders = [(i, i, day(i)) for i in range(40)]
    lines = [(i % 40, 1 + i // 40, i, "ANR"[i % 3], day(i) + dt.timedelta(days=3), 5.0, 10.0, 0.1, 0.2) for i in range(160)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string, l_shipdate timestamp_ntz, l_quantity double, "
                                 "l_extendedprice double, l_discount double, l_tax double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    seen, write = [], q_io.write_raw_service

    def spy(t, svc, raw):
        seen.append((svc.name, t.storageLevel.useDisk, "InMemoryTableScan" in t._jdf.queryExecution().executedPlan().toString()))
        write(t, svc, raw)
    monkeypatch.setattr(q_io, "write_raw_service", spy)
    raw = q_io.write_raw(spark, tmp_dir)
    assert seen == [(s.name, True, True) for s in q_io.TEST_SERVICES]
    assert sum(spark.read.parquet(f"{raw}/{s.name}_tripdata_all").count() for s in q_io.TEST_SERVICES) == 160
