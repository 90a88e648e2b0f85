from pyspark.sql import functions as F

from kerbflow.sources import files
from kerbflow.streaming import replay


def _scan_files_read(df):
    df.collect()
    found = []

    def walk(p):
        if "Scan" in p.nodeName() and p.metrics().contains("numFiles"):
            found.append(p.metrics().apply("numFiles").value())
        it = p.children().iterator()
        while it.hasNext():
            walk(it.next())
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.finalPhysicalPlan()
    walk(plan)
    return sum(found)


def test_file_name_filter_prunes_files(spark, tmp_dir):
    for y in (2010, 2011, 2012, 2013):
        spark.range(50).coalesce(1).write.parquet(f"{tmp_dir}/yellow_tripdata_{y}-01.parquet")
    df = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
               .parquet(tmp_dir))
    sel = files.select_service_files(df, "yellow", [2012, 2013])
    assert sel.count() == 100
    assert _scan_files_read(sel) == 2


def test_replay_consumed_in_offset_order(spark, tmp_dir):
    recs = spark.range(0, 3000).select(F.lit(None).cast("string").alias("key"),
                                       F.col("id").cast("string").alias("value"), F.lit("t").alias("topic"),
                                       F.lit(0).alias("partition"), F.col("id").alias("offset"))
    path = replay.write_replay(recs.repartitionByRange(4, "offset"), f"{tmp_dir}/replay", rows_per_file=250)
    seen = []

    def sink(batch, batch_id):
        r = batch.agg(F.min("offset"), F.max("offset"), F.count(F.lit(1))).first()
        seen.append((batch_id, r[0], r[1], r[2]))

    q = (replay.replay_source(spark, path, files_per_trigger=2).writeStream.foreachBatch(sink)
               .option("checkpointLocation", f"{tmp_dir}/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    seen.sort()
    assert sum(s[3] for s in seen) == 3000
    for prev, cur in zip(seen, seen[1:]):
        assert prev[2] < cur[1]                    # every batch continues after the previous one


def test_many_files_of_one_task_replay_in_order(spark, tmp_dir):
    recs = spark.range(0, 1200, 1, 1).select(F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"),
                                             F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    path = replay.write_replay(recs, f"{tmp_dir}/replay", rows_per_file=1)
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(root)
    data = sorted((f.getModificationTime(), f.getPath().getName()) for f in found if f.getPath().getName().endswith(".parquet"))
    assert [replay.file_order(n)[1] for _, n in data] == list(range(1200))
    assert replay.file_order("part-100000-x-c010.snappy.parquet") > replay.file_order("part-99999-x-c1000.snappy.parquet")
