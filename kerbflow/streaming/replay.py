"""Time-ordered replay of several trip sources as one message flow.

The reference merges per-source iterators with a heap; here the union is
range-partitioned and sorted on (time, source, id), and each row gets its
global sequence number from per-partition offsets (no single-task window).
The result is written as Kafka-shaped records: one file per ``rows_per_file``
messages, so a file stream with ``maxFilesPerTrigger`` replays it at a fixed
number of messages per micro-batch (the throttle).
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.operators.ranking import with_position
from kerbflow.streaming.messages import KAFKA_SCHEMA

# Kafka producer tuning for throughput.
PRODUCER_OPTIONS = {
    "kafka.compression.type": "lz4",
    "kafka.linger.ms": "20",
    "kafka.batch.size": str(10_000 * 200),
    "kafka.acks": "1",
}


def select_present(df: DataFrame, wanted, time_col: str = "pickup_datetime") -> DataFrame:
    """Time column first, then the wanted columns that exist, in order."""
    cols = [time_col] + [c for c in wanted if c != time_col and c in df.columns]
    return df.select(*cols)


def merge_by_time(sources: dict, time_col: str = "pickup_datetime", id_col: str = "trip_id") -> DataFrame:
    """Union of labelled sources with ``seq``: position in (time, source, id)
    order. Rows with a null time are dropped, as the replay skips them."""
    frames = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    u = u.where(F.col(time_col).isNotNull())
    return with_position(u, [time_col, "source", id_col], name="seq")


def to_topic_records(merged: DataFrame, topics: dict, value: "F.Column", key=None) -> DataFrame:
    """Kafka record columns (key, value, topic, partition, offset): topic by
    source, offset = sequence number."""
    topic = F.lit(None).cast("string")
    for src, t in topics.items():
        topic = F.when(F.col("source") == src, F.lit(t)).otherwise(topic)
    k = key if key is not None else F.lit(None).cast("string")
    return merged.select(k.cast("string").alias("key"), value.alias("value"), topic.alias("topic"),
                         F.lit(0).alias("partition"), F.col("seq").cast("bigint").alias("offset"))


def write_replay(records: DataFrame, path: str, rows_per_file: int = 500) -> str:
    """Write records in offset order, at most ``rows_per_file`` per file.

    ``records`` come from :func:`merge_by_time`, already range-partitioned on
    the offset, so each task writes a contiguous offset run split into files
    (no count, no second shuffle). File modification times are then set in
    offset order, because the file stream source picks files oldest first."""
    (records.sortWithinPartitions("offset").write.mode("overwrite")
            .option("maxRecordsPerFile", rows_per_file).parquet(path))
    stamp_in_name_order(records.sparkSession, path)
    return path


def file_order(name: str) -> tuple[int, int]:
    """(part, file counter) of a data file as numbers; as text, part 100000 and file 1000 sort wrongly."""
    m = re.match(r"part-(\d+)-.*?-c(\d+)\b", name)
    if not m:
        raise ValueError(f"not a replay data file: {name}")
    return int(m[1]), int(m[2])


def stamp_in_name_order(spark, path: str, suffix: str = ".parquet") -> int:
    """Set modification times of the data files to increase by part, then file
    counter; returns the number of files. A file system that can't do so (object
    stores) raises: without the times the replay would run in any order."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    names = sorted((n for st in fs.listStatus(root) if (n := st.getPath().getName()).endswith(suffix)), key=file_order)
    base = int(time.time() * 1000) - len(names) * 1000
    for i, n in enumerate(names):
        fs.setTimes(sc._jvm.org.apache.hadoop.fs.Path(root, n), base + i * 1000, -1)
    return len(names)


def replay_source(spark, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Streaming read of a replay folder (same columns as the Kafka source)."""
    return (spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
                 .parquet(path))


def kafka_source(spark, servers: str, topics, starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = 500) -> DataFrame:
    """Kafka subscription to several topics as one stream (needs the
    spark-sql-kafka package on the cluster)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics)).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                           "topic", "partition", "offset")


def _kafka_options(writer, servers: str, options: dict | None):
    writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
    for k, v in {**PRODUCER_OPTIONS, **(options or {})}.items():
        writer = writer.option(k, v)
    return writer


def kafka_batch(records: DataFrame, servers: str, options: dict | None = None):
    """A batch writer of (key, value, topic) records, topic chosen per row; ``.save()`` publishes them."""
    return _kafka_options(records.select("key", "value", "topic").write, servers, options)


def kafka_sink(records: DataFrame, servers: str, checkpoint: str, options: dict | None = None):
    """Publish records to Kafka: a stream is started, a batch (as a merged replay is) is written at once."""
    if not records.isStreaming:
        return kafka_batch(records, servers, options).save()
    w = _kafka_options(records.select("key", "value", "topic").writeStream, servers, options)
    return w.option("checkpointLocation", checkpoint).start()
