"""Format comparison (size and full-read time) and file health checks."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {
    # name: (writer format, options, reader)
    "csv": ("csv", {"header": "true"}, "csv"),
    "csv_gzip": ("csv", {"header": "true", "compression": "gzip"}, "csv"),
    "json": ("json", {}, "json"),
    "orc": ("orc", {}, "orc"),
    "parquet_snappy": ("parquet", {"compression": "snappy"}, "parquet"),
    "parquet_zstd": ("parquet", {"compression": "zstd"}, "parquet"),
}

# Files below this size are reported as tiny.
TINY_FILE_BYTES = 10_000


def files_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of every file under ``path``; file content is not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", glob).load(path).select("path", "length"))


def format_compare(df: DataFrame, base: str, formats=None) -> DataFrame:
    """Write ``df`` in each format, then measure total size (MB) and the time
    of a full read (``noop`` sink forces every row and column to be decoded)."""
    spark = df.sparkSession
    rows = []
    for name in (formats or list(FORMATS)):
        fmt, opts, _ = FORMATS[name]
        path = f"{base.rstrip('/')}/{name}"
        w = df.write.mode("overwrite").format(fmt)
        for k, v in opts.items():
            w = w.option(k, v)
        w.save(path)
        size = files_listing(spark, path).where(~F.col("path").rlike(r"/(_SUCCESS|\.[^/]*)$")) \
            .agg(F.sum("length")).first()[0] or 0
        t0 = time.time()
        read_back(spark, base, name, df.schema).write.format("noop").mode("overwrite").save()
        rows.append((name, round(size / (1024 * 1024), 3), round(time.time() - t0, 3)))
    return spark.createDataFrame(rows, "format string, size_mb double, read_seconds double")


def read_back(spark: SparkSession, base: str, name: str, schema) -> DataFrame:
    """What :func:`format_compare` wrote below ``base`` in one format."""
    reader = FORMATS[name][2]
    r = spark.read.format(reader).schema(schema)
    if reader == "csv":
        r = r.option("header", "true")
    return r.load(f"{base.rstrip('/')}/{name}")


def _footer_check(batches):
    import pandas as pd
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs
    for pdf in batches:
        bad, err = [], []
        for p in pdf["path"]:
            try:
                if p.startswith("file:"):
                    pq.ParquetFile(p[len("file:"):]).metadata
                else:
                    filesystem, inner = pafs.FileSystem.from_uri(p)
                    with filesystem.open_input_file(inner) as fh:
                        pq.ParquetFile(fh).metadata
                bad.append(False)
                err.append(None)
            except Exception as e:  # noqa: BLE001 - a broken footer is the finding
                bad.append(True)
                err.append(str(e))
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "is_bad": bad, "error": err})


def file_health(spark: SparkSession, path: str, glob: str = "*.parquet",
                tiny_threshold: int = TINY_FILE_BYTES) -> DataFrame:
    """Per file: size, tiny (< threshold bytes), footer unreadable (+ error).

    Listing is a distributed scan of file metadata; each task opens only the
    footers of its own files (pyarrow inside ``mapInPandas``)."""
    listing = files_listing(spark, path, glob)
    checked = listing.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path") \
        .mapInPandas(_footer_check, "path string, length bigint, is_bad boolean, error string")
    return checked.withColumn("is_tiny", F.col("length") < tiny_threshold)


def whole_files(health: DataFrame, tiny_threshold: int = TINY_FILE_BYTES) -> DataFrame:
    """Health per file where Spark wrote some as folders ``file=<name>`` of parts: their length is
    the sum, they are bad if a part is. A file outside such a folder stands for itself."""
    folder = F.regexp_extract("path", r"^(.*/file=[^/]*)/[^/]+$", 1)
    return (health.groupBy(F.when(folder != "", folder).otherwise(F.col("path")).alias("path"))
            .agg(F.sum("length").alias("length"), F.count("*").alias("parts"), F.bool_or("is_bad").alias("is_bad"), F.min("error").alias("error"))
            .withColumn("is_tiny", F.col("length") < tiny_threshold))


def file_health_report(health: DataFrame, examples: int = 5):
    """(counts, examples): one row of file / tiny / bad counts, and the first
    ``examples`` tiny and bad paths (top-k per kind, never a full list)."""
    counts = health.agg(F.count(F.lit(1)).alias("files"), F.count_if("is_tiny").alias("tiny_files"),
                        F.count_if("is_bad").alias("bad_files"))
    tiny = health.where("is_tiny").select(F.lit("tiny").alias("kind"), "path", "error").orderBy("path").limit(examples)
    bad = health.where("is_bad").select(F.lit("bad").alias("kind"), "path", "error").orderBy("path").limit(examples)
    return counts, tiny.unionByName(bad)
