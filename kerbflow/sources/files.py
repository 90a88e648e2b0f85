"""File scans and writes for trip data.

Layout: raw trip files per service (``<service>_tripdata_<year...>``), ingested
to ``<out>/<service>_partitioned/year=<y>/`` and cleaned to
``<out>/<service>_cleaned/year=<y>/``. Filters on ``year`` prune partitions;
filters on ``_metadata.file_path`` prune files before any byte is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.functions.numeric import clean_double
from kerbflow.schema import MONEY_COLUMNS, SERVICES, Service, conform
from kerbflow.sources import ledger

DICTIONARY_KEY, MAX_DICTIONARY_BYTES = "parquet.dictionary.page.size", 64 << 20       # a task holds one a column
ROW_GROUP_BYTES = 256 * 1024 * 1024    # ~2M trip rows per row group
OUTPUT_PARTITION_BYTES = 100 * 1024 * 1024


def read_trips(spark: SparkSession, path: str, columns=None, merge_schema: bool = False) -> DataFrame:
    """Parquet scan with partition discovery (``year=...`` folders)."""
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    return df.select(*columns) if columns else df


def year_pattern(years) -> str:
    return "(" + "|".join(str(int(y)) for y in years) + ")"


def select_service_files(df: DataFrame, prefix: str, years) -> DataFrame:
    """Rows from files whose name starts with ``<prefix>_tripdata_`` and holds
    one of ``years`` (file pruning on the metadata column)."""
    name = F.col("_metadata.file_path")
    return df.where(name.rlike(f"{prefix}_tripdata_[^/]*{year_pattern(years)}"))


# Types that ingest gives the columns it knows, whatever a file has; others get the widest type of all files (ledger.wider).
DECLARED = {**{c: "double" for c in MONEY_COLUMNS}, "trip_distance": "double"}


def declared_type(svc: Service, name: str) -> str | None:
    return "timestamp_ntz" if name in (svc.pickup_col.lower(), svc.dropoff_col.lower()) else DECLARED.get(name)


def inspect_files(spark: SparkSession, raw_dir: str, svc: Service, done: DataFrame | None = None, years=None) -> DataFrame:
    """Raw files of a service within its (or the given) years that the ledger ``done`` hasn't settled, with their footers'
    columns and rows; ``reason`` is null for good files."""
    listing = ledger.list_files(spark, f"{raw_dir.rstrip('/')}/{svc.name}_tripdata_*")
    wanted = listing.where(F.col("path").rlike(f"{svc.name}_tripdata_[^/]*{year_pattern(svc.years if years is None else years)}"))
    done = spark.createDataFrame([], ledger.LEDGER) if done is None else done
    return ledger.inspect_new(wanted, done, [svc.pickup_col, svc.dropoff_col])


def as_type(c, have, want: str):
    return clean_double(c, have) if want == "double" else c.cast(want)


def scan_service(spark: SparkSession, svc: Service, files: DataFrame, earlier=()) -> DataFrame | None:
    """All good raw files of one service (rows of a ledger or of ``inspect_files``), or None when there is none.

    Files are read in groups of one schema each, so a type that changed between
    years is no obstacle: columns get their declared type or the widest of those
    in the files and in ``earlier`` tables of {column: type}.
    """
    groups: dict[str, list[str]] = {}
    for r in files.where("reason IS NULL").select("columns", "path").toLocalIterator():     # file names: metadata
        groups.setdefault(r["columns"], []).append(r["path"])
    frames = [spark.read.parquet(*sorted(paths)) for _, paths in sorted(groups.items())]
    frames = [f.toDF(*[c.lower() for c in f.columns]) for f in frames]
    if not frames:
        return None
    here = [{x.name: x.dataType.simpleString() for x in f.schema} for f in frames]
    types = {c: declared_type(svc, c) or t for c, t in ledger.common_types([*here, *earlier]).items()}
    names = ledger.common_types(here)
    out = None
    for f in frames:
        part = f.select(*[(as_type(F.col(f"`{n}`"), f.schema[n].dataType, types[n]) if n in f.columns else F.lit(None).cast(types[n])).alias(n)
                          for n in names])
        out = part if out is None else out.unionByName(part)
    return out


def raw_names(svc: Service, types: dict[str, str]) -> dict[str, str]:
    """Types by the raw files' names of the time columns, from those of the ingested table."""
    back = {"pickup_datetime": svc.pickup_col.lower(), "dropoff_datetime": svc.dropoff_col.lower()}
    return {back.get(c, c): t for c, t in types.items()}


def ingest_service(spark: SparkSession, raw_dir: str, svc: Service, out_dir: str, years=None) -> str | None:
    """Raw files that no earlier run has settled -> lower-case names, common time columns -> a batch of
    ``<out>/<service>_partitioned``, partitioned by year and batch, then the ledger.

    Files that are left out are in the ledger with the reason. The target, or None before it holds any batch.
    """
    base = out_dir.rstrip("/")
    done = ledger.read_ledger(spark, base, svc.name)
    found = inspect_files(spark, raw_dir, svc, done, years).persist()
    target = f"{base}/{svc.name}_partitioned"
    try:
        written = ledger.batches(done)
        df = scan_service(spark, svc, found, [raw_names(svc, t) for t, _ in written])
        batch, types = None, {}
        if df is not None:
            batch = ledger.batch_id(found.where("reason IS NULL"))
            df = conform(df, svc)
            types = {x.name: x.dataType.simpleString() for x in df.schema if x.name != "year"}
            (df.withColumn("batch", F.lit(batch)).hint("rebalance", "year").write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").option("parquet.block.size", ROW_GROUP_BYTES)
                .partitionBy("year", "batch").parquet(target))
        if not found.isEmpty():
            ledger.commit(found, base, svc.name, batch, types)
        return target if written or df is not None else None
    finally:
        found.unpersist()


def read_ingested(spark: SparkSession, out_dir: str, service: str) -> DataFrame | None:
    """The batches of a service that its ledger names, in the widest types of all; None without any.

    Batches are read by the types they were written with, so no file is read as what it isn't; filters on
    ``year`` and the list of batches prune partitions.
    """
    versions = ledger.batches(ledger.read_ledger(spark, out_dir, service))
    types, out = ledger.common_types([t for t, _ in versions]), None
    for have, names in versions:
        schema = ", ".join(f"`{c}` {t}" for c, t in have.items()) + ", year int, batch string"
        df = spark.read.schema(schema).parquet(f"{out_dir.rstrip('/')}/{service}_partitioned").where(F.col("batch").isin(names))
        part = df.select(*[(as_type(F.col(f"`{c}`"), df.schema[c].dataType, t) if have.get(c, t) != t else
                            F.col(f"`{c}`") if c in have else F.lit(None).cast(t)).alias(c) for c, t in types.items()], "year")
        out = part if out is None else out.unionByName(part)
    return out


def ingest_all(spark: SparkSession, raw_dir: str, out_dir: str, catalogue=SERVICES) -> dict:
    """Ingest every service of the catalogue; returns {service: target or None}."""
    return {s.name: ingest_service(spark, raw_dir, s, out_dir) for s in catalogue}


def ingest_rejects(spark: SparkSession, out_dir: str, catalogue=SERVICES) -> DataFrame:
    """(service, path, reason) of the files that ingest left out, each as its last run found it."""
    out = None
    for svc in catalogue:
        rows = ledger.read_ledger(spark, out_dir, svc.name)
        out = rows if out is None else out.unionByName(rows)
    last = out.groupBy("service", "path").agg(F.max_by("reason", F.struct("modified", "length")).alias("reason"),
                                              F.count_if(F.col("reason").isNull()).alias("taken"))
    return last.where("reason IS NOT NULL AND (taken = 0 OR reason LIKE 'changed%')").select("service", "path", "reason")


def read_partition(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year of a partitioned table (partition pruning on ``year``)."""
    return read_trips(spark, path).where(F.col("year") == int(year))


def read_ingested_year(spark: SparkSession, out_dir: str, service: str, year: int) -> DataFrame:
    """One year of an ingested table: its committed batches alone, other years' folders pruned."""
    return read_ingested(spark, out_dir, service).where(F.col("year") == int(year))


def list_dirs(spark: SparkSession, base: str, suffix: str = "") -> list[str]:
    """Names of the sub-folders of ``base`` ending in ``suffix`` (sorted);
    a metadata listing through the Hadoop FileSystem, no data read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory()]
    return sorted(n for n in names if n.endswith(suffix))


def read_services(spark: SparkSession, base: str, suffix: str = "_partitioned") -> DataFrame:
    """Every ``*<suffix>`` table under ``base`` as one frame with ``service``; year filters prune.

    Of an ingested table the committed batches are read; one that was written without ingest is read as it is.
    """
    out = None
    for name in list_dirs(spark, base, suffix):
        svc = name[: -len(suffix)] if suffix else name
        df = read_ingested(spark, base, svc)
        if df is None:
            df = read_trips(spark, f"{base.rstrip('/')}/{name}", merge_schema=True)
            df = None if "batch" in df.columns else df          # batches that no ledger names: a run that was cut off
        if df is not None:
            df = df.withColumn("service", F.lit(svc))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no *{suffix} tables under {base}")
    return out


def write_year_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Year-partitioned Parquet; ``overwrite`` replaces only the years present
    (dynamic partition overwrite)."""
    (df.hint("rebalance", "year").write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("year").parquet(path))
    return path


def write_rebalanced(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Flat overwrite with ~100 MB output files (AQE rebalance, no full sort)."""
    spark = df.sparkSession
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OUTPUT_PARTITION_BYTES))
    try:
        df.hint("rebalance").write.mode("overwrite").format(fmt).save(path)
    finally:
        spark.conf.set(key, before)
    return path


def dictionary_holds(spark: SparkSession, values: DataFrame, col: str) -> int:
    """Lets the session's Parquet writers keep all of ``values``' texts ``col`` in a column's dictionary; returns its limit in bytes.

    Beyond that limit (1 MB, if nothing else is set) a writer gives up the dictionary and writes the text of every row in
    full: a few long texts that come with each of many rows would take their length times the rows. It is raised to what the
    texts take, never lowered, and left as it is if they take more than ``MAX_DICTIONARY_BYTES``.
    """
    taken = values.agg(F.coalesce(F.sum(F.octet_length(col) + 4), F.lit(0))).first()[0]
    limit = int(spark.conf.get(DICTIONARY_KEY, str(1 << 20)))
    needed = ((taken >> 20) + 2) << 20
    if taken > limit >> 1 and limit < needed <= MAX_DICTIONARY_BYTES:
        spark.conf.set(DICTIONARY_KEY, str(needed))
        limit = needed
    return limit


def write_csv(df: DataFrame, path: str, gzip: bool = False) -> str:
    w = df.write.mode("overwrite").option("header", "true")
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)
    return path


def write_summary_json(summary: DataFrame, path: str) -> str:
    """The per-service summary document (nested arrays as JSON)."""
    summary.write.mode("overwrite").json(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str, timestamp_format: str | None = None) -> DataFrame:
    """CSV with a declared schema (never inferred); unparsable fields are null."""
    r = spark.read.option("header", "true").option("mode", "PERMISSIVE").schema(schema)
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format)
    return r.csv(path)
