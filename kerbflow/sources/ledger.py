"""The ledger of ingested files, and the order of column types.

``<out>/_ledger/<service>`` has a row per raw file that a run has looked at: its
path, length and time of change, the columns and rows of its footer, the reason
why it was left out (null for good files), the batch that holds its rows and the
types that the batch was written with. It is appended to once per run, after the
batch has been written, and a batch counts only if the ledger names it. So a run
that is repeated finds nothing new, and one that was cut off leaves rows that no
reader sees and that the next run writes anew.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = ("service string, path string, length long, modified timestamp, columns string, rows long, reason string, "
          "batch string, types string")
FOUND = "path string, length long, modified timestamp, reason string, columns string, rows long"

# Each type is narrower than those after it; types of different chains meet in text.
_CHAINS = (("tinyint", "smallint", "int", "bigint", "double"), ("float", "double"), ("date", "timestamp_ntz", "timestamp"))


def wider(a: str, b: str) -> str:
    """The narrowest type that holds the values of both."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    a, b = ("double" if x.startswith("decimal") else x for x in (a, b))
    for chain in _CHAINS:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    if "float" in (a, b) and {a, b} <= {*_CHAINS[0], "float"}:
        return "double"
    return a if a == b else "string"


def common_types(tables) -> dict[str, str]:
    """{column: type} over tables of {column: type}; columns in the order in which they come."""
    out: dict[str, str] = {}
    for types in tables:
        for name, kind in types.items():
            out[name] = wider(out.get(name, kind), kind)
    return out


def ledger_path(out_dir: str, service: str) -> str:
    return f"{out_dir.rstrip('/')}/_ledger/{service}"


def read_ledger(spark: SparkSession, out_dir: str, service: str) -> DataFrame:
    """All rows of a service's ledger; none before its first run."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger_path(out_dir, service))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, length, modified) of the Parquet files below the folders and files that match; names alone are read."""
    try:
        listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                   .load(pattern).select("path", "length", F.col("modificationTime").alias("modified")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long, modified timestamp")
    return listing


def _read_footers(batches):
    """Adds the reason why a file can't be read, its columns as 'name:type' lines, and its rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs
    for b in batches:
        reasons, columns, rows = [], [], []
        for p in b.column("path").to_pylist():
            try:
                filesystem, inner = pafs.FileSystem.from_uri(p)
                with filesystem.open_input_file(inner) as f:
                    file = pq.ParquetFile(f)
                    found = (None, "\n".join(f"{x.name}:{x.type}" for x in file.schema_arrow), file.metadata.num_rows)
            except Exception as e:  # noqa: BLE001 - an unreadable file is a finding, listed with its reason
                found = (f"unreadable: {e}", None, None)
            for col, v in zip((reasons, columns, rows), found):
                col.append(v)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(reasons, pa.string()), pa.array(columns, pa.string()), pa.array(rows, pa.int64())],
            names=[*b.schema.names, "reason", "columns", "rows"])


def inspect_new(listing: DataFrame, ledger: DataFrame, needed) -> DataFrame:
    """The listed files that no run has settled, with the columns of ``FOUND``.

    A file is settled while its length and time are those of the ledger. One whose
    rows are in the table but which has changed since is left out with that
    reason: its old rows can't be told from other files'. A file that was left
    out before and has changed is looked at again. Only footers are read, a file by
    itself, so one bad file costs no other.
    """
    seen = ledger.select("path", "length", "modified").distinct()
    new = listing.join(seen, ["path", "length", "modified"], "left_anti")
    taken = ledger.where("reason IS NULL").select("path").distinct()
    changed = new.join(taken, "path", "left_semi")
    fresh = new.join(taken, "path", "left_anti")
    found = fresh.repartition(F.col("path")).mapInArrow(_read_footers, FOUND)
    names = F.transform(F.split("columns", "\n"), lambda x: F.lower(F.regexp_extract(x, r"^(.*):", 1)))
    missing = F.array_except(F.array(*[F.lit(c.lower()) for c in needed]), names)
    found = found.withColumn("reason", F.coalesce("reason", F.when(F.size(missing) > 0, F.concat(
        F.lit("without "), F.array_join(missing, ", ")))))
    return found.unionByName(changed.select("path", "length", "modified", F.lit("changed since it was ingested").alias("reason"),
                                            F.lit(None).cast("string").alias("columns"), F.lit(None).cast("long").alias("rows")))


def batch_id(files: DataFrame) -> str:
    """The same for the same files in the same state: a run that is repeated writes over what it left."""
    marks = files.select(F.xxhash64("path", "length", "modified").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    return hashlib.sha256(f"{marks['n']} {marks['x']} {marks['s']}".encode()).hexdigest()[:16]


def commit(found: DataFrame, out_dir: str, service: str, batch: str | None, types: dict[str, str]) -> None:
    """Append the run's files to the ledger, in one file: a run is in it as a whole or not at all."""
    good = F.col("reason").isNull()
    (found.select(F.lit(service).alias("service"), "path", "length", "modified", "columns", "rows", "reason",
                  F.when(good, F.lit(batch)).alias("batch"), F.when(good, F.lit(json.dumps(types))).alias("types"))
        .coalesce(1).write.mode("append").parquet(ledger_path(out_dir, service)))


def batches(ledger: DataFrame) -> list[tuple[dict[str, str], list[str]]]:
    """[(types, batches written with them)]: one entry per version of the types, a batch per run."""
    rows = ledger.where("batch IS NOT NULL").groupBy("types").agg(F.array_sort(F.collect_set("batch")).alias("b")).collect()
    return sorted(((json.loads(r["types"]), r["b"]) for r in rows), key=lambda x: x[1])
