"""Run the rolling-statistics stream and read its results back.

The aggregation runs in complete mode (its output is the whole per-zone
state, hundreds of rows); ``foreachBatch`` writes that state snapshot under a
``batch_id=<n>`` folder, and the periodic reports (top/bottom zones, boroughs)
are derived from the snapshots. Re-running a batch after a
failure overwrites the same folder, so the sink is idempotent and recovery
from the checkpoint gives exactly-once results.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from kerbflow.streaming import stats
from kerbflow.streaming.messages import good_messages, parse_messages


def _latest(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("batch_id") == df.agg(F.max("batch_id")).scalar()).drop("batch_id")


STATE_PARTITIONS = 8      # state is one row per zone: a few partitions at any input size; a parameter for more zones
LISTEN_SECONDS = 120      # within which the listener must have heard of a query's end


def run_rolling_stats(source: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True,
                      processing_time: str | None = None, state_partitions: int = STATE_PARTITIONS):
    """Start the stream; with ``available_now`` it drains its input and stops.

    Each micro-batch writes the per-zone state snapshot to
    ``<out_dir>/zone_state/batch_id=<n>``; reports are derived from snapshots.
    Returns the StreamingQuery (already terminated when ``available_now``)."""
    parsed = good_messages(parse_messages(source))
    agg = stats.zone_state(parsed)

    def sink(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_dir}/zone_state/batch_id={batch_id}")

    w = agg.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    # The stateful stage's partition count is fixed at the first start (kept
    # in the checkpoint); map-side partial aggregation means only per-task
    # per-zone partials are shuffled, so few partitions suffice.
    spark = source.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    listener = ProgressTable(spark, f"{out_dir}/progress")
    spark.streams.addListener(listener)
    try:
        q = w.start()
        listener.follow(q)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    if available_now:
        try:
            q.awaitTermination()
            listener.wait()
        finally:
            spark.streams.removeListener(listener)
        if q.exception():
            raise RuntimeError(str(q.exception()))
    return q


PROGRESS_SCHEMA = ("batch_id long, input_rows long, input_rows_per_s double, processed_rows_per_s double, "
                   "trigger_ms long, add_batch_ms long")


class ProgressTable(StreamingQueryListener):
    """Writes the progress of one query to a table as it comes: a line of JSON per micro-batch, one file each, so that
    any number of batches leaves nothing on the driver and a batch that is run again is written over."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended, self.run, self.trouble = threading.Event(), None, None
        self.early: list = []
        self.lock = threading.Lock()

    def follow(self, query) -> None:
        with self.lock:
            self.run = str(query.runId)
            for event in self.early:
                self._write(event)
            self.early = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            if self.run is None:                # events can come before the query is known here
                self.early.append(event)
            else:
                self._write(event)

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            if self.run is None or str(event.runId) == self.run:
                self.ended.set()

    def _write(self, event) -> None:
        p = json.loads(event.progress.json)
        if p["runId"] != self.run:
            return
        d = p.get("durationMs") or {}
        row = {"batch_id": p["batchId"], "input_rows": p.get("numInputRows"), "input_rows_per_s": p.get("inputRowsPerSecond"),
               "processed_rows_per_s": p.get("processedRowsPerSecond"), "trigger_ms": d.get("triggerExecution"), "add_batch_ms": d.get("addBatch")}
        try:
            sc = self.spark.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch-{p['batchId']:012d}.json")
            out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
            try:
                out.write(bytearray((json.dumps(row) + "\n").encode("utf-8")))
            finally:
                out.close()
        except Exception as e:  # noqa: BLE001 - raised in ``wait``: an error in a listener is only logged
            self.trouble = e

    def wait(self) -> None:
        """Until the query's last event has been written."""
        if not self.ended.wait(LISTEN_SECONDS):
            raise RuntimeError("the progress listener did not hear of the query's end")
        if self.trouble:
            raise RuntimeError(f"progress could not be written: {self.trouble}")


def progress(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).json(f"{out_dir}/progress")


def final_state(spark: SparkSession, out_dir: str) -> DataFrame:
    return _latest(spark, f"{out_dir}/zone_state")


def state_history(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every snapshot (one per micro-batch) with its ``batch_id``."""
    return spark.read.parquet(f"{out_dir}/zone_state")


def report(state: DataFrame, section: str, zone_boroughs: DataFrame | None = None, k: int = 10,
           mode: str = "pickup", by=()) -> DataFrame:
    """One report section from state rows: ``top``, ``bottom`` or ``borough``.
    Pass ``by=["batch_id"]`` over :func:`state_history` for every periodic report."""
    if section in ("top", "bottom"):
        ranked = stats.ranked_zones(state, k, mode, top=section == "top", by=by)
        return stats.with_borough(ranked, zone_boroughs) if zone_boroughs is not None else ranked
    if section == "borough":
        return stats.borough_stats(state, zone_boroughs, by=by)
    raise ValueError(section)
