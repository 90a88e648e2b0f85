"""State that is kept by micro-batch: a message counter, small values and tables.

A step of a stream (``foreachBatch``) reads the state that the batch before left
and writes its own under ``batch_id=<n>``, the small values last. A batch that is
run again after a failure starts from the same state and writes over the same
folders, so what it counts and emits does not change.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.operators.ranking import with_position
from kerbflow.session import path_exists


class BatchState:
    """``<folder>/batch_id=<n>/values.json`` and tables beside it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def table(self, batch_id: int, name: str) -> str:
        return f"{self.folder}/batch_id={batch_id}/{name}"

    def save(self, batch_id: int, values: dict) -> None:
        fs, path = self._fs(self.table(batch_id, "values.json"))
        out = fs.create(path, True)
        try:
            out.write(bytearray(json.dumps(values).encode("utf-8")))
        finally:
            out.close()

    def load(self, batch_id: int) -> dict | None:
        """The values that batch ``batch_id`` left; None before the first one.

        A missing state of a later batch raises: to start anew would lose the model and the count in silence.
        """
        if batch_id < 0:
            return None
        path = self.table(batch_id, "values.json")
        if not path_exists(self.spark, path):
            raise RuntimeError(f"{path} is missing: the stream's state does not fit its checkpoint")
        fs, p = self._fs(path)
        read = fs.open(p)
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(read)).decode("utf-8"))
        finally:
            read.close()


ORDER = ("offset", "topic", "partition")


def numbered(batch: DataFrame, first: int, order=ORDER, name: str = "n") -> DataFrame:
    """The batch with each message's number: its rank by ``order`` within the batch, from ``first`` on.

    ``order`` has to agree with the order in which the source hands out messages (of a replay, the offset); then the
    numbers do not depend on where batches are cut.
    """
    return with_position(batch, [c for c in order if c in batch.columns], name=name).withColumn(name, F.col(name) + F.lit(first))
