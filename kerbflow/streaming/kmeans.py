"""Online k-means over a message stream, independent of micro-batches.

The messages are learned in blocks of ``block`` by message number. A block's
messages are assigned to the nearest of the centres that the block before left, and
each cluster gathers a decayed feature vector: weight, linear sum and square sum
of its messages, each message faded by the number of messages after it. These
vectors are sums, so tasks' parts merge in any order. They are merged with the
cluster's own (the centre with its weight, faded by the length of the block) and
give the next centres, with which the block's messages are labelled ("learn one,
then predict one", by blocks).

Each block needs the centres of the one before, so the blocks are a chain. Blocks of
up to ``CHAIN_BLOCK`` messages are learned one after another in one task of the
micro-batch, to which the messages' numbers and features go and nothing else: a job
per block would cost far more than the block. The size of micro-batches bounds what
that task reads. Longer blocks are jobs of their own, spread over tasks.

A micro-batch goes on where the one before stopped: messages behind its last full
block wait for the next one. Centres, weights, the message counter and the waiting
messages are kept by batch (``counted.BatchState``), so batches of any cut, a batch
that is run again and a stream that is started again give the same labels.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kerbflow.session import checkpoint_root
from kerbflow.streaming.counted import BatchState, numbered
from kerbflow.streaming.messages import good_messages, parse_messages

# Features and output topic of the clusterer.
FEATURES = ("trip_distance", "passenger_count")
OUTPUT_TOPIC = "taxi_clustered"
CHAIN_BLOCK = 200_000


def initial_centres(k: int, d: int, seed: int = 42, mu: float = 0.0, sigma: float = 1.0) -> np.ndarray:
    return np.random.default_rng(seed).normal(mu, sigma, size=(k, d))


def nearest(centres: np.ndarray, features=FEATURES) -> Column:
    """Index of the closest centre (squared Euclidean), first on ties."""
    dists = []
    for i, c in enumerate(centres):
        d2 = F.lit(0.0)
        for j, f in enumerate(features):
            diff = F.col(f) - F.lit(float(c[j]))
            d2 = d2 + diff * diff
        dists.append(F.struct(d2.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*dists))["i"]


class Clusters:
    """Centres with the weight, and the faded square sum, of what they have learned."""

    def __init__(self, centres: np.ndarray, weights: np.ndarray, squares: np.ndarray):
        self.centres, self.weights, self.squares = centres, weights, squares

    @classmethod
    def start(cls, k: int, d: int, seed: int = 42):
        centres = initial_centres(k, d, seed)
        return cls(centres, np.ones(k), (centres ** 2).sum(axis=1))

    def values(self) -> dict:
        return {"centres": self.centres.tolist(), "weights": self.weights.tolist(), "squares": self.squares.tolist()}

    @classmethod
    def of(cls, values: dict):
        return cls(*(np.array(values[x], dtype=float) for x in ("centres", "weights", "squares")))

    def merged(self, vectors, faded: float):
        """After a block: ``vectors`` are rows (cluster_id, w, q, s0, s1, ...); what was there is faded first."""
        out = Clusters(self.centres.copy(), self.weights * faded, self.squares * faded)
        for r in vectors:
            i, w = r["cluster_id"], r["w"]
            s = np.array([r[f"s{j}"] for j in range(self.centres.shape[1])])
            total = out.weights[i] + w
            out.centres[i] = (out.weights[i] * out.centres[i] + s) / total
            out.weights[i], out.squares[i] = total, out.squares[i] + r["q"]
        return out

    def radii(self) -> np.ndarray:
        """Root mean square distance of what each cluster has learned from its centre."""
        spread = self.squares / np.maximum(self.weights, 1e-300) - (self.centres ** 2).sum(axis=1)
        return np.sqrt(np.maximum(spread, 0.0))


def fade_of(halflife: float, k: int) -> float:
    """The share of a message's weight that a later message leaves: ``1 - halflife`` for one in its own cluster, if each of
    the k clusters gets its part."""
    return (1.0 - halflife) ** (1.0 / k)


def cluster_vectors(block: DataFrame, clusters: Clusters, last, fade: float, features=FEATURES) -> DataFrame:
    """(cluster_id, w, q, s0, ...): the faded feature vectors of a block whose last message is number ``last``."""
    w = F.pow(F.lit(fade), F.lit(last) - F.col("n"))
    squares = sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))
    return (block.withColumn("cluster_id", nearest(clusters.centres, features)).groupBy("cluster_id")
            .agg(F.sum(w).alias("w"), F.sum(w * squares).alias("q"), *[F.sum(w * F.col(f)).alias(f"s{j}") for j, f in enumerate(features)]))


def message_key(key="key", partition="partition", offset="offset") -> Column:
    """Source key, else ``<partition>_<offset>``."""
    return F.coalesce(F.col(key), F.concat_ws("_", F.col(partition).cast("string"), F.col(offset).cast("string")))


def with_label(record, label: str) -> Column:
    """The JSON object ``record`` as it came, with the field ``label`` added at its end."""
    body = F.rtrim(F.regexp_replace(F.rtrim(F.col(record)), r"\}$", ""))
    comma = F.when(F.rtrim(body).endswith("{"), F.lit("")).otherwise(F.lit(","))
    return F.concat(body, comma, F.lit(f'"{label}":'), F.col(label).cast("string"), F.lit("}"))


CHAIN_SCHEMA = "block long, centres array<double>, weights array<double>, squares array<double>"


def _chain(clusters: Clusters, block: int, upto: int, fade: float, features):
    """For mapInArrow over (n, features) in the order of n, in one partition: the clusters after each block."""
    def after(now: Clusters, at: int, n: np.ndarray, x: np.ndarray) -> Clusters:
        end = min((at + 1) * block, upto)
        near = sum((x[:, None, j] - now.centres[None, :, j]) ** 2 for j in range(x.shape[1])).argmin(axis=1)
        w, vectors = fade ** (end - 1 - n).astype(float), []
        for i in np.unique(near):
            mine = near == i
            sums = np.nansum(w[mine, None] * x[mine], axis=0)
            vectors.append({"cluster_id": i, "w": w[mine].sum(), "q": np.nansum(w[mine] * (x[mine] ** 2).sum(axis=1)),
                            **{f"s{j}": v for j, v in enumerate(sums)}})
        return now.merged(vectors, fade ** (end - at * block))

    def run(batches):
        import pyarrow as pa
        now, at, held = clusters, None, []

        def close():
            done = after(now, at, np.concatenate([n for n, _ in held]), np.concatenate([x for _, x in held]))
            return done, pa.RecordBatch.from_pydict({
                "block": pa.array([at], pa.int64()), "centres": pa.array([done.centres.ravel().tolist()]),
                "weights": pa.array([done.weights.tolist()]), "squares": pa.array([done.squares.tolist()])})

        for b in batches:
            n = b.column("n").to_numpy(zero_copy_only=False)
            x = np.column_stack([b.column(f).to_numpy(zero_copy_only=False) for f in features])
            cuts = np.flatnonzero(np.diff(n // block)) + 1
            for part_n, part_x in zip(np.split(n, cuts), np.split(x, cuts)):
                if not len(part_n):
                    continue
                if held and part_n[0] // block != at:
                    now, row = close()
                    yield row
                    held = []
                at = int(part_n[0] // block)
                held.append((part_n, part_x))
        if held:
            yield close()[1]
    return run


def _labelled(rows: DataFrame, first_block: int, centres: list[np.ndarray], block: int, features) -> DataFrame:
    """Each message with the cluster that its block's new centres give it."""
    table = rows.sparkSession.createDataFrame([(first_block + i, [[float(x) for x in c] for c in one]) for i, one in enumerate(centres)],
                                              "_block long, _centres array<array<double>>")      # k rows of d numbers a block
    mine = rows.join(F.broadcast(table), F.floor(F.col("n") / block) == F.col("_block"))
    far = F.transform("_centres", lambda c, i: F.struct(sum(((F.col(f) - c[j]) * (F.col(f) - c[j]) for j, f in enumerate(features)), F.lit(0.0)).alias("d"), i.alias("i")))
    return mine.withColumn("cluster_id", F.array_min(far)["i"]).drop("_block", "_centres")


def run_stream_kmeans(source: DataFrame, out_dir: str, state_dir: str, checkpoint: str, k: int = 4,
                      halflife: float = 0.1, features=FEATURES, seed: int = 42, available_now: bool = True,
                      publish=None, block: int = 2000):
    """Label the stream's messages; each micro-batch writes those of its full blocks to ``<out_dir>/batch_id=<n>``.

    A run that drains its input (``available_now``) labels the messages that wait behind the last full block as a short
    block, in ``<out_dir>/batch_id=-1``; they still wait in the state, and the next run writes that folder anew.
    """
    features, spark = list(features), source.sparkSession
    checkpoint_root(spark)
    state, fade = BatchState(spark, state_dir), fade_of(halflife, k)
    # The source record stays beside its parsed fields: it is published whole, with the label added.
    parsed = good_messages(parse_messages(source.withColumn("record", F.col("value").cast("string")),
                                          keep=("key", "topic", "partition", "offset", "record")))
    waiting = "key string, partition int, offset long, record string, n long, " + ", ".join(f"{f} double" for f in features)
    columns = [c.split()[0] for c in waiting.split(", ")]

    def learned(rows: DataFrame, clusters: Clusters, first: int, total: int, upto: int):
        """(clusters, centres of each block) after the blocks from ``first``, where one begins, up to message ``upto``."""
        centres = []
        if block <= CHAIN_BLOCK and first < upto:
            part = rows.where((F.col("n") >= first) & (F.col("n") < upto)).select("n", *features).repartition(1).sortWithinPartitions("n")
            for r in part.mapInArrow(_chain(clusters, block, upto, fade, features), CHAIN_SCHEMA).collect():       # k rows a block
                clusters = Clusters(np.array(r["centres"]).reshape(k, -1), np.array(r["weights"]), np.array(r["squares"]))
                centres.append(clusters.centres)
            return clusters, centres
        for start in range(first, upto, block):
            end = min(start + block, upto)
            part = rows.where((F.col("n") >= start) & (F.col("n") < end))
            clusters = clusters.merged(cluster_vectors(part, clusters, end - 1, fade, features).collect(), fade ** (end - start))     # k rows
            centres.append(clusters.centres)
        return clusters, centres

    def write(rows: DataFrame, batch_id: int, first: int, centres: list) -> None:
        out = _labelled(rows, first // block, centres, block, features).select(
            message_key().alias("key"), with_label("record", "cluster_id").alias("value"), F.lit(OUTPUT_TOPIC).alias("topic"),
            "cluster_id", "n", *features)
        out.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        if publish is not None:                           # e.g. a batch write to a broker's topic
            publish(out.select("key", "value", "topic"))

    def step(batch: DataFrame, batch_id: int):
        before = state.load(batch_id - 1)
        clusters = Clusters.of(before) if before else Clusters.start(k, len(features), seed)
        seen, first = (before["messages"], before["done"]) if before else (0, 0)
        batch = batch.select([c for c in (*columns, "topic") if c in batch.columns]).persist(StorageLevel.MEMORY_AND_DISK)   # a range partition reads it twice
        rows = numbered(batch, seen).select(columns)
        if before:
            rows = spark.read.schema(waiting).parquet(state.table(batch_id - 1, "waiting")).unionByName(rows)
        rows = rows.checkpoint(eager=True)
        batch.unpersist()
        total = first + rows.count()
        done = total - total % block
        clusters, centres = learned(rows, clusters, first, total, done)
        if centres:
            write(rows.where(F.col("n") < done), batch_id, first, centres)
        rows.where(F.col("n") >= done).write.mode("overwrite").parquet(state.table(batch_id, "waiting"))
        state.save(batch_id, {"messages": total, "done": done, **clusters.values()})
        last["batch_id"] = batch_id

    last = {"batch_id": None}
    w = parsed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
        if last["batch_id"] is not None:
            left = state.load(last["batch_id"])
            rows = spark.read.schema(waiting).parquet(state.table(last["batch_id"], "waiting"))
            _, centres = learned(rows, Clusters.of(left), left["done"], left["messages"], left["messages"])
            if centres:
                write(rows, -1, left["done"], centres)
    return q
