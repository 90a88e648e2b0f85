"""Hourly demand features and three regressors on pyspark.ml.

Models: linear regression (normal equations, one pass), gradient-boosted
trees (binned splits) and one pass of SGD over time-ordered blocks, row by row,
whose steps are made in tasks, a block each, and put together in time order.
"""

from __future__ import annotations

import math
import time

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kerbflow.functions.timefn import floor_hour, weekday_mon0
from kerbflow.session import checkpoint_root

# Model features and the year split.
FEATURES = ("hour", "dow", "month", "lat", "lon")
TRAIN_YEARS = (2019, 2020, 2021, 2022)
VALIDATION_YEAR = 2023
TEST_YEAR = 2024


def hourly_demand(trips: DataFrame, centroids: DataFrame | None = None, time_col: str = "pickup_datetime",
                  zone_col: str = "pulocationid") -> DataFrame:
    """(pickup_hour, pickup_zone, trip_count [, lat, lon]) over all services."""
    d = (trips.select(floor_hour(time_col).alias("pickup_hour"), F.col(zone_col).cast("int").alias("pickup_zone"))
              .where(F.col("pickup_hour").isNotNull() & F.col("pickup_zone").isNotNull())
              .groupBy("pickup_hour", "pickup_zone").agg(F.count(F.lit(1)).alias("trip_count")))
    if centroids is not None:
        c = centroids.select(F.col("zone").alias("_cz"), "lat", "lon")
        d = d.join(c, F.col("pickup_zone") == F.col("_cz"), "left").drop("_cz")
    return d


def demand_features(d: DataFrame) -> DataFrame:
    h = F.col("pickup_hour")
    return d.withColumns({"hour": F.hour(h), "dow": weekday_mon0(h), "month": F.month(h), "year": F.year(h)})


def split_by_year(d: DataFrame, train=TRAIN_YEARS, validation=VALIDATION_YEAR, test=TEST_YEAR) -> DataFrame:
    """Label rows train / validation / test by year; other years are dropped."""
    y = F.col("year")
    label = (F.when(y.isin(list(train)), "train").when(y == validation, "validation")
              .when(y == test, "test"))
    return d.where(y.isin(list(train) + [validation, test])).withColumn("split", label)


def assemble(d: DataFrame, features=FEATURES) -> DataFrame:
    """Feature vector; rows with a null feature (zone without centroid) are skipped."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return va.transform(d.withColumns({f: F.col(f).cast("double") for f in features}))


def error_metrics(pred: DataFrame, label: str = "trip_count", prediction: str = "prediction") -> dict:
    e = F.col(label).cast("double") - F.col(prediction)
    r = pred.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.count(F.lit(1)).alias("n")).first()
    return {"mse": r["mse"], "mae": r["mae"], "n": r["n"]}


# ------------------------------------------------------- one-pass SGD over ordered blocks

CHUNK = 64          # rows whose updates are solved at once


def sgd_chain(w: np.ndarray, z: np.ndarray, y: np.ndarray, t: int, eta0: float, power_t: float, alpha: float) -> np.ndarray:
    """Weights after one update per row of ``z`` (first column 1) in order; ``t`` rows came before.
    With columns of ``w``, and as many of ``y``, each is a chain of its own over the same rows.

    Row t moves ``w <- (1 - eta_t alpha) w - eta_t (w z_t - y_t) z_t`` with ``eta_t = eta0 / t^power_t``; the intercept is
    not shrunk. The rows' residuals depend on each other through a unit lower triangular system, which is solved for a
    chunk at a time: the same numbers as row by row.
    """
    for at in range(0, len(y), CHUNK):
        x, target = z[at:at + CHUNK], y[at:at + CHUNK]
        n = len(target)
        eta = eta0 / np.arange(t + 1, t + n + 1, dtype=float) ** power_t
        shrink = np.concatenate([[1.0], np.cumprod(1.0 - eta * alpha)])           # before each row, and after the last
        scale = np.repeat(shrink[:, None], x.shape[1], axis=1)
        scale[:, 0] = 1.0
        before, after = x * scale[:-1], x / scale[1:]
        r = np.linalg.solve(np.eye(n) + np.tril(before @ after.T, -1) * eta, before @ w - target)
        w = (scale[-1] * (w - after.T @ (eta * r.T).T).T).T
        t += n
    return w


def sgd_step(w: np.ndarray, z: np.ndarray, y: np.ndarray, t: int, eta0: float, power_t: float, alpha: float) -> np.ndarray:
    """What all weights before the rows of ``z`` become after them, carried on from ``w``: a matrix and, as its last column, what is added.

    An update is affine in the weights, so a chain of them is, too: its matrix is where the unit vectors go with targets of 0,
    and what it adds is where no weights go. It needs no weights yet, only the number of rows before.
    """
    return sgd_chain(w, z, np.column_stack([np.zeros((len(y), w.shape[1] - 1)), y]), t, eta0, power_t, alpha)


def fit_ordered_sgd(train: DataFrame, features=FEATURES, label: str = "trip_count", order=("pickup_hour", "pickup_zone"),
                    block_rows: int = 100_000, eta0: float = 0.01, power_t: float = 0.25, alpha: float = 1e-4) -> dict:
    """One pass of SGD over time-ordered blocks of about ``block_rows`` rows, on standardised features.

    Rows are range-partitioned by time, a block a task. Every block goes on from the weights and the row number at which the
    one before it ended, one update a row, in time order from zero: tasks find what each block does to any weights
    (:func:`sgd_step`), and the blocks' steps are then taken one after another, so any number of blocks gives the sequential
    pass itself. Returns {"mean", "std", "coef", "features"} (coef[0] is the intercept).
    """
    feats = list(features)
    order = [c for c in order if c in train.columns and c not in feats]
    x = train.select(*order, *[F.col(f).cast("double").alias(f) for f in feats], F.col(label).cast("double").alias("_y")) \
        .dropna(subset=[*feats, "_y"])
    mom = x.agg(*[F.avg(f).alias(f"m_{f}") for f in feats], *[F.stddev_pop(f).alias(f"s_{f}") for f in feats],
                F.count(F.lit(1)).alias("n")).first()
    n = mom["n"]
    if not n:
        raise ValueError("no training rows")
    mean = np.array([mom[f"m_{f}"] for f in feats])
    std = np.array([mom[f"s_{f}"] or 1.0 for f in feats])
    blocks, keys = max(1, math.ceil(n / block_rows)), [*order, F.xxhash64(*feats, "_y")]       # rows of one hour and zone by a hash
    # One block is one task; a range partition also needs a key to split by.
    dealt = (x.repartitionByRange(blocks, *keys) if blocks > 1 else x.coalesce(1)).sortWithinPartitions(*keys)

    checkpoint_root(train.sparkSession)
    dealt = dealt.select(*feats, "_y").checkpoint(eager=True)                  # blocks must not change between the passes
    sizes = dict(dealt.groupBy(F.spark_partition_id().alias("block")).count().collect())
    before = {b: sum(sizes[a] for a in sizes if a < b) for b in sizes}         # a number a block

    def step(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        block, w = TaskContext.get().partitionId(), np.eye(len(feats) + 1, len(feats) + 2)
        t = first = before.get(block, 0)
        for b in batches:
            cols = [b.column(f).to_numpy() for f in feats]
            z = np.column_stack([np.ones(b.num_rows), (np.column_stack(cols) - mean) / std])
            w, t = sgd_step(w, z, b.column("_y").to_numpy(), t, eta0, power_t, alpha), t + b.num_rows
        if t > first:
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "w": pa.array([w.ravel().tolist()], pa.list_(pa.float64()))})

    coef = np.zeros(len(feats) + 1)
    for r in sorted(dealt.mapInArrow(step, "block int, w array<double>").collect(), key=lambda r: r["block"]):      # a small matrix a block
        w = np.array(r["w"]).reshape(len(coef), -1)
        coef = w[:, :-1] @ coef + w[:, -1]
    return {"mean": mean, "std": std, "coef": coef, "features": feats}


def predict_sgd(df: DataFrame, model: dict, out: str = "prediction") -> DataFrame:
    expr = F.lit(float(model["coef"][0]))
    for i, f in enumerate(model["features"]):
        expr = expr + F.lit(float(model["coef"][i + 1])) * \
            ((F.col(f).cast("double") - F.lit(float(model["mean"][i]))) / F.lit(float(model["std"][i])))
    return df.withColumn(out, expr)


# ------------------------------------------------------------------ driver

def pooled(train: DataFrame, features=FEATURES, label: str = "trip_count") -> DataFrame:
    """One row per combination of features: the mean label, weighted by the rows it stands for.

    Rows of equal features end in the same leaf, and a squared error's gains and leaf means depend on their sum and
    number alone: trees fitted here are those of all rows, over at most hours x weekdays x months x zones rows.
    """
    d = train.groupBy(*features).agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("weight"))
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(d)


def held(df: DataFrame, partition_rows: int = 250_000) -> DataFrame:
    """``df`` computed once and kept, in as few partitions as it fills: many passes go over it."""
    checkpoint_root(df.sparkSession)
    df = df.checkpoint(eager=True)
    return df.coalesce(max(1, math.ceil(df.count() / partition_rows))).persist(StorageLevel.MEMORY_AND_DISK)

def save_sgd(spark, model: dict, path: str) -> str:
    """Coefficients and scaling of the SGD model as a one-row Parquet table."""
    spark.createDataFrame([(model["features"], [float(v) for v in model["mean"]], [float(v) for v in model["std"]],
                            [float(v) for v in model["coef"]])],
                          "features array<string>, mean array<double>, std array<double>, coef array<double>") \
        .coalesce(1).write.mode("overwrite").parquet(path)
    return path


def forecast_metrics(feats: DataFrame, gbt_iterations: int = 100, gbt_depth: int = 6, block_rows: int = 100_000,
                     label: str = "trip_count", save_dir: str | None = None) -> DataFrame:
    """Train on the train split, score validation and test; one metrics row per
    (model, split) with seconds spent fitting + scoring. With ``save_dir`` the
    three fitted models are written there (ML writers / Parquet)."""
    spark = feats.sparkSession
    data = held(assemble(feats))
    train = data.where(F.col("split") == "train")
    rows = []
    try:
        mean = train.agg(F.avg(label)).first()[0]
        for split in ("validation", "test"):
            t1 = time.time()
            m = error_metrics(data.where(F.col("split") == split).withColumn("prediction", F.lit(mean)), label)
            rows.append(("mean", split, m["mse"], m["mae"], m["n"], time.time() - t1))

        t0 = time.time()
        lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(train)
        fit_s = time.time() - t0
        for split in ("validation", "test"):
            t1 = time.time()
            m = error_metrics(lr.transform(data.where(F.col("split") == split)), label)
            rows.append(("linear", split, m["mse"], m["mae"], m["n"], fit_s + time.time() - t1))

        t0 = time.time()
        # Hundreds of passes: over the combinations of features, which do not grow with the years of rows.
        points = held(pooled(train, label=label))
        gbt = GBTRegressor(featuresCol="features", labelCol=label, weightCol="weight", maxIter=gbt_iterations, maxDepth=gbt_depth,
                           stepSize=0.3, maxBins=256, seed=42, checkpointInterval=20).fit(points)
        points.unpersist()
        fit_s = time.time() - t0
        for split in ("validation", "test"):
            t1 = time.time()
            m = error_metrics(gbt.transform(data.where(F.col("split") == split)), label)
            rows.append(("gbt", split, m["mse"], m["mae"], m["n"], fit_s + time.time() - t1))

        t0 = time.time()
        sgd = fit_ordered_sgd(train, block_rows=block_rows, label=label)
        fit_s = time.time() - t0
        for split in ("validation", "test"):
            t1 = time.time()
            m = error_metrics(predict_sgd(data.where(F.col("split") == split), sgd), label)
            rows.append(("ordered_sgd", split, m["mse"], m["mae"], m["n"], fit_s + time.time() - t1))
        if save_dir:
            lr.write().overwrite().save(f"{save_dir}/linear")
            gbt.write().overwrite().save(f"{save_dir}/gbt")
            save_sgd(spark, sgd, f"{save_dir}/ordered_sgd")
    finally:
        data.unpersist()
    return spark.createDataFrame(rows, "model string, split string, mse double, mae double, n bigint, seconds double")
