"""Temporal and origin-destination summaries, hourly profiles and their correlation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions.timefn import floor_hour
from kerbflow.operators.ranking import _join_by, exact_quantiles
from kerbflow.session import checkpoint_root


def with_time_parts(df: DataFrame, time_col: str = "pickup_datetime") -> DataFrame:
    """pickup_hour (NTZ, floored), year, month, hour - all from the floored hour."""
    h = floor_hour(time_col)
    return df.withColumn("pickup_hour", h).withColumns({
        "year": F.year("pickup_hour"), "month": F.month("pickup_hour"), "hour": F.hour("pickup_hour")})


def counts_by(df: DataFrame, keys, name: str = "num_trips") -> DataFrame:
    """Trips per key tuple; rows with a null key are dropped (group-by-drop-na)."""
    keys = list(keys)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


def trips_per_year(df: DataFrame, by=()) -> DataFrame:
    return counts_by(with_time_parts(df), [*by, "year"])


def trips_per_hour(df: DataFrame, by=()) -> DataFrame:
    return counts_by(with_time_parts(df), [*by, "hour"])


def trips_per_month(df: DataFrame, by=()) -> DataFrame:
    return counts_by(with_time_parts(df), [*by, "year", "month"])


def distance_summary(df: DataFrame, col: str = "trip_distance", by=(), exact: bool = False,
                     accuracy: int = 10000) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max per group.

    Quantiles are approximate by default (bounded memory per group); ``exact``
    uses a range-partitioned sort and picks ranks, never one task per group.
    """
    by = list(by)
    grouped = bool(by)
    if not grouped:                      # one constant group instead of joining two one-row frames
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    v = F.col(col).cast("double")
    x = df.select(*by, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    moments = [F.count("_v").alias("count"), F.avg("_v").alias("mean"),
               F.stddev_samp("_v").alias("std"), F.min("_v").alias("min"), F.max("_v").alias("max")]
    if exact:
        base = x.groupBy(*by).agg(*moments)
        q = exact_quantiles(x, "_v", [0.25, 0.5, 0.75], by)
        out = _join_by(base, q, by, "left")
    else:
        qs = F.percentile_approx("_v", [0.25, 0.5, 0.75], accuracy)
        out = x.groupBy(*by).agg(*moments, qs.alias("_q")).select(
            *by, "count", "mean", "std", "min", "max",
            F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"))
    keep = by if grouped else []
    return out.select(*keep, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def top_od(df: DataFrame, k: int = 10, by=()) -> DataFrame:
    """Top-k origin-destination pairs by trips; null zones are kept as a pair.

    Global top-k runs as TakeOrderedAndProject (per-partition top-k, then
    merge), so no full sort of the pair table.
    """
    by = list(by)
    pairs = df.groupBy(*by, "pulocationid", "dolocationid").agg(F.count(F.lit(1)).alias("num_trips"))
    order = [F.col("num_trips").desc(), F.col("pulocationid").asc_nulls_first(),
             F.col("dolocationid").asc_nulls_first()]
    if not by:
        return pairs.orderBy(*order).limit(k)
    w = Window.partitionBy(*by).orderBy(*order)
    return pairs.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def hourly_profile(df: DataFrame, by: str = "service") -> DataFrame:
    """Per group and hour of day: trips and share of the group's trips."""
    counts = counts_by(with_time_parts(df), [by, "hour"])
    w = Window.partitionBy(by)      # at most 24 rows per group after the aggregate
    return counts.withColumn("share", F.col("num_trips") / F.sum("num_trips").over(w))


def profile_matrix(profile: DataFrame, by: str = "service") -> DataFrame:
    """Wide hour x group table of shares; hours missing in a group are 0."""
    wide = profile.groupBy("hour").pivot(by).agg(F.first("share"))
    return wide.fillna(0.0).orderBy("hour")


CORR_BLOCK = 256        # series of a block


def profile_corr(profile: DataFrame, by: str = "service", block: int = CORR_BLOCK) -> DataFrame:
    """Pearson correlation of every pair of hourly profiles, long form; an hour that a series lacks counts as 0.

    Each series becomes one row with its shares by hour, in blocks of ``block`` series; a task has two blocks and
    multiplies them as matrices. A series without spread has no correlation (null), as ``corr`` says.
    """
    import pyarrow as pa
    checkpoint_root(profile.sparkSession)
    hours = sorted(r["hour"] for r in profile.select("hour").distinct().collect())       # at most 24
    kind = dict(profile.dtypes)[by]
    shares = F.array(*[F.coalesce(F.sum(F.when(F.col("hour") == h, F.col("share"))), F.lit(0.0)) for h in hours])
    rows = profile.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("series")).agg(shares.alias("x")).checkpoint(eager=True)
    blocks = max(1, -(-rows.count() // block))
    mine = F.pmod(F.xxhash64("series"), F.lit(blocks)).cast("int")
    # A pair of blocks is done once, the lower one first; a block meets each other block and itself.
    pairs = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(
        F.least(F.col("mine"), o).alias("a"), F.greatest(F.col("mine"), o).alias("b")))
    dealt = rows.withColumn("mine", mine).select("series", "x", "mine", F.explode(pairs).alias("p")).select("series", "x", "mine", "p.a", "p.b")

    def multiply(key, table):
        a, b = key[0].as_py(), key[1].as_py()
        where = table.column("mine").to_numpy()
        x = np.array(table.column("x").to_pylist(), dtype=float).reshape(table.num_rows, -1)
        x = x - x.mean(axis=1, keepdims=True)
        size = np.sqrt((x * x).sum(axis=1, keepdims=True))
        x = np.divide(x, size, out=np.full_like(x, np.nan), where=size > 0)
        left, right = np.flatnonzero(where == a), np.flatnonzero(where == b)
        c = np.clip(x[left] @ x[right].T, -1.0, 1.0)
        i, j = (v.ravel() for v in np.meshgrid(left, right, indexing="ij"))
        values = c.ravel()
        if a != b:                                                              # the other half of the matrix
            i, j, values = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([values, values])
        names = table.column("series")
        return pa.table([names.take(pa.array(i)), names.take(pa.array(j)), pa.array(values, mask=np.isnan(values))],
                        names=[f"{by}_a", f"{by}_b", "corr"])

    return dealt.groupBy("a", "b").applyInArrow(multiply, f"{by}_a {kind}, {by}_b {kind}, corr double")


# ------------------------------------------------------------------ distance sketches that can be merged

def distance_sketches(df: DataFrame, by=("service", "year", "month"), col: str = "trip_distance", k: int = 400) -> DataFrame:
    """A row per group with what a summary of any union of groups needs: count, mean, variance, extremes, and a KLL
    sketch of the distribution (rank error about 2.3 / ``k``, whatever the size)."""
    v = F.col(col).cast("double")
    x = with_time_parts(df).select(*by, v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return x.groupBy(*by).agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var"),
                              F.min("v").alias("min"), F.max("v").alias("max"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def merged_distance_summary(sketches: DataFrame, by=(), quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max over any selection of sketched groups; no trip is read."""
    by = list(by)
    pooled = sketches.groupBy(*by).agg(
        F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.sum(F.col("n") * F.col("var")).alias("_within"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("_m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("_s"))
    spread = F.greatest(F.col("_within") + F.col("_m2") - F.col("count") * F.col("mean") * F.col("mean"), F.lit(0.0))
    return pooled.where(F.col("count") > 0).select(
        *by, "count", "mean", F.when(F.col("count") > 1, F.sqrt(spread / (F.col("count") - 1))).alias("std"), "min",
        *[F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(f"q{int(q * 100)}") for q in quantiles], "max")


def service_summary(df: DataFrame, by: str = "service", k: int = 10) -> DataFrame:
    """One row per service: totals plus nested per-year/hour/month and top-OD
    arrays (the JSON summary document, written with ``write.json``)."""
    # One pass counts by (group, year, month, hour); it is kept, and totals and the three tables are sums of that small table.
    checkpoint_root(df.sparkSession)
    fine = with_time_parts(df).groupBy(by, "year", "month", "hour").agg(F.count(F.lit(1)).alias("num_trips")).checkpoint(eager=True)

    def nested(keys, name):
        known = F.lit(True)
        for key in (by, *keys):
            known = known & F.col(key).isNotNull()
        c = fine.where(known).groupBy(by, *keys).agg(F.sum("num_trips").alias("num_trips"))
        return c.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*keys, "num_trips"))).alias(name))

    total = fine.groupBy(by).agg(F.sum("num_trips").alias("total_trips"))
    od = top_od(df, k, by=[by]).groupBy(by).agg(
        F.sort_array(F.collect_list(F.struct(F.col("num_trips") * -1, "pulocationid", "dolocationid",
                                             "num_trips"))).alias("_od"))
    od = od.select(by, F.transform("_od", lambda s: F.struct(s["pulocationid"].alias("pulocationid"),
                                                             s["dolocationid"].alias("dolocationid"),
                                                             s["num_trips"].alias("num_trips")))
                   .alias("top10_od_pairs"))
    dist = distance_summary(df, by=[by]).select(
        by, F.struct("count", "mean", "std", "min", "q25", "q50", "q75", "max").alias("trip_distance_summary")) \
        if "trip_distance" in df.columns else None
    out = (total.join(nested(["year"], "trips_per_year"), by, "left")
                .join(nested(["hour"], "trips_per_hour"), by, "left")
                .join(nested(["year", "month"], "trips_per_month"), by, "left")
                .join(od, by, "left"))
    if dist is not None:
        out = out.join(dist, by, "left")
    return out.orderBy(by)
