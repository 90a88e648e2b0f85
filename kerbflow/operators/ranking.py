"""Global positions in a total order without a single-partition window.

``row_number() over (order by ...)`` with no partition key pulls every row into
one task. Instead: range-partition and sort (spills like any sort), checkpoint
so the partitioning is fixed, count rows per (partition, group) - a table the
size of partitions x groups - turn the counts into offsets, and add the offset
to each row's index inside its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.session import checkpoint_root

_LOCAL_MASK = (1 << 33) - 1


def with_position(df: DataFrame, order_cols, by=(), name: str = "pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Adds ``name``: 0-based position of each row in ``order_cols`` order within
    each ``by`` group (global order when ``by`` is empty)."""
    by = list(by)
    order_cols = list(order_cols)
    spark = df.sparkSession
    checkpoint_root(spark)
    keys = by + order_cols
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(parts, *[F.col(k).asc_nulls_first() for k in keys])
                 .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys]))
    fixed = ordered.checkpoint(eager=True)      # partition layout must not change between passes
    local = (fixed.withColumn("_pid", F.spark_partition_id())
                  .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_MASK))))
    counts = (local.groupBy("_pid", *by)
                   .agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first")))
    if by:
        w = Window.partitionBy(*by).orderBy("_pid")
        offsets = counts.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    else:
        # One row per range partition (a plan-sized table, not data-sized):
        # running sums are taken on the driver.
        rows = sorted((r["_pid"], r["_n"], r["_first"]) for r in counts.collect())
        acc, out = 0, []
        for pid, n, first in rows:
            out.append((pid, first, acc))
            acc += n
        offsets = spark.createDataFrame(out, "_pid int, _first long, _off long")
    o = offsets.select(F.col("_pid").alias("_opid"), *[F.col(b).alias(f"_o_{b}") for b in by], "_first", "_off")
    same = F.col("_pid") == F.col("_opid")
    for b in by:                                # a null group is a group
        same = same & F.col(b).eqNullSafe(F.col(f"_o_{b}"))
    joined = local.join(o, same, "inner").drop("_opid", *[f"_o_{b}" for b in by])
    return (joined.withColumn(name, F.col("_off") + F.col("_local") - F.col("_first"))
                  .drop("_pid", "_local", "_off", "_first"))


def _join_by(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the keys appear once."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, value: str, probs, by=()) -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``quantile_cont`` definition),
    one row per group with columns ``q<pct>``; NaN and null values ignored."""
    by = list(by)
    v = F.col(value)
    x = df.select(*by, v.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    # A seeded random tie-breaker lets range partitioning split a value shared
    # by a large share of the rows; the order of equal values does not matter.
    ranked = with_position(x.withColumn("_tb", F.rand(17)), ["_v", "_tb"], by, name="_r").drop("_tb")
    sizes = x.groupBy(*by).agg(F.count(F.lit(1)).alias("_cnt")) if by else \
        x.agg(F.count(F.lit(1)).alias("_cnt"))
    want = []
    for p in probs:
        pos = F.lit(float(p)) * (F.col("_cnt") - 1)
        lo = F.floor(pos)
        want.append(F.struct(F.lit(float(p)).alias("p"), lo.alias("lo"),
                             F.least(lo + 1, F.col("_cnt") - 1).alias("hi"),
                             (pos - lo).alias("frac")))
    targets = sizes.select(*by, F.explode(F.array(*want)).alias("t")).select(*by, "t.*")
    ranks = targets.select(*by, F.col("lo").alias("_r")).union(targets.select(*by, F.col("hi").alias("_r"))).distinct()
    picked = _join_by(ranked, ranks, [*by, "_r"])
    lo_v = picked.select(*by, F.col("_r").alias("lo"), F.col("_v").alias("v_lo"))
    hi_v = picked.select(*by, F.col("_r").alias("hi"), F.col("_v").alias("v_hi"))
    q = (_join_by(_join_by(targets, lo_v, [*by, "lo"]), hi_v, [*by, "hi"])
         .select(*by, "p", (F.col("v_lo") + F.col("frac") * (F.col("v_hi") - F.col("v_lo"))).alias("q")))
    cols = [F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(f"q{int(round(p * 100))}") for p in probs]
    return q.groupBy(*by).agg(*cols) if by else q.agg(*cols)
