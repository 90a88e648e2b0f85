"""Rolling per-zone statistics, visit counts, top/bottom zones and borough stats.

One stateful aggregation carries everything: each message is unpivoted into
its pickup row (carrying the three measures) and its dropoff row (counting
only), grouped by zone. State is one row per zone (hundreds), not per trip.
Borough statistics are merged from the zone rows (count, mean, M2, min, max),
so no second stateful operator is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kerbflow.operators.ranking import with_position
from kerbflow.session import checkpoint_root
from kerbflow.streaming.counted import ORDER, BatchState, numbered
from kerbflow.streaming.messages import good_messages, parse_messages

MEASURES = ("trip_distance", "tip_amount", "total_amount")
STATS = ("count", "mean", "std", "min", "max")


def zone_state(parsed: DataFrame) -> DataFrame:
    """Streaming-safe aggregation: per zone pickups, dropoffs and, over the
    pickup rows, count/mean/population-std/min/max of each measure."""
    rows = F.array(
        F.struct(F.col("pulocationid").alias("zone"), F.lit(True).alias("is_pu"),
                 *[F.col(m).alias(m) for m in MEASURES]),
        F.struct(F.col("dolocationid").alias("zone"), F.lit(False).alias("is_pu"),
                 *[F.lit(None).cast("double").alias(m) for m in MEASURES]))
    long = parsed.select(F.inline(rows)).where(F.col("zone").isNotNull())
    aggs = [F.count_if("is_pu").alias("pickups"), F.count_if(~F.col("is_pu")).alias("dropoffs")]
    for m in MEASURES:
        v = F.col(m)                # null in the dropoff rows
        aggs += [F.count(v).alias(f"{m}_count"), F.avg(v).alias(f"{m}_mean"),
                 F.stddev_pop(v).alias(f"{m}_std"), F.min(v).alias(f"{m}_min"), F.max(v).alias(f"{m}_max")]
    return long.groupBy("zone").agg(*aggs)


def zone_summary(state: DataFrame) -> DataFrame:
    """Empty statistics read as zeros (a zone seen only as a dropoff)."""
    cols = {f"{m}_{s}": F.coalesce(F.col(f"{m}_{s}"), F.lit(0.0)) for m in MEASURES for s in STATS if s != "count"}
    return state.withColumns(cols)


def borough_stats(state: DataFrame, zone_boroughs: DataFrame, by=()) -> DataFrame:
    """Per borough of the pickup zone; zones without a borough are skipped.
    Merges zone moments (n, mean, population variance) in two steps."""
    by = list(by)
    zb = zone_boroughs.select(F.col("zone").alias("_z"), "borough")
    j = state.join(zb, F.col("zone") == F.col("_z"), "inner").where(F.col("pickups") > 0)
    keys = [*by, "borough"]
    sums = []
    for m in MEASURES:
        n = F.col(f"{m}_count")
        sums += [F.sum(n).alias(f"_{m}_n"), (F.sum(n * F.col(f"{m}_mean")) / F.sum(n)).alias(f"_{m}_mean")]
    # Second step: squares are taken about the pooled mean, which loses no digits however large the mean is.
    means = j.groupBy(*keys).agg(*sums)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"j.{k}").eqNullSafe(F.col(f"p.{k}"))
    both = j.alias("j").join(means.alias("p"), same).select("j.*", *[F.col(f"p._{m}_{x}") for m in MEASURES for x in ("n", "mean")])
    aggs = []
    for m in MEASURES:
        n, mu, sd, mean = (F.col(c) for c in (f"{m}_count", f"{m}_mean", f"{m}_std", f"_{m}_mean"))
        aggs += [F.sum(n).alias(f"{m}_count"), F.first(mean).alias(f"{m}_mean"),
                 F.sum(n * sd * sd + n * (mu - mean) * (mu - mean)).alias(f"_{m}_m2"),
                 F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    g = both.groupBy(*keys).agg(*aggs)
    out = []
    for m in MEASURES:
        n = F.col(f"{m}_count")
        out += [n, F.col(f"{m}_mean"),
                F.when(n > 1, F.sqrt(F.col(f"_{m}_m2") / n)).otherwise(F.lit(0.0)).alias(f"{m}_std"),
                F.col(f"{m}_min"), F.col(f"{m}_max")]
    return g.select(*keys, *out)


def visits(state: DataFrame, mode: str = "pickup", by=()) -> DataFrame:
    """(zone, visits): pickups, or pickups + dropoffs in ``both`` mode; zones
    never seen (0 visits) are left out."""
    v = F.col("pickups") if mode == "pickup" else F.col("pickups") + F.col("dropoffs")
    return state.select(*by, "zone", v.alias("visits")).where(F.col("visits") > 0)


def ranked_zones(state: DataFrame, k: int = 10, mode: str = "pickup", top: bool = True, by=()) -> DataFrame:
    """Top (or bottom) k zones by visits, ties broken by zone id; stats attached.
    The ranking runs on per-zone state rows (one row per zone and snapshot)."""
    by = list(by)
    v = visits(state, mode, by)
    order = [F.col("visits").desc() if top else F.col("visits").asc(), F.col("zone").asc()]
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        ranked = v.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    else:                                # top-k first, then number the k kept rows
        key = -F.col("visits") if top else F.col("visits")
        kept = v.orderBy(*order).limit(k).agg(F.sort_array(F.collect_list(
            F.struct(key.alias("_k"), F.col("zone").alias("zone"), F.col("visits").alias("visits")))).alias("_a"))
        ranked = kept.select(F.posexplode("_a").alias("_pos", "_r")).select(
            (F.col("_pos") + 1).cast("int").alias("rank"), "_r.zone", "_r.visits")
    return ranked.join(zone_summary(state), [*by, "zone"], "left").drop("pickups", "dropoffs")


def with_borough(zones: DataFrame, zone_boroughs: DataFrame) -> DataFrame:
    """Borough name of each zone; an id missing from the lookup reads "Unknown"."""
    zb = zone_boroughs.select(F.col("zone").alias("_bz"), F.col("borough").alias("_b"))
    return (zones.join(zb, F.col("zone") == F.col("_bz"), "left")
                 .withColumn("borough", F.coalesce("_b", F.lit("Unknown"))).drop("_bz", "_b"))


def periodic_sums(numbered: DataFrame, interval: int) -> DataFrame:
    """(report, zone, m, c, s): messages, amounts and their sum by report interval and pickup zone, from messages with a number ``n``."""
    placed = numbered.select(F.floor(F.col("n") / interval).cast("long").alias("report"), F.col("pulocationid").alias("zone"), "total_amount")
    return placed.groupBy("report", "zone").agg(F.count(F.lit(1)).alias("m"), F.count("total_amount").alias("c"),
                                                F.coalesce(F.sum("total_amount"), F.lit(0.0)).alias("s"))


def running_states(sums: DataFrame, full) -> DataFrame:
    """(report, zone, pickups, total_amount_count, total_amount_mean) after each of the reports below ``full``.

    Sums by (report, zone) are merged by a running window within each zone; a zone without
    messages in a report keeps its state.
    """
    order = Window.partitionBy("zone").orderBy("report")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.lead("report").over(order), full) - 1
    state = (sums.where(F.col("zone").isNotNull())
             .select("report", "zone", F.sum("m").over(running).alias("pickups"),
                     F.sum("c").over(running).alias("total_amount_count"), F.sum("s").over(running).alias("_s"),
                     F.least(last, full - 1).alias("_last"))
             .where(F.col("_last") >= F.col("report")))
    return state.select(F.explode(F.sequence("report", "_last")).alias("report"), "zone", "pickups", "total_amount_count",
                        (F.col("_s") / F.col("total_amount_count")).alias("total_amount_mean"))


def periodic_states(parsed: DataFrame, order_cols, interval: int = 500) -> DataFrame:
    """(report, zone, pickups, total_amount_count, total_amount_mean) after every ``interval`` good messages of a batch.

    A report's number comes from a message's place among the good messages, so
    the result depends on the messages alone, not on files, partitions or
    micro-batches. Messages after the last full interval are in no report.
    """
    # Narrow rows, parsed once: a range partition reads its input twice.
    narrow = parsed.select(*dict.fromkeys([*order_cols, "pulocationid", "total_amount"])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = periodic_sums(with_position(narrow, order_cols, name="n"), interval)
    finally:
        narrow.unpersist()
    return running_states(sums, F.floor(sums.agg(F.sum("m")).scalar() / interval))


def run_periodic_reports(source: DataFrame, out_dir: str, state_dir: str, checkpoint: str, interval: int = 500, available_now: bool = True,
                         processing_time: str | None = None):
    """The reports' states out of a stream: a report leaves, once, with the micro-batch that completes its interval.

    Messages are numbered on from the counter that the batch before left, so a batch is cut at multiples of
    ``interval`` wherever they fall in it. The state is a row per zone (what it has counted up to the last message),
    kept by batch: a batch that is run again, or a stream that is started again, goes on from the same numbers and
    writes over the same folder of ``out_dir``.
    """
    parsed = good_messages(parse_messages(source))
    spark = source.sparkSession
    checkpoint_root(spark)
    state = BatchState(spark, state_dir)

    def step(batch: DataFrame, batch_id: int):
        before = state.load(batch_id - 1) or {"messages": 0}
        first = before["messages"]
        narrow = batch.select([c for c in (*ORDER, "pulocationid", "total_amount") if c in batch.columns]).persist(StorageLevel.MEMORY_AND_DISK)
        sums = periodic_sums(numbered(narrow, first), interval)
        narrow.unpersist()
        if first:
            # What was counted before this batch stands in the interval that the batch goes on with.
            kept = spark.read.schema("zone int, m long, c long, s double").parquet(state.table(batch_id - 1, "zones"))
            sums = sums.unionByName(kept.select(F.lit(first // interval).cast("long").alias("report"), "zone", "m", "c", "s"))
            sums = sums.groupBy("report", "zone").agg(*[F.sum(c).alias(c) for c in "mcs"])
        sums = sums.checkpoint(eager=True)                  # a row per report and zone
        total = sums.agg(F.sum("m")).first()[0] or 0
        running_states(sums, F.lit(total // interval)).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        sums.groupBy("zone").agg(*[F.sum(c).alias(c) for c in "mcs"]).write.mode("overwrite").parquet(state.table(batch_id, "zones"))
        state.save(batch_id, {"messages": total})

    w = parsed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
    return q


def periodic_reports(states: DataFrame, zone_boroughs: DataFrame, k: int = 10) -> DataFrame:
    """(section, report, rank, name, visits, total_amount_mean): top and bottom zones, and all boroughs."""
    out = None
    for section, order in (("top", F.col("pickups").desc()), ("bottom", F.col("pickups").asc())):
        w = Window.partitionBy("report").orderBy(order, "zone")        # a row per zone: hundreds
        part = states.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
            F.lit(section).alias("section"), "report", "rank", F.col("zone").cast("string").alias("name"),
            F.col("pickups").alias("visits"), "total_amount_mean")
        out = part if out is None else out.unionByName(part)
    zb = zone_boroughs.select(F.col("zone").alias("_z"), "borough")
    n = F.col("total_amount_count")
    boroughs = (states.join(zb, F.col("zone") == F.col("_z")).groupBy("report", "borough")
                .agg(F.sum(n).alias("visits"), (F.sum(n * F.col("total_amount_mean")) / F.sum(n)).alias("total_amount_mean")))
    return out.unionByName(boroughs.select(F.lit("borough").alias("section"), "report", F.lit(None).cast("int").alias("rank"),
                                           F.col("borough").alias("name"), "visits", "total_amount_mean"))
