"""Streaming queries over trip messages replayed from ``trips_ev``.

Sources: click/view/purchase trips publish yellow fields, signup/error trips
fhvhv fields. Edge messages are injected by key (broken JSON, text numbers,
NaN, negative distance, missing tip, empty zone, Infinity, null key); the
oracle applies the same parse rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbflow.plans.registry import register
from kerbflow.plans.standins import TRIPS_EV_SQL, table, trips_ev, with_ctes
from kerbflow.session import produced_once, scratch_path
from kerbflow.streaming import kmeans, replay, runner, stats
from kerbflow.streaming.messages import dead_letters, encode_message, good_messages, parse_messages

YELLOW_SERVICES = ("click", "view", "purchase")
# Topic names per source and the report interval (messages).
TOPICS = {"yellow": "yellow_taxi_stream", "fhvhv": "fhvhv_taxi_stream"}
REPORT_INTERVAL = 500
ROWS_PER_FILE = 500
# A longer replay has larger files, not more: a micro-batch costs the same whatever it holds, and each looks through the log of all files.
REPLAY_FILES = 400


def _sources(spark, sf_dir):
    t = trips_ev(spark, sf_dir)
    y = t.where(F.col("service").isin(list(YELLOW_SERVICES)))
    f = t.where(~F.col("service").isin(list(YELLOW_SERVICES)))
    return {"yellow": y, "fhvhv": f}


def _value():
    """Messages as JSON objects; some, by id, are spoiled as messages of a real stream may be."""
    tid, d = F.col("trip_id"), F.col("trip_distance")
    pu = F.when(tid % 59 != 0, F.col("pulocationid"))
    riders = 1 + (F.col("trip_id") * 7 + F.coalesce("dolocationid", F.lit(0))) % 6

    def message(src, total, distance, tip):
        return encode_message({"pickup_datetime": F.col("pickup_datetime"), total: F.col("total_amount"), distance: F.when(tid % 47 == 0, -d).otherwise(d),
                               "pulocationid": pu, "dolocationid": F.col("dolocationid"), tip: F.col("tip_amount"), "source": F.lit(src),
                               "passenger_count": riders})
    text = F.when(F.col("source") == "yellow", message("yellow", "total_amount", "trip_distance", "tip_amount")) \
        .otherwise(message("fhvhv", "driver_pay", "trip_miles", "tips"))

    def spoil(case, pattern, by):
        nonlocal text
        text = F.when(case, F.regexp_replace(text, pattern, by)).otherwise(text)

    spoil(tid % 43 == 0, '"(trip_distance|trip_miles)":[^,]*', '"$1":NaN')
    spoil((tid % 37 == 0) & (tid % 43 != 0) & (tid % 47 != 0), '"(trip_distance|trip_miles)":([^,]*)', '"$1":"$2"')
    spoil(tid % 53 == 0, ',"(tip_amount|tips)":[^,]*', "")
    spoil(tid % 61 == 0, '"(total_amount|driver_pay)":[^,]*', '"$1":Infinity')
    spoil(tid % 59 == 0, '"pulocationid":null', '"pulocationid":""')
    return F.when(tid % 101 == 0, F.substring(text, 1, 20)).otherwise(text)


def _key():
    return F.when(F.col("trip_id") % 7 != 0, F.col("trip_id").cast("string"))


def merged(spark, sf_dir):
    return replay.merge_by_time(_sources(spark, sf_dir))


def records(spark, sf_dir):
    return replay.to_topic_records(merged(spark, sf_dir), TOPICS, _value(), _key())


def encoded(spark, sf_dir):
    """The same messages without a place in the replay: nothing is sorted."""
    frames = [df.withColumn("source", F.lit(name)) for name, df in _sources(spark, sf_dir).items()]
    union = frames[0].unionByName(frames[1], allowMissingColumns=True).where(F.col("pickup_datetime").isNotNull())
    return replay.to_topic_records(union.withColumn("seq", F.lit(None).cast("long")), TOPICS, _value(), _key())


def rows_per_file(messages: int) -> int:
    return max(ROWS_PER_FILE, -(-messages // REPLAY_FILES))


def replayed(spark, sf_dir) -> str:
    """The replayed topic: produced once per application, read by every consumer."""
    return produced_once(spark, "replay", sf_dir, lambda: replay.write_replay(
        records(spark, sf_dir), scratch_path(spark, "replay"), rows_per_file(table(spark, sf_dir, "events").count())))


def zone_boroughs(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("zone"),
                                                            F.col("r_name").alias("borough"))


# The final state does not depend on the batch size, so that run takes larger
# micro-batches; reports and k-means number the messages themselves, so theirs may have any size.
FINAL_STATE_FILES_PER_TRIGGER = 10
KMEANS_FILES_PER_TRIGGER = 40
REPORT_FILES_PER_TRIGGER = 25


def run_stats(spark, sf_dir, files_per_trigger: int = FINAL_STATE_FILES_PER_TRIGGER):
    """Output folder of the rolling-statistics consumer: it runs once per
    application and trigger size; the stats, visit and top/bottom queries all
    read its state snapshots."""
    def build():
        out = scratch_path(spark, "rolling")
        runner.run_rolling_stats(replay.replay_source(spark, replayed(spark, sf_dir), files_per_trigger), out,
                                 scratch_path(spark, "rolling-cp"))
        return out
    return produced_once(spark, f"rolling-{files_per_trigger}", sf_dir, build)


def _round_stats(df, prefix_cols):
    cols = []
    for c in df.columns:
        if any(c.endswith(s) for s in ("_mean", "_std", "_min", "_max")):
            cols.append(F.round(c, 6).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols).select(*prefix_cols, *[c for c in df.columns if c not in prefix_cols])


# ------------------------------------------------------------------- SQL

MSG_SQL = """msg AS (
  SELECT trip_id, CASE WHEN trip_id % 7 <> 0 THEN CAST(trip_id AS VARCHAR) END AS key,
    CASE WHEN service IN ('click', 'view', 'purchase') THEN 'yellow' ELSE 'fhvhv' END AS source,
    pickup_datetime,
    CASE WHEN trip_id % 59 = 0 THEN NULL ELSE pulocationid END AS pulocationid, dolocationid,
    CASE WHEN trip_id % 43 = 0 OR trip_id % 47 = 0 THEN 0.0 ELSE trip_distance END AS trip_distance,
    CASE WHEN trip_id % 53 = 0 THEN 0.0 ELSE tip_amount END AS tip_amount,
    (1 + (trip_id * 7 + coalesce(dolocationid, 0)) % 6)::DOUBLE AS passenger_count,
    CASE WHEN trip_id % 61 = 0 THEN 0.0 ELSE total_amount END AS total_amount
  FROM trips_ev WHERE trip_id % 101 <> 0)"""


def _stat_cols(alias=""):
    out = []
    for m in ("trip_distance", "tip_amount", "total_amount"):
        out += [f"count({m}) AS {m}_count", f"round(avg({m}), 6) AS {m}_mean",
                f"round(stddev_pop({m}), 6) AS {m}_std", f"round(min({m}), 6) AS {m}_min",
                f"round(max({m}), 6) AS {m}_max"]
    return ", ".join(out)


ZSTATS_SQL = f"""zs AS (
  SELECT pulocationid AS zone, {_stat_cols()} FROM msg WHERE pulocationid IS NOT NULL GROUP BY 1)"""
VIS_SQL = """vis AS (SELECT pulocationid AS zone, count(*) AS visits FROM msg WHERE pulocationid IS NOT NULL
  GROUP BY 1)""", """vis_both AS (SELECT zone, CAST(sum(c) AS BIGINT) AS visits FROM (
  SELECT pulocationid AS zone, count(*) AS c FROM msg WHERE pulocationid IS NOT NULL GROUP BY 1
  UNION ALL SELECT dolocationid, count(*) FROM msg WHERE dolocationid IS NOT NULL GROUP BY 1) GROUP BY zone)"""
STAT_NAMES = ", ".join(f"coalesce(zs.{m}_{s}, 0{'.0' if s != 'count' else ''}) AS {m}_{s}"
                       for m in ("trip_distance", "tip_amount", "total_amount")
                       for s in ("count", "mean", "std", "min", "max"))


# ----------------------------------------------------------------- queries

@register("replay_merge", with_ctes(TRIPS_EV_SQL, body="""
SELECT row_number() OVER (ORDER BY pickup_datetime, src, trip_id) - 1 AS seq,
  CASE WHEN src = 'yellow' THEN 'yellow_taxi_stream' ELSE 'fhvhv_taxi_stream' END AS topic,
  trip_id, pickup_datetime
FROM (SELECT *, CASE WHEN service IN ('click', 'view', 'purchase') THEN 'yellow' ELSE 'fhvhv' END AS src
      FROM trips_ev) WHERE pickup_datetime IS NOT NULL"""))
def q_replay_merge(spark, sf_dir):
    m = merged(spark, sf_dir)
    topic = F.when(F.col("source") == "yellow", F.lit(TOPICS["yellow"])).otherwise(F.lit(TOPICS["fhvhv"]))
    return m.select("seq", topic.alias("topic"), "trip_id", "pickup_datetime")


@register("parse_messages", with_ctes(TRIPS_EV_SQL, MSG_SQL, body="""
SELECT key, source, pickup_datetime, pulocationid, dolocationid, trip_distance, tip_amount, total_amount, passenger_count FROM msg"""))
def q_parse_messages(spark, sf_dir):
    p = good_messages(parse_messages(encoded(spark, sf_dir)))
    return p.select("key", "source", "pickup_datetime", "pulocationid", "dolocationid", "trip_distance",
                    "tip_amount", "total_amount", "passenger_count")


@register("rolling_zone_stats", with_ctes(TRIPS_EV_SQL, MSG_SQL, ZSTATS_SQL, body="SELECT * FROM zs"))
def q_rolling_zone_stats(spark, sf_dir):
    s = runner.final_state(spark, run_stats(spark, sf_dir)).where(F.col("pickups") > 0) \
        .drop("pickups", "dropoffs")
    return _round_stats(s, ["zone"])


@register("rolling_borough_stats", with_ctes(TRIPS_EV_SQL, MSG_SQL, body=f"""
SELECT r.r_name AS borough, {_stat_cols()}
FROM msg JOIN nation n ON msg.pulocationid = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1"""))
def q_rolling_borough_stats(spark, sf_dir):
    b = runner.report(runner.final_state(spark, run_stats(spark, sf_dir)), "borough", zone_boroughs(spark, sf_dir))
    return _round_stats(b, ["borough"])


@register("zone_visits", with_ctes(TRIPS_EV_SQL, MSG_SQL, *VIS_SQL, body="SELECT zone, visits FROM vis"))
def q_zone_visits(spark, sf_dir):

    return stats.visits(runner.final_state(spark, run_stats(spark, sf_dir)), "pickup")


@register("zone_visits_both", with_ctes(TRIPS_EV_SQL, MSG_SQL, *VIS_SQL, body="SELECT zone, visits FROM vis_both"))
def q_zone_visits_both(spark, sf_dir):

    return stats.visits(runner.final_state(spark, run_stats(spark, sf_dir)), "both")


ZB_SQL = """zb AS (
  SELECT n.n_nationkey AS zone, r.r_name AS borough FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@register("zone_topk", with_ctes(TRIPS_EV_SQL, MSG_SQL, ZSTATS_SQL, ZB_SQL, *VIS_SQL, body=f"""
SELECT CAST(row_number() OVER (ORDER BY v.visits DESC, v.zone) AS INTEGER) AS rank, v.zone,
       coalesce(zb.borough, 'Unknown') AS borough, v.visits, {STAT_NAMES}
FROM vis v LEFT JOIN zs ON v.zone = zs.zone LEFT JOIN zb ON v.zone = zb.zone ORDER BY rank LIMIT 10"""))
def q_zone_topk(spark, sf_dir):
    t = runner.report(runner.final_state(spark, run_stats(spark, sf_dir)), "top", zone_boroughs(spark, sf_dir),
                      k=10, mode="pickup")
    return _round_stats(t, ["rank", "zone", "borough", "visits"])


@register("zone_bottomk", with_ctes(TRIPS_EV_SQL, MSG_SQL, ZSTATS_SQL, ZB_SQL, *VIS_SQL, body=f"""
SELECT CAST(row_number() OVER (ORDER BY v.visits ASC, v.zone) AS INTEGER) AS rank, v.zone,
       coalesce(zb.borough, 'Unknown') AS borough, v.visits, {STAT_NAMES}
FROM vis_both v LEFT JOIN zs ON v.zone = zs.zone LEFT JOIN zb ON v.zone = zb.zone ORDER BY rank LIMIT 10"""))
def q_zone_bottomk(spark, sf_dir):
    t = runner.report(runner.final_state(spark, run_stats(spark, sf_dir)), "bottom", zone_boroughs(spark, sf_dir),
                      k=10, mode="both")
    return _round_stats(t, ["rank", "zone", "borough", "visits"])


REPORT_SQL = """seqd AS (
  SELECT *, row_number() OVER (ORDER BY pickup_datetime, source, trip_id) - 1 AS n FROM msg WHERE pickup_datetime IS NOT NULL
), rep AS (
  SELECT unnest(range(0, (SELECT count(*) // 500 FROM seqd))) AS report
), st AS (
  SELECT report, pulocationid AS zone, count(*) AS visits, avg(total_amount) AS mean
  FROM rep JOIN seqd ON n < (report + 1) * 500 WHERE pulocationid IS NOT NULL GROUP BY 1, 2
), rk AS (
  SELECT *, row_number() OVER (PARTITION BY report ORDER BY visits DESC, zone) AS t,
         row_number() OVER (PARTITION BY report ORDER BY visits, zone) AS b FROM st)""", """
SELECT 'top' AS section, report, t::INTEGER AS rank, zone::VARCHAR AS name, visits, round(mean, 6) AS total_amount_mean
FROM rk WHERE t <= 10
UNION ALL SELECT 'bottom', report, b::INTEGER, zone::VARCHAR, visits, round(mean, 6) FROM rk WHERE b <= 10
UNION ALL SELECT 'borough', report, NULL, borough, sum(visits)::BIGINT, round(sum(visits * mean) / sum(visits), 6)
FROM st JOIN zb USING (zone) GROUP BY report, borough"""


@register("stream_report", with_ctes(TRIPS_EV_SQL, MSG_SQL, ZB_SQL, REPORT_SQL[0], body=REPORT_SQL[1]))
def q_stream_report(spark, sf_dir):
    """Every periodic report, one per 500 good messages, as the stream sent it: top and
    bottom zones by pickups, and all boroughs, as they stood at that message."""
    return _reports(spark, sf_dir, run_reports(spark, sf_dir))


def run_reports(spark, sf_dir, files_per_trigger: int = REPORT_FILES_PER_TRIGGER):
    """Output folder of the reporting stream over the replayed topic."""
    out = scratch_path(spark, "reports")
    stats.run_periodic_reports(replay.replay_source(spark, replayed(spark, sf_dir), files_per_trigger), out,
                               scratch_path(spark, "reports-state"), scratch_path(spark, "reports-cp"), REPORT_INTERVAL)
    return out


def _reports(spark, sf_dir, out: str):
    states = spark.read.parquet(out).drop("batch_id")
    return stats.periodic_reports(states, zone_boroughs(spark, sf_dir)).withColumn("total_amount_mean", F.round("total_amount_mean", 6))


@register("report_states", with_ctes(TRIPS_EV_SQL, MSG_SQL, REPORT_SQL[0], body="""
SELECT report, zone, visits, round(mean, 6) AS total_amount_mean FROM st"""))
def q_report_states(spark, sf_dir):
    """The zones' states at every report by a batch over the same messages: no stream, the same numbers."""
    good = good_messages(parse_messages(records(spark, sf_dir)))
    return stats.periodic_states(good, ["offset"], REPORT_INTERVAL).select(
        "report", "zone", F.col("pickups").alias("visits"), F.round("total_amount_mean", 6).alias("total_amount_mean"))


def _run_kmeans(spark, sf_dir, files_per_trigger=KMEANS_FILES_PER_TRIGGER):
    """The clusterer's output topic: produced once per application, read by
    the labelled-records and message-key queries."""
    def build():
        out = scratch_path(spark, "kmeans-out")
        kmeans.run_stream_kmeans(replay.replay_source(spark, replayed(spark, sf_dir), files_per_trigger), out,
                                 scratch_path(spark, "kmeans-state"), scratch_path(spark, "kmeans-cp"))
        return out
    return spark.read.parquet(produced_once(spark, f"kmeans-{files_per_trigger}", sf_dir, build))


@register("stream_kmeans", with_ctes(TRIPS_EV_SQL, MSG_SQL, """seqd AS (
  SELECT trip_id, row_number() OVER (ORDER BY pickup_datetime,
      CASE WHEN service IN ('click', 'view', 'purchase') THEN 'yellow' ELSE 'fhvhv' END, trip_id) - 1 AS seq
  FROM trips_ev WHERE pickup_datetime IS NOT NULL)""", body="""
SELECT coalesce(m.key, '0_' || CAST(s.seq AS VARCHAR)) AS key, m.source, m.pickup_datetime, m.trip_distance, m.passenger_count,
       row_number() OVER (ORDER BY s.seq) - 1 AS "offset", true AS labelled
FROM msg m JOIN seqd s USING (trip_id)"""))
def q_stream_kmeans(spark, sf_dir):
    """The clusterer's records, parsed back: each is its source record with a label of 0 to 3 added, which the
    query returns; SQL compares all but the label, which tests replay message by message."""
    out = _run_kmeans(spark, sf_dir)
    label = F.regexp_extract("value", r'"cluster_id":(\d+)\}$', 1).try_cast("int")      # records may hold NaN, which isn't JSON
    back = parse_messages(out.withColumn("offset", F.col("n")), keep=("key", "offset", "value"))
    return back.where(F.col("_corrupt").isNull()).select("key", "source", "pickup_datetime", "trip_distance", "passenger_count", "offset",
                                                         label.between(0, 3).alias("labelled"))


@register("cluster_key", with_ctes(TRIPS_EV_SQL, """seqd AS (
  SELECT trip_id, row_number() OVER (ORDER BY pickup_datetime,
      CASE WHEN service IN ('click', 'view', 'purchase') THEN 'yellow' ELSE 'fhvhv' END, trip_id) - 1 AS seq
  FROM trips_ev WHERE pickup_datetime IS NOT NULL)""", body="""
SELECT coalesce(CASE WHEN trip_id % 7 <> 0 THEN CAST(trip_id AS VARCHAR) END, '0_' || CAST(seq AS VARCHAR)) AS key,
       'taxi_clustered' AS topic
FROM seqd WHERE trip_id % 101 <> 0"""))
def q_cluster_key(spark, sf_dir):
    return _run_kmeans(spark, sf_dir).select("key", "topic")


@register("dead_letters", with_ctes(TRIPS_EV_SQL, body="""
SELECT CASE WHEN trip_id % 7 <> 0 THEN CAST(trip_id AS VARCHAR) END AS key,
       CASE WHEN service IN ('click', 'view', 'purchase') THEN 'yellow_taxi_stream' ELSE 'fhvhv_taxi_stream' END AS topic
FROM trips_ev WHERE trip_id % 101 = 0 AND pickup_datetime IS NOT NULL"""))
def q_dead_letters(spark, sf_dir):
    """Messages whose value is not a JSON object, kept aside instead of dropped."""
    return dead_letters(parse_messages(encoded(spark, sf_dir))).select("key", "topic")


@register("stream_progress", with_ctes(TRIPS_EV_SQL, body="""
SELECT count(*) AS input_rows, true AS every_batch FROM trips_ev WHERE pickup_datetime IS NOT NULL"""))
def q_stream_progress(spark, sf_dir):
    """What the rolling-statistics consumer's progress table accounts for: all input, no batch missing."""
    p = runner.progress(spark, run_stats(spark, sf_dir))
    return p.agg(F.sum("input_rows").alias("input_rows"),
                 (F.count_distinct("batch_id") == F.max("batch_id") + 1).alias("every_batch"))
