import json
import os

import pytest
from pyspark.sql import functions as F

from kerbflow.streaming import kmeans, replay, runner, stats
from kerbflow.streaming.messages import KAFKA_SCHEMA, good_messages, parse_messages


def msgs(spark, values):
    rows = [(str(i), v, "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def test_parse_edges(spark):
    vals = [
        '{"pulocationid": 3, "dolocationid": 4, "trip_distance": 2.5, "tip_amount": 1, "total_amount": 10}',
        '{broken',
        '{"pulocationid": "", "dolocationid": null, "trip_distance": "1.5"}',      # "" and null, text number
        '{"pulocationid": "7", "trip_distance": NaN, "trip_miles": 4.0, "tips": -1, "driver_pay": Infinity}',
        '{"pulocationid": 3.9, "trip_distance": -2, "total_amount": "x", "driver_pay": "12.5"}',
        '{"pulocationid": 265, "trip_miles": "3"}',
    ]
    p = parse_messages(msgs(spark, vals)).orderBy("offset").collect()
    assert p[1]["_corrupt"] == "{broken"
    good = [r for r in p if r["_corrupt"] is None]
    assert [(r["pulocationid"], r["dolocationid"]) for r in good] == [(3, 4), (None, None), (7, None), (3, None), (265, None)]
    assert [r["trip_distance"] for r in good] == [2.5, 1.5, 4.0, 0.0, 3.0]
    assert [r["tip_amount"] for r in good] == [1.0, 0.0, 0.0, 0.0, 0.0]
    assert [r["total_amount"] for r in good] == [10.0, 0.0, 0.0, 12.5, 0.0]


def state_of(spark, rows):
    df = spark.createDataFrame(rows, "pulocationid int, dolocationid int, trip_distance double, tip_amount double, total_amount double")
    return stats.zone_state(df)


def test_topk_ties_and_few_zones(spark):
    rows = [(1, 9, 1.0, 0.0, 1.0)] * 3 + [(2, 9, 1.0, 0.0, 1.0)] * 2 + [(3, 9, 1.0, 0.0, 1.0)] * 2 + [(4, 9, 2.0, 0.0, 1.0)]
    st = state_of(spark, rows)
    top = [(r["rank"], r["zone"], r["visits"]) for r in stats.ranked_zones(st, 2).orderBy("rank").collect()]
    assert top == [(1, 1, 3), (2, 2, 2)]                     # tie at the cut: lower zone id first
    bottom = [(r["zone"], r["visits"]) for r in stats.ranked_zones(st, 10, top=False).orderBy("rank").collect()]
    assert bottom == [(4, 1), (2, 2), (3, 2), (1, 3)]        # fewer than K zones
    both = {r["zone"]: (r["visits"], r["trip_distance_count"], r["trip_distance_mean"])
            for r in stats.ranked_zones(st, 10, "both").collect()}
    assert both[9] == (8, 0, 0.0)                             # seen only as dropoff: zero stats


def test_stream_equals_batch_and_restart(spark, tmp_dir):
    import random
    rnd = random.Random(1)
    recs = []
    for i in range(600):
        v = {"pulocationid": rnd.randint(1, 6), "dolocationid": rnd.randint(1, 6),
             "trip_distance": round(rnd.uniform(0, 9), 2), "tip_amount": round(rnd.uniform(0, 3), 2),
             "total_amount": round(rnd.uniform(3, 40), 2)}
        recs.append((None, json.dumps(v), "t", 0, i))
    df = spark.createDataFrame(recs, KAFKA_SCHEMA)
    src = f"{tmp_dir}/src"
    df.where("offset < 300").repartitionByRange(3, "offset").write.parquet(f"{src}/a")
    out, cp = f"{tmp_dir}/out", f"{tmp_dir}/cp"
    runner.run_rolling_stats(replay.replay_source(spark, f"{src}/*"), out, cp)
    df.where("offset >= 300").repartitionByRange(3, "offset").write.parquet(f"{src}/b")
    runner.run_rolling_stats(replay.replay_source(spark, f"{src}/*"), out, cp)     # restart from checkpoint
    streamed = {r["zone"]: (r["pickups"], round(r["total_amount_mean"], 9), round(r["total_amount_std"], 9))
                for r in runner.final_state(spark, out).collect()}
    batch = {r["zone"]: (r["pickups"], round(r["total_amount_mean"], 9), round(r["total_amount_std"], 9))
             for r in stats.zone_state(good_messages(parse_messages(df))).collect()}
    assert streamed == batch
    assert runner.state_history(spark, out).select("batch_id").distinct().count() >= 2


def test_merge_sorted_permutation(spark):
    a = spark.range(0, 300).select(F.col("id").alias("trip_id"),
                                   F.timestamp_seconds((F.col("id") * 7) % 101).cast("timestamp_ntz").alias("pickup_datetime"))
    b = spark.range(300, 500).select(F.col("id").alias("trip_id"),
                                     F.timestamp_seconds((F.col("id") * 3) % 53).cast("timestamp_ntz").alias("pickup_datetime"))
    m = replay.merge_by_time({"yellow": a, "fhvhv": b}).orderBy("seq").collect()
    assert [r["seq"] for r in m] == list(range(500))
    keys = [(r["pickup_datetime"], r["source"], r["trip_id"]) for r in m]
    assert keys == sorted(keys)
    assert sorted(r["trip_id"] for r in m) == list(range(500))


def test_kmeans_separates_clusters(spark, tmp_dir):
    import random
    rnd = random.Random(5)
    centres = [(1.0, 5.0), (20.0, 80.0)]
    recs = []
    for i in range(800):
        cx, cy = centres[i % 2]
        recs.append((None, json.dumps({"trip_distance": cx + rnd.gauss(0, 0.3), "total_amount": cy + rnd.gauss(0, 1)}),
                     "t", 0, i))
    spark.createDataFrame(recs, KAFKA_SCHEMA).repartitionByRange(8, "offset").write.parquet(f"{tmp_dir}/src")
    out, state = f"{tmp_dir}/out", f"{tmp_dir}/state"
    kmeans.run_stream_kmeans(replay.replay_source(spark, f"{tmp_dir}/src"), out, state, f"{tmp_dir}/cp", k=4,
                             features=("trip_distance", "total_amount"), block=100)
    res = spark.read.parquet(out)
    assert res.count() == 800
    lab = res.where(F.col("n") >= 600).groupBy("cluster_id").agg(
        F.min("total_amount").alias("lo"), F.max("total_amount").alias("hi")).collect()
    for r in lab:                                           # no cluster mixes the two groups
        assert r["hi"] < 40 or r["lo"] > 40
    assert res.where(F.col("key").isNull()).count() == 0
    assert res.select("key").first()["key"].startswith("0_")


def test_clusterer_keeps_the_record_and_its_state(spark, tmp_dir):
    text = '{"driver_pay": 12.5, "trip_miles": 3, "pickup_datetime": "2024-01-01T10:00:00", "extra_field": "x"} '
    msgs(spark, [text, "{}", '{"a": {"b": 1}}']).coalesce(1).write.parquet(f"{tmp_dir}/src")
    out, state = f"{tmp_dir}/out", f"{tmp_dir}/state"
    sent = []
    kmeans.run_stream_kmeans(replay.replay_source(spark, f"{tmp_dir}/src"), out, state, f"{tmp_dir}/cp",
                             publish=lambda df: sent.extend(df.collect()))
    assert len(sent) == 3
    rows = spark.read.parquet(out).orderBy("key").collect()
    for r, t in zip(rows, [text, "{}", '{"a": {"b": 1}}']):
        v = json.loads(r["value"])
        assert v.pop("cluster_id") == r["cluster_id"] and v == json.loads(t)
    os.remove(f"{state}/batch_id=0/values.json")
    msgs(spark, [text]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")
    with pytest.raises(Exception, match="does not fit"):         # a lost state is no reason to start from seeds
        kmeans.run_stream_kmeans(replay.replay_source(spark, f"{tmp_dir}/src"), out, state, f"{tmp_dir}/cp")


def replayed_folder(spark, path, recs, files):
    """Messages in files whose times go up with the offset."""
    per = -(-len(recs) // files)
    for i in range(files):
        part = recs[i * per:(i + 1) * per]
        if part:
            spark.createDataFrame(part, KAFKA_SCHEMA).coalesce(1).write.parquet(f"{path}/{i:03d}")
            for f in os.listdir(f"{path}/{i:03d}"):
                os.utime(f"{path}/{i:03d}/{f}", (1_700_000_000 + i * 10,) * 2)
    return f"{path}/*"


def random_messages(n, seed=3):
    import random
    rnd, recs = random.Random(seed), []
    for i in range(n):
        v = {"pulocationid": rnd.randint(1, 6), "dolocationid": rnd.randint(1, 6), "trip_distance": round(rnd.uniform(0, 9), 2),
             "passenger_count": rnd.randint(1, 6), "total_amount": round(rnd.uniform(3, 40), 2), "source": "yellow"}
        text = json.dumps(v)
        if i % 17 == 5:
            text = text[:20]                                     # no JSON
        if i % 23 == 7:
            text = text.replace('"pulocationid"', '"elsewhere"')
        recs.append((str(i), text, "t", 0, i))
    return recs


def brute_kmeans(points, k, halflife, block, seed=42):
    """Blocks of messages one after another, in plain numpy."""
    import numpy as np
    centres = kmeans.initial_centres(k, 2, seed)
    weights, fade, labels = np.ones(k), (1 - halflife) ** (1 / k), []
    for start in range(0, len(points), block):
        x = np.array(points[start:start + block])
        near = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new, weights = centres.copy(), weights * fade ** len(x)
        for c in set(near.tolist()):
            w = fade ** (len(x) - 1 - np.flatnonzero(near == c))
            total = weights[c] + w.sum()
            new[c] = (weights[c] * centres[c] + (w[:, None] * x[near == c]).sum(axis=0)) / total
            weights[c] = total
        centres = new
        labels += ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()
    return labels, centres


@pytest.mark.parametrize("files", [1, 5, 9])
def test_clusters_are_those_of_a_message_by_message_replay(spark, tmp_dir, files):
    recs = random_messages(330)
    src = replayed_folder(spark, f"{tmp_dir}/src", recs, 9)
    out, state = f"{tmp_dir}/out", f"{tmp_dir}/state"
    run = lambda: kmeans.run_stream_kmeans(replay.replay_source(spark, src, files), out, state, f"{tmp_dir}/cp", block=40)
    run()
    good = [json.loads(v) for _, v, *_ in recs if v.endswith("}")]
    labels, _ = brute_kmeans([(g["trip_distance"], g["passenger_count"]) for g in good], 4, 0.1, 40)
    got = {r.n: r.cluster_id for r in spark.read.parquet(out).collect()}
    assert [got[i] for i in range(len(good))] == labels and len(got) == len(good) and len(set(labels)) > 1
    if files == 5:                                               # started again with more messages behind
        more = [(k, v, t, p, o + 330) for k, v, t, p, o in random_messages(100, seed=4)]
        spark.createDataFrame(more, KAFKA_SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/src/zzz")
        run()
        good += [json.loads(v) for _, v, *_ in more if v.endswith("}")]
        labels, _ = brute_kmeans([(g["trip_distance"], g["passenger_count"]) for g in good], 4, 0.1, 40)
        got = {r.n: r.cluster_id for r in spark.read.parquet(out).collect()}
        assert [got[i] for i in range(len(good))] == labels and len(got) == len(good)


def test_cluster_vectors_merge_in_any_cut(spark):
    rows = [(i, float(i % 7), float(i % 3)) for i in range(50)]
    df = spark.createDataFrame(rows, "n long, trip_distance double, passenger_count double")
    start = kmeans.Clusters.start(3, 2)
    whole = {r.cluster_id: r for r in kmeans.cluster_vectors(df, start, 49, 0.9).collect()}
    parts: dict = {}
    for a, b in ((0, 13), (13, 14), (14, 50)):
        for r in kmeans.cluster_vectors(df.where((F.col("n") >= a) & (F.col("n") < b)), start, 49, 0.9).collect():
            parts[r.cluster_id] = [x + y for x, y in zip(parts.get(r.cluster_id, [0.0] * 4), (r.w, r.q, r.s0, r.s1))]
    assert set(parts) == set(whole)
    assert all(abs(x - y) < 1e-9 for c, v in parts.items() for x, y in zip(v, (whole[c].w, whole[c].q, whole[c].s0, whole[c].s1)))
    assert (start.merged(list(whole.values()), 0.9 ** 50).radii() >= 0).all()


@pytest.mark.parametrize("files", [1, 4, 9])
def test_each_report_leaves_the_stream_once(spark, tmp_dir, files):
    recs = random_messages(530)
    src = replayed_folder(spark, f"{tmp_dir}/src", recs[:400], 9)
    out, state = f"{tmp_dir}/out", f"{tmp_dir}/state"
    run = lambda: stats.run_periodic_reports(replay.replay_source(spark, src, files), out, state, f"{tmp_dir}/cp", 50)     # noqa: E731
    run()

    def check(records):
        good = good_messages(parse_messages(spark.createDataFrame(records, KAFKA_SCHEMA)))
        want = {(r.report, r.zone): (r.pickups, round(r.total_amount_mean, 9)) for r in stats.periodic_states(good, ["offset"], 50).collect()}
        rows = spark.read.parquet(out).collect()
        got = {(r.report, r.zone): (r.pickups, round(r.total_amount_mean, 9)) for r in rows}
        assert got == want and len(rows) == len(want) and len({k for k, _ in want}) == sum(v.endswith("}") for _, v, *_ in records) // 50
        return {r.batch_id for r in rows}
    first = check(recs[:400])
    assert len(first) > (1 if files < 9 else 0)
    spark.createDataFrame(recs[400:], KAFKA_SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/src/zzz")
    run()                                                        # started again: counts go on, no report is sent twice
    check(recs)


def test_parsing_reads_json_once_and_keeps_generated_code(spark):
    p = good_messages(parse_messages(msgs(spark, ['{"trip_distance": 1, "total_amount": 2}'])))
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 1 and plan.count("Generate explode") == 2
    text = p._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_borough_std_at_large_means(spark):
    rows = [(z, 9, 1e9 + z * 5.0 + k, 0.0, 1.0) for z in (1, 2) for k in (0.0, 1.0, 2.0)]
    zb = spark.createDataFrame([(1, "B"), (2, "B")], "zone int, borough string")
    got = stats.borough_stats(state_of(spark, rows), zb).first()
    values = [r[2] for r in rows]
    mean = sum(values) / 6
    assert abs(got["trip_distance_std"] - (sum((v - mean) ** 2 for v in values) / 6) ** 0.5) < 1e-6


@pytest.mark.parametrize("partitions", ["2", "16"])
def test_reports_do_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame([(i, i % 5 if i % 7 else None, float(i % 11)) for i in range(1030)],
                                   "offset long, pulocationid int, total_amount double")
        got = {(r.report, r.zone): (r.pickups, round(r.total_amount_mean, 9))
               for r in stats.periodic_states(df, ["offset"], 100).collect()}
        want = {}
        for rep in range(10):
            for z in range(5):
                v = [float(i % 11) for i in range((rep + 1) * 100) if i % 7 and i % 5 == z]
                want[rep, z] = (len(v), round(sum(v) / len(v), 9))
        assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_kafka_writers_build_for_batches(spark):
    df = spark.createDataFrame([("k", "v", "t")], "key string, value string, topic string")
    assert replay.kafka_batch(df, "host:1") is not None
    with pytest.raises(Exception, match="(?i)kafka"):         # no connector in the test session
        replay.kafka_sink(df, "host:1", "/unused")


@pytest.mark.parametrize("chain", [True, False])
def test_kmeans_needs_no_job_per_block(spark, tmp_dir, monkeypatch, chain):
    recs = random_messages(300, seed=8)
    good = [json.loads(v) for _, v, _, _, _ in recs if v.endswith("}")]
    labels, _ = brute_kmeans([(v["trip_distance"], float(v["passenger_count"])) for v in good], 4, 0.1, 10)
    monkeypatch.setattr(kmeans, "CHAIN_BLOCK", 10 if chain else 9)
    jobs, vectors = [], kmeans.cluster_vectors
    monkeypatch.setattr(kmeans, "cluster_vectors", lambda *a, **b: jobs.append(1) or vectors(*a, **b))
    src = replayed_folder(spark, f"{tmp_dir}/src", recs, 2)
    kmeans.run_stream_kmeans(replay.replay_source(spark, src, 1), f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/cp", block=10)
    got = [r.cluster_id for r in spark.read.parquet(f"{tmp_dir}/out").orderBy("n").collect()]
    assert got == labels
    assert len(jobs) == (0 if chain else -(-len(good) // 10))


def test_longer_replays_have_larger_files_not_more():
    from kerbflow.plans import q_stream
    assert q_stream.rows_per_file(100_000) == q_stream.ROWS_PER_FILE == 500
    for n in (6_000_000, 36_000_000):
        assert -(-n // q_stream.rows_per_file(n)) <= q_stream.REPLAY_FILES
