import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbflow.operators import forecast
from kerbflow.operators.ranking import exact_quantiles, with_position


def test_with_position_groups(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 37) % 1000).alias("v"))
    out = with_position(df, ["v"], ["g"], name="pos").collect()
    for g in range(3):
        rows = sorted((r["pos"], r["v"]) for r in out if r["g"] == g)
        assert [p for p, _ in rows] == list(range(len(rows)))
        assert [v for _, v in rows] == sorted(v for _, v in rows)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.exponential(3.0, 777)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(vals)], "g int, v double")
    q = {r["g"]: r for r in exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"]).collect()}
    for g in (0, 1):
        sub = vals[g::2]
        for p in (25, 50, 75):
            assert q[g][f"q{p}"] == pytest.approx(np.percentile(sub, p), rel=1e-12)


def row_by_row(x, y, eta0, power_t, alpha):
    """Plain sequential SGD with an inverse-scaling rate; the intercept is not shrunk."""
    w = np.zeros(x.shape[1] + 1)
    for t, (row, target) in enumerate(zip(x, y), 1):
        z, eta = np.append(1.0, row), eta0 / t ** power_t
        r = w @ z - target
        w = w * np.append(1.0, np.full(len(row), 1 - eta * alpha)) - eta * r * z
    return w


def sgd_frame(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 2)) * [1.0, 30.0] + [5.0, -7.0], 6)
    y = 3.0 + 2.0 * x[:, 0] - 0.1 * x[:, 1] + np.round(rng.normal(scale=0.3, size=n), 6)
    rows = [(int(i), float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "pickup_hour long, a double, b double, y double").repartition(5)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    return df, z, y


def test_a_chain_of_updates_is_the_sequential_pass():
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 65, 500):
        x, y = rng.normal(size=(n, 3)), rng.normal(size=n) * 10
        got = forecast.sgd_chain(np.zeros(4), np.column_stack([np.ones(n), x]), y, 0, 0.05, 0.25, 1e-2)
        assert got == pytest.approx(row_by_row(x, y, 0.05, 0.25, 1e-2), rel=1e-9, abs=1e-9)


def test_one_block_is_the_sequential_pass_and_more_come_near(spark):
    df, z, y = sgd_frame(spark, 20_000)
    want = row_by_row(z, y, 0.01, 0.25, 1e-4)
    one = forecast.fit_ordered_sgd(df, features=("a", "b"), label="y")
    assert one["coef"] == pytest.approx(want, rel=1e-6)
    many = forecast.fit_ordered_sgd(df, features=("a", "b"), label="y", block_rows=5000)
    assert many["coef"] == pytest.approx(want, abs=0.05 * np.abs(want).max())             # the stated tolerance: 5 %
    err, base = (forecast.error_metrics(p, "y")["mse"] for p in (forecast.predict_sgd(df, many), df.withColumn("prediction", F.lit(float(y.mean())))))
    assert err < 0.1 * base
    with pytest.raises(ValueError):
        forecast.fit_ordered_sgd(df.limit(0), features=("a", "b"), label="y")


@pytest.mark.parametrize("block_rows", [7000, 1000, 150])
def test_blocks_go_on_from_the_weights_of_the_block_before(spark, block_rows):
    # What y hangs on turns over in the last quarter: the end of the pass counts, which a mean over the blocks loses.
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(8000, 2)) * [2.0, 0.5] + [1.0, 40.0], 6)
    y = np.round(np.where(np.arange(8000) < 6000, 1.0, -1.0) * (5.0 + 3.0 * x[:, 0]) + x[:, 1], 6)
    rows = [(int(i), float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "pickup_hour long, a double, b double, y double").repartition(5)
    got = forecast.fit_ordered_sgd(df, features=("a", "b"), label="y", block_rows=block_rows)
    want = row_by_row((x - x.mean(axis=0)) / x.std(axis=0), y, 0.01, 0.25, 1e-4)
    assert got["coef"] == pytest.approx(want, rel=1e-6)


def test_a_step_takes_any_weights_where_the_chain_takes_them():
    rng = np.random.default_rng(8)
    z, y, w = np.column_stack([np.ones(300), rng.normal(size=(300, 3))]), rng.normal(size=300) * 10, rng.normal(size=4) * 100
    step = np.eye(4, 5)
    for at in (0, 130):                                     # batches of a block
        end = at + 130 if at == 0 else 300
        step = forecast.sgd_step(step, z[at:end], y[at:end], 1000 + at, 0.05, 0.25, 1e-2)
    assert step[:, :-1] @ w + step[:, -1] == pytest.approx(forecast.sgd_chain(w, z, y, 1000, 0.05, 0.25, 1e-2), rel=1e-9)


def test_distance_summary_ungrouped(spark):
    from kerbflow.operators import eda
    vals = [float(v) for v in range(1, 101)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "trip_distance double")
    ex = eda.distance_summary(df, exact=True).first()
    assert ex["count"] == 100 and ex["min"] == 1.0 and ex["max"] == 100.0
    assert (ex["q25"], ex["q50"], ex["q75"]) == (25.75, 50.5, 75.25)
    ap = eda.distance_summary(df).first()
    assert ap["count"] == 100 and 24 <= ap["q25"] <= 27 and ap["std"] == pytest.approx(np.std(range(1, 101), ddof=1))


def test_forecast_metrics_beats_mean(spark, tmp_dir):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        year = [2019, 2020, 2021, 2022, 2023, 2024][i % 6]
        hour, dow, month = int(rng.integers(0, 24)), int(rng.integers(0, 7)), int(rng.integers(1, 13))
        lat, lon = float(rng.normal()), float(rng.normal())
        y = 20 + 3 * hour - 2 * dow + 5 * lat + rng.normal(scale=2.0)
        rows.append((year, hour, dow, month, lat, lon, float(y)))
    df = spark.createDataFrame(rows, "year int, hour int, dow int, month int, lat double, lon double, trip_count double")
    feats = forecast.split_by_year(df)
    m = {(r["model"], r["split"]): r for r in
         forecast.forecast_metrics(feats, gbt_iterations=5, gbt_depth=3, block_rows=5000, save_dir=f"{tmp_dir}/m").collect()}
    assert set(m) == {(a, b) for a in ("mean", "linear", "gbt", "ordered_sgd") for b in ("validation", "test")}
    val = feats.where("split = 'validation'")
    mean_only = val.agg(F.variance("trip_count")).first()[0]
    assert m[("linear", "validation")]["mse"] < 0.1 * mean_only
    assert m[("ordered_sgd", "validation")]["mse"] < 0.5 * mean_only
    assert m[("gbt", "validation")]["mse"] < mean_only
    import os
    assert os.path.isdir(f"{tmp_dir}/m/linear") and os.path.isdir(f"{tmp_dir}/m/gbt")


def test_null_group_keeps_its_rows_and_quantiles(spark):
    from kerbflow.operators import eda
    from kerbflow.operators.ranking import with_position
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", 7.0)], "g string, trip_distance double")
    assert sorted((str(r.g), r.pos) for r in with_position(df, ["trip_distance"], ["g"]).collect()) == [
        ("None", 0), ("None", 1), ("a", 0), ("a", 1)]
    got = {r.g: (r["count"], r.q50) for r in eda.distance_summary(df, by=["g"], exact=True).collect()}
    assert got == {None: (2, 2.0), "a": (2, 6.0)}


def test_boosting_passes_over_combinations_of_features_and_fits_all_rows(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor
    seen, scores = [], {}

    class Counted(GBTRegressor):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)

    rng = np.random.default_rng(5)
    rows = []
    for i in range(2400):                                   # 24 combinations, met by uneven numbers of rows
        hour, dow = int(24 * rng.random() ** 2) // 3, int(rng.integers(0, 3))
        rows.append(([2019, 2020, 2021, 2023, 2024][i % 5], hour, dow, 1 + dow, 40.5 + dow, -74.0, int(rng.poisson(5 + 4 * hour * (dow + 1)))))
    feats = forecast.split_by_year(spark.createDataFrame(rows, "year int, hour int, dow int, month int, lat double, lon double, trip_count long")).cache()
    data = forecast.assemble(feats)
    train = data.where("split = 'train'")
    direct = GBTRegressor(featuresCol="features", labelCol="trip_count", maxIter=6, maxDepth=3, stepSize=0.3, maxBins=256, seed=42).fit(train)
    for split in ("validation", "test"):
        scores[split] = forecast.error_metrics(direct.transform(data.where(F.col("split") == split)))
    monkeypatch.setattr(forecast, "GBTRegressor", Counted)
    got = {r["split"]: r for r in forecast.forecast_metrics(feats, gbt_iterations=6, gbt_depth=3).where("model = 'gbt'").collect()}
    assert seen == [train.select("features").distinct().count()] and seen[0] <= 24
    for split, want in scores.items():
        assert got[split]["n"] == want["n"] and got[split]["mse"] == pytest.approx(want["mse"], rel=1e-9)
        assert got[split]["mae"] == pytest.approx(want["mae"], rel=1e-9)
