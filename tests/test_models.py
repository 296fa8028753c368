import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfare.operators import ml, mlp, stats
from tests.conftest import ROOT


@pytest.fixture(scope="module")
def planted(spark):
    # fare = 3 + 2.5 * distance + 0.5 * weather + small noise; passenger count is noise
    return (spark.range(2000).withColumnRenamed("id", "trip_id")
            .withColumn("trip_distance", (F.col("trip_id") % 97).cast("double") / 10)
            .withColumn("passenger_count", (F.col("trip_id") % 5 + 1).cast("double"))
            .withColumn("weather", (F.col("trip_id") % 31).cast("double") + 20)
            .withColumn("total_amount", F.lit(3.0) + F.col("trip_distance") * 2.5 + F.col("weather") * 0.5
                        + ((F.col("trip_id") * 7919 % 13).cast("double") - 6) / 100))


def test_correlation_and_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 0.0), (3.0, 6.0, 1.0)], "a DOUBLE, b DOUBLE, c DOUBLE")
    r = {(x.col_a, x.col_b): x.r for x in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] == 1.0 and r[("a", "a")] == 1.0 and r[("a", "c")] == 0.0
    m = stats.regression_metrics(spark.createDataFrame([(1.0, 1.0), (3.0, 1.0)], "y DOUBLE, p DOUBLE"), "y", "p").first()
    assert m.n == 2 and m.rmse == pytest.approx(np.sqrt(2.0)) and m.r2 == pytest.approx(-1.0)
    b = stats.prediction_bounds(spark.createDataFrame([(1.0, -2.0), (3.0, 5.0)], "y DOUBLE, p DOUBLE"), "y", "p").first()
    assert (b.low, b.high) == (-2.0, 5.0)


def test_split_is_deterministic(planted):
    tr1, te1 = ml.train_test_split(planted, ["trip_id"])
    tr2, _ = ml.train_test_split(planted, ["trip_id"])
    assert sorted(r[0] for r in tr1.select("trip_id").collect()) == sorted(r[0] for r in tr2.select("trip_id").collect())
    assert 0.74 < tr1.count() / 2000 < 0.86 and tr1.count() + te1.count() == 2000


def test_label_refused_as_feature(planted):
    with pytest.raises(ValueError):
        ml.assemble_features(planted, ["trip_distance", "total_amount"], label="total_amount")


def test_ols_and_forward_selection_recover_signal(planted):
    train, test = ml.train_test_split(planted, ["trip_id"])
    model = ml.linear_regression(train, ["trip_distance", "weather"], "total_amount")
    assert model.coefficients[0] == pytest.approx(2.5, abs=1e-2)
    assert model.coefficients[1] == pytest.approx(0.5, abs=1e-2)
    fs = {r.predictors: r.rmse for r in ml.forward_selection(train, test, "total_amount").collect()}
    assert fs["trip_distance,weather"] < 0.05 < fs["passenger_count"]
    gram = ml.ols_gram(train, ["trip_distance", "weather"], "total_amount")
    icpt, coef = ml.ols_from_gram(gram, ["trip_distance", "weather"])
    assert coef[0] == pytest.approx(model.coefficients[0], rel=1e-8)
    assert icpt == pytest.approx(model.intercept, rel=1e-8)


def test_ols_gram_keeps_digits_at_a_large_offset(spark):
    # x = 1e8 + (i mod 100): raw sums of x*x reach 1e19 and their difference with
    # n * mean^2 would lose the spread; the centred aggregates keep the exact line
    df = (spark.range(100000, numPartitions=8)
          .select((F.lit(1e8) + (F.col("id") % 100).cast("double")).alias("x"))
          .withColumn("y", F.col("x") * 2.0 + 5.0))
    icpt, coef = ml.ols_from_gram(ml.ols_gram(df, ["x"], "y"), ["x"])
    assert coef[0] == pytest.approx(2.0, rel=1e-9)
    assert icpt == pytest.approx(5.0, abs=1e-3)


def test_scaling_constant_and_out_of_range(spark):
    train = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "x DOUBLE, c DOUBLE")
    test = spark.createDataFrame([(20.0, 7.0)], "x DOUBLE, c DOUBLE")
    _, te, fit = ml.scale_features(train, test, ["x", "c"])
    r = te.first()
    assert fit == {"x": (0.0, 10.0), "c": (5.0, 5.0)}
    assert (r.x_scaled, r.c_scaled) == (2.0, 0.5)


def test_mlp_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    ws = mlp.init_weights([3, 4, 4, 1], seed=1)
    ws[-1] = ws[-1] + 1.0                       # keep the output ReLU active
    x, y = rng.normal(size=(16, 3)), rng.normal(size=16)
    _, grads = mlp.loss_and_grad(ws, x, y)
    for k in (0, 1, len(ws) - 2):
        idx = (0,) * ws[k].ndim
        eps = 1e-6
        wp = [w.copy() for w in ws]
        wp[k][idx] += eps
        wm = [w.copy() for w in ws]
        wm[k][idx] -= eps
        num = (mlp.loss_and_grad(wp, x, y)[0] - mlp.loss_and_grad(wm, x, y)[0]) / (2 * eps)
        assert grads[k][idx] == pytest.approx(num, rel=1e-4, abs=1e-6)


def plain_adam(sizes, batches, lr):
    """Weights after one step for each batch, by ``loss_and_grad`` in double precision."""
    w = np.concatenate([a.ravel() for a in mlp.init_weights(sizes)])
    w[-1] += 0.3
    like = [a.shape for a in mlp.init_weights(sizes)]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step, rows in enumerate(batches, 1):
        cuts = np.split(w, np.cumsum([np.prod(s) for s in like])[:-1])
        _, grads = mlp.loss_and_grad([c.reshape(s) for c, s in zip(cuts, like, strict=True)], rows[:, :-2], rows[:, -1])
        g = np.concatenate([a.ravel() for a in grads]) / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + mlp.EPSILON)
    return w


def test_networks_side_by_side_take_the_steps_of_each_alone():
    sizes, rng = mlp.layer_sizes(3), np.random.default_rng(4)
    first = np.concatenate([a.ravel() for a in mlp.init_weights(sizes)])
    first[-1] += 0.3
    state = np.concatenate([first, np.zeros(2 * len(first))])
    x = rng.random((2 * 4 * 64 + 64 + 10, 3))  # two steps of four networks, a step of one, a short step of another
    block = np.column_stack([x, np.ones(len(x)), x @ [1.0, 2.0, 0.5]])
    held = block[:50]
    out, rows, loss, networks, val_rows, _ = mlp._adam_pass(sizes, state, 0, 1e-2, [(block, held), (block[:0], held[:0])], 5, side=4)
    assert (rows, networks, val_rows) == (len(block), 4, 50) and np.isfinite(loss)
    dealt = block[np.random.default_rng(5).permutation(len(block))]
    steps = [[dealt[(i * 4 + j) * 64:(i * 4 + j + 1) * 64] for i in range(2)] for j in range(4)]
    left = dealt[512:]  # waits; shuffled once more when no block follows
    rng = np.random.default_rng(5)
    rng.permutation(len(block))
    left = left[rng.permutation(len(left))]
    steps[0].append(left[:64])
    steps[1].append(left[64:])
    want = sum(plain_adam(sizes, own, 1e-2) * sum(map(len, own)) for own in steps)
    # single precision: Adam's first steps turn gradients near zero into whole steps of either sign
    off, moved = out[:len(first)] / rows - want / rows, want / rows - first
    assert np.linalg.norm(off) < 0.1 * np.linalg.norm(moved)


def test_rows_are_dealt_evenly_over_the_tasks(spark):
    rows = spark.range(8000, numPartitions=1).selectExpr("CAST(id AS DOUBLE) AS x", "2.0D * id AS y", "id % 5 = 0 AS _is_val")
    blocks = mlp._blocks(rows, ["x"], "y", 2.0, 4)
    assert blocks.rdd.getNumPartitions() == 4
    sizes = [sum(len(r.train) + len(r.held) for r in part) // 24 for part in blocks.rdd.glom().collect()]
    assert sum(sizes) == 8000 and max(sizes) - min(sizes) <= 4


def test_mlp_trains_and_predicts(spark, planted):
    feats = ["trip_distance", "weather"]
    train, test = ml.train_test_split(planted, ["trip_id"])
    tr_s, te_s, _ = ml.scale_features(train, test, feats)
    sf = [f + "_scaled" for f in feats]
    ws, hist = mlp.train_mlp(tr_s, sf, "total_amount", ["trip_id"], epochs=30)
    assert 1 < len(hist) <= 30 and min(h[1] for h in hist) < hist[0][1]
    assert min(h[3] for h in hist) < hist[0][3]
    pred = mlp.batch_predict(te_s.select("trip_id", *sf, "total_amount"), ws, sf)
    assert pred.count() == test.count() and pred.where(F.col("prediction").isNull()).count() == 0


def test_network_learns_and_its_weights_survive_a_table(spark, planted, tmp_dir):
    feats = ["trip_distance", "weather"]
    train, test = ml.train_test_split(planted, ["trip_id"])
    tr_s, te_s, _ = ml.scale_features(train.repartition(3, "trip_id"), test, feats)
    names = [f + "_scaled" for f in feats]
    ws, hist = mlp.train_mlp(tr_s, names, "total_amount", ["trip_id"], epochs=40)
    variance = test.agg(F.var_pop("total_amount")).first()[0]
    assert mlp.mean_squared_error(te_s, ws, names, "total_amount") < 0.2 * variance
    mlp.save_weights(spark, ws, tmp_dir + "/weights")
    assert all(np.array_equal(a, b) for a, b in zip(ws, mlp.load_weights(spark, tmp_dir + "/weights"), strict=True))


def test_constant_label_and_constant_predictor(spark, planted):
    one = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y DOUBLE, p DOUBLE")
    assert stats.regression_metrics(one, "y", "p").first().r2 is None
    flat = planted.withColumn("weather", F.lit(0.0))
    train, test = ml.train_test_split(flat, ["trip_id"])
    found = {r.predictors: r for r in ml.forward_selection(train, test, "total_amount").collect()}
    assert found["trip_distance,weather"].rmse == pytest.approx(found["trip_distance"].rmse, rel=1e-6)
    same = planted.withColumn("total_amount", F.lit(7.0))
    train, test = ml.train_test_split(same, ["trip_id"])
    assert all(r.r2 is None for r in ml.forward_selection(train, test, "total_amount").collect())


def test_predict_keeps_rows_with_a_null_feature(spark, planted):
    model = ml.linear_regression(planted, ["trip_distance", "weather"], "total_amount")
    df = spark.createDataFrame([(1, 2.0, None), (2, float("nan"), 1.0), (3, 1.0, 2.0)],
                               "trip_id INT, trip_distance DOUBLE, weather DOUBLE")
    got = {r.trip_id: r.prediction for r in ml.predict(model, df, ["trip_distance", "weather"]).collect()}
    assert got[1] is None and got[2] is None and got[3] is not None


def test_workers_find_the_package_from_another_folder(tmp_path):
    # the driver has the package on its path only; the workers get it shipped
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from skyfare.session import build_session
from skyfare.operators import mlp
spark = build_session(master="local[2]", shuffle_partitions=2)
df = spark.range(300).selectExpr("id AS k", "id / 300.0D AS x", "2.0D * id AS y")
ws, hist = mlp.train_mlp(df, ["x"], "y", ["k"], epochs=2)
assert len(hist) == 2 and mlp.batch_predict(df, ws, ["x"]).where("prediction IS NOT NULL").count() == 300
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
