"""The network and the squared hinge SVM: gradients, invariance, stopping, optimality."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revspark.operators import blocks as B
from revspark.operators import network as N
from revspark.operators import squared_hinge as H
from revspark.operators import training as TR

SCHEMA = "id long, embedding array<float>, label int"


def toy(spark, n=400, d=6, noise=0.0, seed=7, first=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(first, first + n):
        y = i % 2
        v = [rnd.gauss(1.2 if y else -1.2, 1.0) if j < 2 else rnd.gauss(3, 2) for j in range(d)]
        rows.append((i, v, y if rnd.random() >= noise else 1 - y))
    return spark.createDataFrame(rows, SCHEMA)


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(3)
    sizes, x, y = [5, 7, 4, 3], rng.normal(size=(9, 5)), rng.integers(0, 2, 9).astype(float)
    theta = N.initial(sizes, 1) + rng.normal(size=len(N.initial(sizes, 1))) * 0.1
    for dropout in (0.0, 0.4):
        def loss(t):
            r = np.random.default_rng(5) if dropout else None
            return N.backward(t, sizes, dropout, x, y, r)[2]
        grad = N.backward(theta, sizes, dropout, x, y, np.random.default_rng(5) if dropout else None)[0]
        for i in range(len(theta)):
            e = np.zeros_like(theta)
            e[i] = 1e-6
            assert (loss(theta + e) - loss(theta - e)) / 2e-6 == pytest.approx(grad[i], abs=2e-6)


def test_blocks_follow_from_the_rows(spark):
    """Same members whatever the partitions; all about equally large; odd rows left out."""
    df = toy(spark, 500)
    odd = spark.createDataFrame([(900, None, 1), (901, [1.0], 0), (902, [1.0] * 6, None)], SCHEMA)
    seen = []
    for parts in (1, 8):
        made = B.gathered(df.union(odd).repartition(parts), 16)
        rows = {r["block"]: list(zip(r["x"], r["y"])) for r in made.frame.collect()}
        seen.append(rows)
        assert (made.n, made.d) == (500, 6) and made.count == len(rows)
        sizes = [len(r["y"]) for r in made.frame.collect()]
        assert min(sizes) >= 16 and max(sizes) <= 18 and sum(sizes) == 500
        mean, sd = B.moments(made)
        x = np.array([r["embedding"] for r in df.collect()], dtype=np.float64)
        assert np.allclose(mean, x.mean(0)) and np.allclose(sd, x.std(0))
        made.unpersist()
    assert seen[0] == seen[1]


def test_sums_go_along_a_tree(spark, monkeypatch):
    monkeypatch.setattr(B, "FAN", 2)
    made = B.gathered(toy(spark, 300).repartition(8), 10)
    made.partitions = 8
    assert B.summed(made, lambda block, x, y, w: np.array([len(y), y.sum()], dtype=float)).tolist() == [300.0, 150.0]
    assert B.summed(made, lambda *a: None) is None


def test_same_network_for_any_partitions(spark):
    train, val = toy(spark, 320), toy(spark, 120, seed=8, first=1000)
    nets = [N.train_network(train.repartition(p), val.repartition(p), [8, 4], 0.2, 0.01, 16, epochs=4, steps=4) for p in (1, 8)]
    assert np.allclose(nets[0].theta, nets[1].theta, atol=1e-9)
    assert np.allclose([h[1:6] for h in nets[0].history], [h[1:6] for h in nets[1].history])
    scored = [{r["id"]: r["probability"] for r in N.score_network(nets[0], toy(spark, 50).repartition(p)).collect()} for p in (1, 5)]
    assert scored[0] == pytest.approx(scored[1]) and len(scored[0]) == 50


def test_network_learns_and_stops(spark):
    """Right on most held-out rows; noisy labels make it stop after `patience` epochs without a lower
    validation loss, and the parameters are those of the best epoch."""
    train, val = toy(spark, 480, noise=0.25), toy(spark, 160, noise=0.25, seed=9, first=1000)
    net = N.train_network(train, val, [32, 16], 0.0, 0.05, 16, epochs=40, patience=3, steps=6)
    h = N.history(net, spark).orderBy("epoch").collect()
    best = max(i for i, r in enumerate(h) if r["is_best"])
    assert len(h) < 40 and len(h) - 1 - best == 3
    assert h[best]["val_loss"] == min(r["val_loss"] for r in h)
    held = B.gathered(val, 16)
    assert N.validate(held, net)[0] == pytest.approx(h[best]["val_loss"])
    held.unpersist()
    scored = N.score_network(net, toy(spark, 200, seed=11, first=5000))
    assert scored.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.85


def test_plateau_halves_the_rate(spark):
    """Labels that cannot be learnt: after six epochs without gain the rate is half."""
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 1)] * 3, rnd.randrange(2)) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    val = spark.createDataFrame([(i + 500, v, 1 - y) for i, v, y in rows], SCHEMA)  # the contrary
    net = N.train_network(df, val, [8], 0.0, 0.05, 20, epochs=10, patience=50, steps=3)
    used = [r[5] for r in net.history]
    assert used[0] == 0.05 and used[-1] == 0.025


def test_training_needs_rows(spark):
    df = toy(spark, 20)
    with pytest.raises(ValueError, match="rows"):
        N.train_network(df, df.limit(0), [4])
    with pytest.raises(ValueError, match="rows"):
        H.train_squared_hinge(df.limit(0))
    odd = spark.createDataFrame([(1, None, 1), (2, [1.0], 0)], SCHEMA)
    net = N.train_network(df, df, [4], epochs=1)
    assert [r["prediction"] for r in N.score_network(net, odd).collect()] == [None, None]


def test_squared_hinge_is_optimal(spark):
    """Stationary to 1e-4, by matrix and by conjugate gradients alike, and not above LinearSVC's solution."""
    df = toy(spark, 600, noise=0.1).filter("id % 3 > 0 OR label = 1")
    a, b = H.train_squared_hinge(df), H.train_squared_hinge(df.repartition(7), gram=1)
    assert a.gradient < 1e-4 and b.gradient < 1e-4 and np.allclose(a.v, b.v, atol=1e-5)
    w = {r["label"]: r["weight"] for r in TR.class_weights(df).collect()}
    made = B.gathered(df, 64, weight=F.when(F.col("label") == 1, w[1]).otherwise(w[0]))
    eps = 1e-5
    for i in range(len(a.v)):  # no direction leads down
        e = np.zeros_like(a.v)
        e[i] = eps
        up, down = H.objective(made, np.stack([a.v + e, a.v - e]), a.mean, a.sd, a.C)
        assert abs(up - down) / (2 * eps) < 1e-3
    svc = TR.train_svm(df).stages[-1]
    other = np.append(svc.coefficients.toArray(), svc.intercept)
    assert a.objective <= H.objective(made, other[None, :], a.mean, a.sd, a.C)[0]
    made.unpersist()
    scored = H.score_linear(a, df.union(spark.createDataFrame([(9999, None, 1)], SCHEMA))).collect()
    assert [r["prediction"] for r in scored if r["id"] == 9999] == [None]
    assert np.mean([r["label"] == r["prediction"] for r in scored]) > 0.8


def test_squared_hinge_without_balance(spark):
    df = toy(spark, 200, noise=0.2)
    model = H.train_squared_hinge(df, C=0.1, balanced=False)
    assert model.gradient < 1e-4 and model.architecture["input_dim"] == 6


def test_groups_sum_like_their_blocks():
    """One gradient over mini-batches below one another is the sum of theirs, dropout and statistics included."""
    rng = np.random.default_rng(4)
    sizes, ns = [6, 9, 7, 5], [8, 9, 1, 8]
    theta = N.initial(sizes, 2)
    x, y, ends = rng.normal(size=(26, 6)), rng.integers(0, 2, 26).astype(float), np.cumsum(ns).tolist()
    for dropout in (0.0, 0.3):
        grad, stats, loss, right = N.gradients(theta, sizes, dropout, x, y, ends, [np.random.default_rng(b) for b in range(4)])
        alone = [N.backward(theta, sizes, dropout, x[j - n:j], y[j - n:j], np.random.default_rng(b)) for b, (n, j) in enumerate(zip(ns, ends))]
        assert np.allclose(grad, sum(a[0] for a in alone), atol=1e-12)
        assert all(np.allclose(s, sum(a[1][i] for a in alone), atol=1e-12) for i, s in enumerate(stats))
        assert loss == pytest.approx(sum(a[2] for a in alone)) and right == sum(a[3] for a in alone)


def test_blocks_hold_features_as_bytes(spark):
    """Features cross to the workers as the numbers' own bytes, over any batch size; groups give every block once."""
    df = toy(spark, 300).withColumn("embedding", F.transform("embedding", lambda v: F.round(v, 3)))
    kinds = {"float": "float32", "double": "float64"}
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for records in ("7", batch):  # blocks that go on in the next batch
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            for sql, kind in kinds.items():
                made = B.gathered(df.withColumn("embedding", F.col("embedding").cast(f"array<{sql}>")), 16)
                rows = made.frame.collect()
                assert made.kind == kind and {len(r["x"]) for r in rows} == {len(r["y"]) * 6 * np.dtype(kind).itemsize for r in rows}
                got = sorted((*x, y) for r in rows for x, y in zip(np.frombuffer(r["x"], kind).reshape(-1, 6).tolist(), r["y"]))
                assert np.allclose(got, sorted((*r["embedding"], r["label"]) for r in df.collect()))
                found = B.summed_groups(made, lambda group: [np.array([len(group), sum(len(b[2]) for b in group), 1.0])], rows=64)
                assert found[0] == made.count and found[1] == 300 and found[2] < made.count
                made.unpersist()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
