"""The multilayer perceptron as specified (E11, E12): per hidden layer
linear, batch normalisation, ReLU and dropout, then one sigmoid unit; binary
cross-entropy, Adam, learning rate halved on a plateau, early stop, and the
parameters of the best epoch.

Training is synchronous and data-parallel.  A mini-batch of ``batch_size``
rows is a block (``blocks.gathered``), so a task sees it whole: batch
normalisation uses the statistics of its own mini-batch, the running ones
are averaged over all mini-batches of a step, wherever they lie.  An epoch
has at most ``steps`` steps; each sums the gradients of its mini-batches
(one, if there are few) and makes one Adam update, so the number of Spark
jobs an epoch does not grow with the data.  With k mini-batches a step the
learning rate is multiplied by sqrt(k), at most ``LR_GAIN``.  Which
mini-batches make a step is a hash of seed, epoch and block.

A validation pass after each epoch drives the plateau rule, the early stop
and the choice of the best epoch; its rows are the training history.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Blocks, gathered, moments, summed_groups

# Batch normalisation, Adam and plateau settings, last dropout factor.
EPS, MOMENTUM = 1e-5, 0.1
BETA1, BETA2, ADAM_EPS = 0.9, 0.999, 1e-8
PLATEAU_PATIENCE, PLATEAU_FACTOR, PLATEAU_THRESHOLD = 5, 0.5, 1e-4
LAST_DROPOUT = 0.7
LR_GAIN = 4.0
HISTORY = "epoch int, train_loss double, val_loss double, train_acc double, val_acc double, lr double, is_best boolean"


@dataclass
class Network:
    """Sizes, parameters in one vector, running statistics per hidden layer,
    and the moments that standardise the features."""
    sizes: list[int]  # input, hidden ...
    dropout: float
    theta: np.ndarray
    running: list[np.ndarray]  # mean, variance of each hidden layer in turn
    mean: np.ndarray
    sd: np.ndarray
    history: list[tuple] = field(default_factory=list)

    @property
    def architecture(self) -> dict:
        return {"model_type": "mlp", "input_dim": self.sizes[0], "hidden_dims": self.sizes[1:], "dropout": self.dropout,
                "parameters": len(self.theta)}


def shapes(sizes: list[int]) -> list[tuple[int, ...]]:
    """Weights, bias, scale and shift of each hidden layer; output weights, bias."""
    out: list[tuple[int, ...]] = []
    for a, b in zip(sizes, sizes[1:]):
        out += [(a, b), (b,), (b,), (b,)]
    return [*out, (sizes[-1],), (1,)]


def split(theta: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes(sizes):
        n = math.prod(shape)
        out.append(theta[at:at + n].reshape(shape))
        at += n
    return out


def initial(sizes: list[int], seed: int) -> np.ndarray:
    """Uniform in +-1 / sqrt(inputs) for weights and biases; scale 1, shift 0."""
    rng, out = np.random.default_rng(seed), []
    for a, b in zip(sizes, sizes[1:]):
        k = 1 / math.sqrt(a)
        out += [rng.uniform(-k, k, a * b), rng.uniform(-k, k, b), np.ones(b), np.zeros(b)]
    k = 1 / math.sqrt(sizes[-1])
    return np.concatenate([*out, rng.uniform(-k, k, sizes[-1]), rng.uniform(-k, k, 1)])


def rates(hidden: int, dropout: float) -> list[float]:
    return [dropout if i < hidden - 2 else dropout * LAST_DROPOUT for i in range(hidden)]


def sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1 / (1 + e), e / (1 + e))


def cross_entropy(z: np.ndarray, y: np.ndarray) -> float:
    """Mean over the rows, each logarithm -100 at least."""
    with np.errstate(divide="ignore"):
        p = sigmoid(z)
        return float(-np.mean(y * np.maximum(np.log(p), -100) + (1 - y) * np.maximum(np.log1p(-p), -100)))


def backward(theta: np.ndarray, sizes: list[int], dropout: float, x: np.ndarray, y: np.ndarray, rng=None):
    """One mini-batch in training mode: gradient, batch means and unbiased
    variances, loss, rows predicted right.  ``rng`` None: no dropout."""
    return gradients(theta, sizes, dropout, x, y, [len(y)], [rng])


def gradients(theta: np.ndarray, sizes: list[int], dropout: float, x: np.ndarray, y: np.ndarray, ends: list[int], rngs: list):
    """As ``backward``, summed over mini-batches that lie one below the other,
    ``ends`` the row after each: every mini-batch has its own statistics and
    dropout, the matrix products are made once for all rows."""
    p, kept, a, stats = split(theta, sizes), [], x, []
    hidden, cuts, n = len(sizes) - 1, list(zip([0, *ends], ends)), np.diff([0, *ends])
    for layer, rate in enumerate(rates(hidden, dropout)):
        w, b, scale, shift = p[4 * layer: 4 * layer + 4]
        unit = a @ w
        out, sds, means, variances = np.empty_like(unit), [], 0.0, 0.0
        for (i, j), rng in zip(cuts, rngs):
            z, to = unit[i:j], out[i:j]
            mean = z.mean(0)
            z -= mean
            var = np.einsum("ij,ij->j", z, z) / (j - i)
            sds.append(np.sqrt(var + EPS))
            z /= sds[-1]
            means, variances = means + mean + b, variances + var * ((j - i) / max(1, j - i - 1))
            np.multiply(z, scale, out=to)
            to += shift
            on = to > 0
            if rng is not None and rate > 0:
                on &= rng.random(to.shape) >= rate
                to *= 1 / (1 - rate)
            to *= on
            kept.append(on)
        stats += [means, variances]
        kept.append((a, unit, sds, rate))
        a = out
    z = a @ p[-2] + p[-1][0]
    grad = [np.empty(0)] * len(p)
    up = (sigmoid(z) - y) / np.repeat(n, n)
    grad[-2], grad[-1] = a.T @ up, np.array([up.sum()])
    up = np.outer(up, p[-2])
    for layer in reversed(range(hidden)):
        a, unit, sds, rate = kept.pop()
        w, _, scale, _ = p[4 * layer: 4 * layer + 4]
        scales, shifts = np.zeros(len(scale)), np.zeros(len(scale))
        for (i, j), sd, rng in reversed(list(zip(cuts, sds, rngs))):
            v, u = unit[i:j], up[i:j]
            u *= kept.pop()
            if rng is not None and rate > 0:
                u *= 1 / (1 - rate)
            along, whole = np.einsum("ij,ij->j", u, v), u.sum(0)
            scales += along
            shifts += whole
            u -= whole / (j - i)
            u -= v * (along / (j - i))
            u *= scale / sd
        grad[4 * layer: 4 * layer + 4] = a.T @ up, up.sum(0), scales, shifts
        if layer:
            up = up @ w.T
    loss = sum(cross_entropy(z[i:j], y[i:j]) for i, j in cuts)
    return np.concatenate([g.ravel() for g in grad]), stats, loss, int(((z > 0) == (y == 1)).sum())


def forward(theta: np.ndarray, sizes: list[int], running: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Logits in evaluation mode: running statistics, no dropout."""
    p, a = split(theta, sizes), x
    for layer in range(len(sizes) - 1):
        w, b, scale, shift = p[4 * layer: 4 * layer + 4]
        mean, var = running[2 * layer: 2 * layer + 2]
        a = a @ w
        a += b - mean
        a *= scale / np.sqrt(var + EPS)
        a += shift
        np.maximum(a, 0, out=a)
    return a @ p[-2] + p[-1][0]


def stacked(group: list, mean: np.ndarray, sd: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The standardised features and the labels of blocks, one below the
    other, and the row after each."""
    x, y = (np.concatenate([block[i] for block in group]) for i in (1, 2))
    x -= mean
    x /= sd
    return x, y, np.cumsum([len(block[2]) for block in group]).tolist()


def validate(blocks: Blocks, net: Network) -> tuple[float, float]:
    """Loss (mean over the mini-batches) and accuracy."""
    theta, sizes, running, mean, sd = net.theta, net.sizes, net.running, net.mean, net.sd

    def f(group):
        x, y, ends = stacked(group, mean, sd)
        z = forward(theta, sizes, running, x)
        loss = sum(cross_entropy(z[i:j], y[i:j]) for i, j in zip([0, *ends], ends))
        return [np.array([loss, len(ends), ((z > 0) == (y == 1)).sum(), len(y)], dtype=np.float64)]

    found = summed_groups(blocks, f)
    return (found[0] / found[1], found[2] / found[3]) if found is not None else (math.nan, math.nan)


def train_network(train: DataFrame, val: DataFrame, hidden: list[int], dropout: float = 0.3, learning_rate: float = 0.001,
                  batch_size: int = 32, epochs: int = 50, patience: int = 10, steps: int = 4, seed: int = 42,
                  vec_col: str = "embedding", label_col: str = "label", id_col: str = "id") -> Network:
    """The network of the epoch with the least validation loss, with its
    history.  Stops after ``patience`` epochs without a lower one."""
    blocks = gathered(train, batch_size, vec_col, label_col, id_col, seed=seed)
    held = gathered(val, batch_size, vec_col, label_col, id_col, seed=seed)
    try:
        if not blocks.n or not held.n or blocks.d != held.d:
            raise ValueError(f"training needs rows of one width in both parts: {blocks.n} x {blocks.d} and {held.n} x {held.d}")
        mean, sd = moments(blocks)
        sizes = [blocks.d, *hidden]
        net = Network(sizes, dropout, initial(sizes, seed), [v for h in hidden for v in (np.zeros(h), np.ones(h))], mean, sd)
        return _fit(net, blocks, held, learning_rate, epochs, patience, steps, seed)
    finally:
        blocks.unpersist()
        held.unpersist()


def _fit(net: Network, blocks: Blocks, held: Blocks, rate: float, epochs: int, patience: int, steps: int, seed: int) -> Network:
    steps = max(1, min(steps, blocks.count))
    first, second, t = np.zeros_like(net.theta), np.zeros_like(net.theta), 0
    best, best_loss, waited, plateau, bad = None, math.inf, 0, math.inf, 0
    sizes, dropout, mean, sd, n_theta = net.sizes, net.dropout, net.mean, net.sd, len(net.theta)
    for epoch in range(1, epochs + 1):
        step_of = F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), "block"), F.lit(steps))
        totals = np.zeros(4)  # loss, mini-batches, right, rows
        for step in range(steps):
            theta = net.theta

            def f(group):
                x, y, ends = stacked(group, mean, sd)
                rngs = [np.random.default_rng([seed, epoch, block[0]]) for block in group]
                grad, stats, loss, right = gradients(theta, sizes, dropout, x, y, ends, rngs)
                return [np.concatenate([grad, *stats, [loss, len(ends), right, len(y)]])]

            found = summed_groups(blocks, f, blocks.frame.filter(step_of == step))
            if found is None:  # no mini-batch fell into this step
                continue
            totals += found[-4:]
            k = found[-3]
            grad, at = found[:n_theta] / k, n_theta
            for i, old in enumerate(net.running):
                net.running[i] = (1 - MOMENTUM) ** k * old + (1 - (1 - MOMENTUM) ** k) * found[at:at + len(old)] / k
                at += len(old)
            t += 1
            first = BETA1 * first + (1 - BETA1) * grad
            second = BETA2 * second + (1 - BETA2) * grad * grad
            gain = min(LR_GAIN, math.sqrt(k))
            net.theta = theta - rate * gain * (first / (1 - BETA1 ** t)) / (np.sqrt(second / (1 - BETA2 ** t)) + ADAM_EPS)
        val_loss, val_acc = validate(held, net)
        used = rate
        if val_loss < plateau * (1 - PLATEAU_THRESHOLD):
            plateau, bad = val_loss, 0
        else:
            bad += 1
            if bad > PLATEAU_PATIENCE:
                rate, bad = rate * PLATEAU_FACTOR, 0
        better = val_loss < best_loss
        net.history.append((epoch, float(totals[0] / totals[1]), val_loss, float(totals[2] / totals[3]), val_acc, used, better))
        if better:
            best, best_loss, waited = (net.theta, list(net.running)), val_loss, 0
        else:
            waited += 1
            if waited >= patience:
                break
    if best is not None:
        net.theta, net.running = best
    return net


def history(net: Network, spark: SparkSession) -> DataFrame:
    """One row per epoch; ``is_best``: lowest validation loss so far (the
    last of these is the epoch whose parameters were kept)."""
    return spark.createDataFrame([tuple(map(lambda v: v.item() if isinstance(v, np.generic) else v, row)) for row in net.history],
                                 HISTORY)


def score_network(net: Network, df: DataFrame, name: str = "mlp", vec_col: str = "embedding", id_col: str = "id",
                  label_col: str = "label", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, model, label, prediction, probability, raw_margin)`` as
    ``training.score``, and the columns ``keep``; a null vector or one of another width scores null."""
    shared = df.sparkSession.sparkContext.broadcast((net.theta, net.sizes, net.running, net.mean, net.sd))

    @F.pandas_udf("double")
    def logit(x: pd.Series) -> pd.Series:
        theta, sizes, running, mean, sd = shared.value
        out = np.full(len(x), np.nan)
        fits = np.array([v is not None and len(v) == sizes[0] for v in x], dtype=bool)
        if fits.any():
            out[fits] = forward(theta, sizes, running, (np.stack(x[fits].to_numpy()).astype(np.float64) - mean) / sd)
        return pd.Series(out)

    scored = df.withColumn("__z", F.nullif(logit(F.col(vec_col).cast("array<double>")), F.lit(float("nan"))))
    return scored.select(F.col(id_col).alias("id"), F.lit(name).alias("model"), F.col(label_col).alias("label"),
                         (F.col("__z") > 0).cast("int").alias("prediction"),
                         (1 / (1 + F.exp(-F.col("__z")))).alias("probability"), F.col("__z").alias("raw_margin"), *keep)
