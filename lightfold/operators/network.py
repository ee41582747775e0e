"""A small convolutional network over pictures of spectra, in numpy: fitted on the driver on a bounded sample, applied in parallel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .learning import Classifier, UntrainedClassifierError

Weights = list[np.ndarray]
LEAK, DECAY, DROP, CLIP = 0.1, 2.5e-3, 0.5, 1.0


def _convolved(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pictures (n, rows, columns, channels) by kernels (k, k, channels, filters), of the same size, and the patches."""
    k, p = w.shape[0], w.shape[0] // 2
    padded = np.pad(x, ((0, 0), (p, p), (p, p), (0, 0)))
    patches = np.lib.stride_tricks.sliding_window_view(padded, (k, k), axis=(1, 2)).transpose(0, 1, 2, 4, 5, 3).reshape(-1, k * k * x.shape[3])
    return (patches @ w.reshape(-1, w.shape[3])).reshape(*x.shape[:3], -1), patches


def _pooled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The greatest of each two by two pixels, and where it is; an odd row or column at the end is left out."""
    n, a, b, c = x.shape
    cut = x[:, : a // 2 * 2, : b // 2 * 2].reshape(n, a // 2, 2, b // 2, 2, c)
    out = cut.max((2, 4))
    return out, cut == out[:, :, None, :, None]


def _unpooled(d: np.ndarray, where: np.ndarray, shape: tuple) -> np.ndarray:
    out = np.zeros(shape, d.dtype)
    n, a, b, c = d.shape
    out[:, : a * 2, : b * 2] = (where * d[:, :, None, :, None]).reshape(n, a * 2, b * 2, c)
    return out


def forward(weights: Weights, x: np.ndarray, rng: np.random.Generator | None = None) -> tuple[np.ndarray, list]:
    """Probabilities of pictures (n, rows, columns, 1), and what the way back needs; with ``rng`` half of the pixels and of the last features are dropped."""
    kept: list = []
    blocks = (len(weights) - 4) // 2
    if rng is not None:
        x = x * (rng.random(x.shape) >= DROP) / (1 - DROP)
    for k in range(blocks):
        z, patches = _convolved(x, weights[2 * k])
        z += weights[2 * k + 1]
        y, where = _pooled(np.where(z > 0, z, LEAK * z))
        kept.append((patches, z, where))
        x = y
    flat = x.reshape(len(x), -1)
    mask = (rng.random(flat.shape) >= DROP) / (1 - DROP) if rng is not None else 1.0
    flat = flat * mask
    w, b, v, c = weights[-4:]
    h = np.maximum(flat @ w + b, 0)
    z = h @ v + c
    e = np.exp(z - z.max(1, keepdims=True))
    kept.append((flat, mask, x.shape, h))
    return e / e.sum(1, keepdims=True), kept


def backward(weights: Weights, kept: list, wrong: np.ndarray) -> Weights:
    """Gradients from the fall of the loss by the last layer's input."""
    flat, mask, shape, h = kept[-1]
    w, _, v, _ = weights[-4:]
    dh = (wrong @ v.T) * (h > 0)
    out = [flat.T @ dh + 2 * DECAY * w, dh.sum(0), h.T @ wrong, wrong.sum(0)]
    d = ((dh @ w.T) * mask).reshape(shape)
    for k in range(len(kept) - 2, -1, -1):
        patches, z, where = kept[k]
        d = _unpooled(d, where, z.shape) * np.where(z > 0, 1, LEAK)
        kernel = weights[2 * k]
        rows = d.reshape(-1, d.shape[3])
        out = [(patches.T @ rows).reshape(kernel.shape) + 2 * DECAY * kernel, rows.sum(0), *out]
        if k:
            d = _convolved(d, kernel[::-1, ::-1].transpose(0, 1, 3, 2))[0]
    return out


def started(side: int, filters: tuple[int, ...], hidden: int, classes: int, rng: np.random.Generator) -> Weights:
    def even(*shape: int) -> np.ndarray:
        field = int(np.prod(shape[:-2])) if len(shape) > 2 else 1
        most = np.sqrt(6 / (field * (shape[-2] + shape[-1])))
        return rng.uniform(-most, most, shape).astype(np.float32)

    out: Weights = []
    before = 1
    for k, n in enumerate(filters):
        size = max(3, 7 - 2 * k)
        out += [even(size, size, before, n), np.zeros(n, np.float32)]
        before, side = n, side // 2
    return [*out, even(side * side * before, hidden), np.zeros(hidden, np.float32), even(hidden, classes), np.zeros(classes, np.float32)]


def fitted(x: np.ndarray, y: np.ndarray, classes: int, filters: tuple[int, ...], hidden: int, epochs: int, rate: float, seed: int, batch: int = 32, share: float = 0.2) -> Weights:
    """Adam with gradients of a norm of at most 1; a ``share`` is held out: its loss halves the rate after 5 epochs without gain and
    ends the run after 10, and the weights of its best epoch are kept."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held = order[: int(len(x) * share)]
    train = order[len(held) :]
    weights = started(x.shape[1], filters, hidden, classes, rng)
    m, v, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    best, best_loss, since = [w.copy() for w in weights], np.inf, 0
    for _ in range(epochs):
        rng.shuffle(train)
        for a in range(0, len(train), batch):
            rows = train[a : a + batch]
            p, kept = forward(weights, x[rows], rng)
            p[np.arange(len(rows)), y[rows]] -= 1
            grads = backward(weights, kept, (p / len(rows)).astype(np.float32))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            for k, g in enumerate(grads):
                g = g * min(1.0, CLIP / max(norm, 1e-12))
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                weights[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
        rows = held if len(held) else train
        loss = -float(np.mean(np.log(np.maximum(np.concatenate([forward(weights, x[rows[a : a + batch]])[0][np.arange(len(rows[a : a + batch])), y[rows[a : a + batch]]] for a in range(0, len(rows), batch)]), 1e-12))))
        if loss < best_loss - 1e-6:
            best, best_loss, since = [w.copy() for w in weights], loss, 0
        else:
            since += 1
            if since % 5 == 0:
                rate /= 2
            if since >= 10:
                break
    return best


class ImageNetwork(Classifier):
    """Blocks of convolution and pooling, a dense layer and a softmax over a picture of ``side`` by ``side`` pixels in an array column.

    It is fitted on the driver on the ``sample`` pictures of the least hashes. Predictions are the mean of ``repeats`` runs, with ``dropped`` those
    of networks that drop features at random, else all the same.
    """

    settings = ("vector", "side", "filters", "hidden", "epochs", "rate", "repeats", "dropped", "sample", "seed", "missing")

    def __init__(self, vector: str, side: int, classes: list[str], filters: tuple[int, ...] = (4, 8, 16), hidden: int = 128, epochs: int = 50, rate: float = 1e-3, repeats: int = 10, dropped: bool = False, sample: int = 5000, seed: int = 2187):
        super().__init__([], classes, seed)
        self.vector, self.side, self.filters, self.hidden, self.epochs, self.rate, self.repeats, self.dropped, self.sample = vector, side, tuple(filters), hidden, epochs, rate, repeats, dropped, sample

    def fit(self, df: DataFrame, label: str = "label") -> ImageNetwork:
        if self.model is None:
            picture = F.col(self.vector).cast("array<float>")
            rows = df.select(picture.alias("v"), F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("v", "y"), "y").limit(self.sample).collect()  # bounded
            x = np.array([r["v"] for r in rows], np.float32).reshape(-1, self.side, self.side, 1)
            self.model = fitted(x, np.array([r["y"] for r in rows], int), len(self.classes), self.filters, self.hidden, self.epochs, self.rate, self.seed)
        return self

    def predict(self, df: DataFrame, key: str) -> DataFrame:
        if self.model is None:
            raise UntrainedClassifierError(type(self).__name__)
        weights, side, repeats, seed = self.model, self.side, self.repeats if self.dropped else 1, self.seed
        dropped = self.dropped

        @F.pandas_udf("array<double>")
        def told(pictures: pd.Series) -> pd.Series:
            out = []
            for a in range(0, len(pictures), 32):
                x = np.stack([np.asarray(p, np.float32) for p in pictures.iloc[a : a + 32]]).reshape(-1, side, side, 1)
                rng = np.random.default_rng(seed) if dropped else None
                out += list(np.mean([forward(weights, x, rng)[0] for _ in range(repeats)], axis=0).astype(float))
            return pd.Series(out, dtype=object)

        known = df.where(F.col(self.vector).isNotNull()).select(key, told(F.col(self.vector).cast("array<float>")).alias("p"))
        pairs = F.explode(F.arrays_zip(F.array(*map(F.lit, self.classes)).alias("class"), F.col("p").alias("prob"))).alias("r")
        return known.select(key, pairs).select(key, F.col("r.class").alias("class"), F.col("r.prob").alias("prob"))

    def unknown(self) -> Column:
        return F.col(self.vector).isNull()

    def write(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        rows = [(k, list(w.shape), w.ravel().astype(float).tolist()) for k, w in enumerate(self.model)]
        spark.createDataFrame(rows, "place int, shape array<int>, numbers array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    def restore(self, path: str) -> None:
        rows = SparkSession.getActiveSession().read.parquet(path).orderBy("place").collect()  # one row for each layer
        self.model = [np.array(r["numbers"], np.float32).reshape(r["shape"]) for r in rows]
