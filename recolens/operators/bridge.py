"""The bridge: a learned projection from content vectors to latent factors.

Two ways to fit it, both data-parallel: Spark sums sufficient statistics or gradients over
the partitions, and only those fixed-size sums reach the driver. The fitted projection is
a short list of layers, stored as a table with one row per layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recolens.operators.skew import by_shuffle, cut

HIDDEN = (256, 64)
MAX_EPOCHS, PATIENCE, TOLERANCE = 300, 15, 1e-4
VALID_BUCKETS = 10  # one bucket in ten is held out
LEARNING_RATE = 5e-3
TRAIN_PARTITIONS = 128  # bounds the partial sums one reducer merges

LAYERS = T.StructType(
    [
        T.StructField("layer", T.IntegerType(), False),
        T.StructField("rows", T.IntegerType(), False),
        T.StructField("cols", T.IntegerType(), False),
        T.StructField("weights", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("bias", T.ArrayType(T.DoubleType(), False), False),
    ]
)


@dataclass
class Bridge:
    """Affine layers with ReLU between them; standardisation is part of the first."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            x = x @ w + b
            if i + 1 < len(self.weights):
                x = np.maximum(x, 0.0)
        return x


def save_bridge(spark: SparkSession, bridge: Bridge, path: str) -> None:
    rows = [
        (i, *w.shape, w.ravel().tolist(), b.tolist())
        for i, (w, b) in enumerate(zip(bridge.weights, bridge.biases))
    ]
    spark.createDataFrame(rows, LAYERS).coalesce(1).write.mode("overwrite").parquet(path)


def load_bridge(spark: SparkSession, path: str) -> Bridge:
    rows = spark.read.schema(LAYERS).parquet(path).orderBy("layer").collect()
    return Bridge(
        [np.asarray(r.weights).reshape(r.rows, r.cols) for r in rows],
        [np.asarray(r.bias) for r in rows],
    )


def bridge_training_set(
    als_items: DataFrame, embeddings: DataFrame, warm: DataFrame
) -> DataFrame:
    """Warm products with both vectors: (product_id, x, y)."""
    return (
        als_items.join(warm.select("product_id"), "product_id", "left_semi")
        .join(by_shuffle(embeddings), "product_id")
        .select(
            "product_id",
            F.col("embedding").cast("array<float>").alias("x"),
            F.col("p").cast("array<float>").alias("y"),
        )
    )


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _summed(train: DataFrame, partial) -> np.ndarray:
    """Sum ``partial(x, y, held_out)`` over all Arrow batches of all partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            v = partial(_matrix(batch.column("x")), _matrix(batch.column("y")), held)
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([total], pa.list_(pa.float64()))], names=["v"]
            )

    partials = train.select("x", "y", "held_out").mapInArrow(run, "v array<double>")
    row = partials.select(Summarizer.sum(array_to_vector("v")).alias("s")).first()
    return row.s.toArray()


def _with_held_out(train: DataFrame, seed: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(F.lit(seed), "product_id"), F.lit(VALID_BUCKETS))
    return train.select("x", "y", (bucket == 0).alias("held_out"))


def _moments(train: DataFrame) -> tuple[np.ndarray, int]:
    """Gram matrix of [1, x, y] and the width of x."""
    first = train.select(F.size("x").alias("dx"), F.size("y").alias("dy")).first()
    if first is None:
        raise ValueError("no product has both factors and content")
    width = 1 + first.dx + first.dy

    def gram(x: np.ndarray, y: np.ndarray, held) -> np.ndarray:
        z = np.hstack([np.ones((len(x), 1)), x, y])
        return (z.T @ z).ravel()

    return _summed(train, gram).reshape(width, width), first.dx


def _scaling(g: np.ndarray, dx: int) -> tuple[np.ndarray, np.ndarray]:
    n = g[0, 0]
    mean = g[0, 1 : 1 + dx] / n
    var = np.maximum(np.diag(g)[1 : 1 + dx] / n - mean**2, 0.0)
    sd = np.sqrt(var)
    return mean, np.where(sd > 1e-12, sd, 1.0)


def _fold(mean: np.ndarray, sd: np.ndarray, w: np.ndarray, b: np.ndarray):
    """Standardisation written into the first affine layer."""
    scaled = w / sd[:, None]
    return scaled, b - mean @ scaled


def ridge_fit(train: DataFrame, penalty: float = 1.0) -> Bridge:
    """Closed-form multi-output ridge on standardised content, from one pass of moments."""
    data = cut(train.select("x", "y", F.lit(False).alias("held_out"))).coalesce(TRAIN_PARTITIONS)
    g, dx = _moments(data)
    n = g[0, 0]
    mean, sd = _scaling(g, dx)
    y_mean = g[0, 1 + dx :] / n
    xx = (g[1 : 1 + dx, 1 : 1 + dx] - n * np.outer(mean, mean)) / np.outer(sd, sd)
    xy = (g[1 : 1 + dx, 1 + dx :] - n * np.outer(mean, y_mean)) / sd[:, None]
    w = np.linalg.solve(xx + penalty * np.eye(dx), xy)
    scaled, bias = _fold(mean, sd, w, y_mean)
    return Bridge([scaled], [bias])


def mlp_fit(
    train: DataFrame,
    hidden: tuple[int, ...] = HIDDEN,
    epochs: int = MAX_EPOCHS,
    patience: int = PATIENCE,
    seed: int = 42,
    learning_rate: float = LEARNING_RATE,
) -> Bridge:
    """Multi-layer perceptron by full-batch gradients summed over the cluster.

    Squared error, ReLU, Adam steps on the driver's fixed-size weights, early stopping on
    the held-out tenth. The training table is cut once; each epoch is one pass over it.
    """
    data = cut(_with_held_out(train, seed)).coalesce(TRAIN_PARTITIONS)
    g, dx = _moments(data)
    mean, sd = _scaling(g, dx)
    sizes = [dx, *hidden, g.shape[0] - 1 - dx]
    rng = np.random.default_rng(seed)
    params = [
        p
        for a, b in zip(sizes, sizes[1:])
        for p in (rng.uniform(-1, 1, (a, b)) * np.sqrt(6.0 / (a + b)), np.zeros(b))
    ]
    m1 = [np.zeros_like(p) for p in params]
    m2 = [np.zeros_like(p) for p in params]
    best, best_loss, stale = [p.copy() for p in params], np.inf, 0
    for epoch in range(1, epochs + 1):
        total = _summed(data, _gradient(params, mean, sd))
        n_train, n_valid, valid_loss = total[0], total[1], total[2]
        loss = valid_loss / max(n_valid, 1.0)
        stale = 0 if loss < best_loss * (1 - TOLERANCE) else stale + 1
        if loss < best_loss:
            best, best_loss = [p.copy() for p in params], loss
        if stale >= patience or n_train == 0:
            break
        at = 3
        for i, p in enumerate(params):
            grad = total[at : at + p.size].reshape(p.shape) / n_train
            at += p.size
            m1[i] = 0.9 * m1[i] + 0.1 * grad
            m2[i] = 0.999 * m2[i] + 0.001 * grad**2
            step = (m1[i] / (1 - 0.9**epoch)) / (np.sqrt(m2[i] / (1 - 0.999**epoch)) + 1e-8)
            params[i] = p - learning_rate * step
    first, bias = _fold(mean, sd, best[0], best[1])
    return Bridge([first, *best[2::2]], [bias, *best[3::2]])


def _gradient(params: list[np.ndarray], mean: np.ndarray, sd: np.ndarray):
    weights, biases = params[0::2], params[1::2]

    def partial(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> np.ndarray:
        acts = [(x - mean) / sd]
        for i, (w, b) in enumerate(zip(weights, biases)):
            z = acts[-1] @ w + b
            acts.append(np.maximum(z, 0.0) if i + 1 < len(weights) else z)
        error = acts[-1] - y
        valid_loss = float((error[held] ** 2).sum())
        delta = np.where(held[:, None], 0.0, error)
        grads: list[np.ndarray] = []
        for i in range(len(weights) - 1, -1, -1):
            grads[:0] = [acts[i].T @ delta, delta.sum(axis=0)]
            if i:
                delta = (delta @ weights[i].T) * (acts[i] > 0)
        head = np.array([float((~held).sum()), float(held.sum()), valid_loss])
        return np.concatenate([head, *[g.ravel() for g in grads]])

    return partial


def bridge_predict(embeddings: DataFrame, bridge: Bridge) -> DataFrame:
    """(product_id, p): the projection of each content vector, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = bridge(_matrix(batch.column("embedding"))).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("product_id"), pa.array(list(y), pa.list_(pa.float32()))],
                    names=["product_id", "p"],
                )

    return embeddings.select(
        "product_id", F.col("embedding").cast("array<float>").alias("embedding")
    ).mapInArrow(run, "product_id string, p array<float>")


def bridge_rmse(train: DataFrame, bridge: Bridge) -> DataFrame:
    """Root mean squared error over all outputs of the training set, in one row."""
    predicted = bridge_predict(
        train.select("product_id", F.col("x").alias("embedding")), bridge
    ).withColumnRenamed("p", "predicted")
    return rmse(train.join(by_shuffle(predicted), "product_id"), "y", "predicted")


def rmse(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    squares = F.aggregate(
        F.zip_with(
            F.col(actual).cast("array<double>"),
            F.col(predicted).cast("array<double>"),
            lambda a, b: (a - b) * (a - b),
        ),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    return df.agg(
        F.sqrt(F.sum(squares) / F.sum(F.size(actual))).alias("rmse"),
        F.count(F.lit(1)).alias("n"),
    )
