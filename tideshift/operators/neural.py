"""A small neural regressor trained by summed gradients.

Each step is one pass over the data: every task adds up the gradient of its rows, the arrays are summed,
and the driver updates the few thousand weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.session import settle

# Layer sizes and the optimiser's settings.
HIDDEN = (64, 32)
LEARNING_RATE = 1e-3
MOMENTS = (0.9, 0.999)
STABILITY = 1e-8
SEED = 42
PIECE_ROWS = 2048  # rows whose activations stay in a core's cache


def _shapes(inputs: int, hidden: Sequence[int]) -> list[tuple[int, int]]:
    sizes = [inputs, *hidden, 1]
    return list(zip(sizes, sizes[1:]))


def _split(weights: np.ndarray, shapes: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for i, o in shapes:
        layers.append((weights[at : at + i * o].reshape(i, o), weights[at + i * o : at + i * o + o]))
        at += i * o + o
    return layers


def _activations(x: np.ndarray, layers) -> list[np.ndarray]:
    out = [x]
    for depth, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(z if depth == len(layers) - 1 else np.maximum(z, 0.0))
    return out


@dataclass(frozen=True)
class NeuralRegressor:
    """Fitted network; inputs and target are standardised with the stored moments."""

    columns: tuple[str, ...]
    weights: np.ndarray
    hidden: tuple[int, ...]
    centre: np.ndarray
    scale: np.ndarray
    losses: tuple[float, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; one vectorised call per Arrow batch."""
        shapes = _shapes(len(self.columns), self.hidden)
        weights, centre, scale = self.weights, self.centre, self.scale

        @F.pandas_udf(T.DoubleType())
        def predict(*columns: pd.Series) -> pd.Series:
            layers = _split(weights, shapes)
            pieces = ((x - centre[:-1]) / scale[:-1] for x in _pieces(np.column_stack(columns)))
            out = [_activations(x, layers)[-1][:, 0] for x in pieces]
            return pd.Series(np.concatenate([*out, np.zeros(0)]) * scale[-1] + centre[-1])

        return df.withColumn("prediction", predict(*[F.col(c).cast("double") for c in self.columns]))


def fit_neural(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    epochs: int = 50,
    hidden: Sequence[int] = HIDDEN,
    learning_rate: float = LEARNING_RATE,
    seed: int = SEED,
    stored: bool = False,
) -> NeuralRegressor:
    """Full-batch training of a rectified network with squared loss and adaptive moments.

    The needed columns are stored once, as every epoch reads them; ``stored`` says that they already are.
    """
    names = [*columns, target]
    rows = df.dropna("any", subset=names).select(*[F.col(c).cast("double").alias(c) for c in names])
    rows = rows if stored else settle(rows)
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{k}_{i}") for i, c in enumerate(names) for k, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).collect()[0]
    centre = np.array([stats[f"m_{i}"] or 0.0 for i in range(len(names))])
    scale = np.array([stats[f"s_{i}"] or 1.0 for i in range(len(names))])
    shapes = _shapes(len(columns), hidden)
    rng = np.random.default_rng(seed)
    parts = []
    for i, o in shapes:
        bound = np.sqrt(6.0 / (i + o))
        parts += [rng.uniform(-bound, bound, i * o), rng.uniform(-bound, bound, o)]
    weights = np.concatenate(parts)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    losses = []
    for step in range(1, epochs + 1):
        total = _summed_gradient(rows, weights, shapes, centre, scale) / max(stats["n"], 1)
        losses.append(float(total[0]))
        gradient = total[1:]
        first = MOMENTS[0] * first + (1 - MOMENTS[0]) * gradient
        second = MOMENTS[1] * second + (1 - MOMENTS[1]) * gradient**2
        rate = learning_rate * np.sqrt(1 - MOMENTS[1] ** step) / (1 - MOMENTS[0] ** step)
        weights = weights - rate * first / (np.sqrt(second) + STABILITY)
    return NeuralRegressor(tuple(columns), weights, tuple(hidden), centre, scale, tuple(losses))


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(data), PIECE_ROWS):
        yield data[at : at + PIECE_ROWS]


def _summed_gradient(rows: DataFrame, weights, shapes, centre, scale) -> np.ndarray:
    """Loss and gradient summed over all rows."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layers, total = _split(weights, shapes), np.zeros(len(weights) + 1)
        for frame in frames:
            for data in _pieces(frame.to_numpy()):
                data = (data - centre) / scale
                seen = _activations(data[:, :-1], layers)
                error = seen[-1] - data[:, -1:]
                total[0] += float((error**2).sum()) / 2
                gradients, back = [], error
                for depth in range(len(layers) - 1, -1, -1):
                    gradients.append(np.concatenate([(seen[depth].T @ back).ravel(), back.sum(0)]))
                    if depth:
                        back = (back @ layers[depth][0].T) * (seen[depth] > 0)
                total[1:] += np.concatenate(gradients[::-1])
        yield pd.DataFrame({"part": [total]})

    parts = rows.mapInPandas(partial, "part array<double>")
    summed = parts.select(F.posexplode("part").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    return np.array([r["v"] for r in summed.orderBy("i").collect()])
