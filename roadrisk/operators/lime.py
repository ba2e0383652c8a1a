"""Local surrogates on quartile bins: which features of one row move the model's probability around it.

Every feature is cut at the quartiles of the training rows. A perturbed row draws a bin for each feature by
its training share and a value from the bin's normal distribution, truncated to the bin; its binary form
says for each feature whether the bin is the explained row's own. Perturbations weigh less the more bins
differ. A weighted ridge regression on the binary form selects ``top`` features by coefficient, a second
one on these alone gives the weights that are reported.

The quartiles are exact and, like the statistics of the bins, aggregates of the training rows (four rows for each
feature reach the driver). Draws are made in tasks from a generator seeded by (seed, row, chunk), so a task that
runs again draws the same; all draws of all rows are scored in one pass; a regression reads one row's draws, whose
number is a parameter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import send_package
from .dbscan import _checkpoint
from .profile import frequencies, quantiles_of, unpivoted

CHUNK = 1000


@dataclass(frozen=True)
class Quartiles:
    """For each feature the distinct quartiles, and for each bin its share of rows, mean, deviation and bounds."""

    cuts: tuple[np.ndarray, ...]
    share: tuple[np.ndarray, ...]
    mean: tuple[np.ndarray, ...]
    deviation: tuple[np.ndarray, ...]
    low: tuple[np.ndarray, ...]
    high: tuple[np.ndarray, ...]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(self.cuts)])


def fit_quartiles(train: DataFrame, features: list[str]) -> Quartiles:
    names = ["q1", "q2", "q3"]
    counted = _checkpoint(frequencies(unpivoted(train, features)))  # one pass over the rows; all below reads the counts
    q = _checkpoint(quantiles_of(counted, [0.25, 0.5, 0.75], names))
    bin_ = F.size(F.filter(F.array_distinct(F.array(*names)), lambda c: c < F.col("v")))  # how many quartiles lie below
    placed = _checkpoint(counted.join(F.broadcast(q), "column").select("column", "v", "n", bin_.alias("bin")))
    mean = F.when(F.min("v") == F.max("v"), F.min("v")).otherwise(F.sum(F.col("v") * F.col("n")) / F.sum("n"))  # one value: exactly that
    means = placed.groupBy("column", "bin").agg(mean.alias("mean"))  # a row for each bin
    off = F.col("v") - F.col("mean")
    stats = placed.join(F.broadcast(means), ["column", "bin"]).groupBy("column", "bin").agg(
        F.sum("n").alias("n"), F.first("mean").alias("mean"), F.sqrt(F.sum(off * off * F.col("n")) / F.sum("n")).alias("sd"), F.min("v").alias("low"), F.max("v").alias("high"))
    cuts = {r["column"]: np.unique([r[n] for n in names]) for r in q.collect()}
    held = {(r["column"], r["bin"]): r for r in stats.collect()}
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    for c in features:
        edges = cuts.get(c, np.empty(0))
        rows = [held.get((c, b)) for b in range(len(edges) + 1)]
        n = np.asarray([r["n"] if r else 0 for r in rows], np.float64)
        value = lambda name, other: np.asarray([r[name] if r else other for r in rows], np.float64)
        low = np.concatenate(([min((r["low"] for r in rows if r), default=0.0)], edges))
        high = np.concatenate((edges, [max((r["high"] for r in rows if r), default=0.0)]))
        for o, v in zip(out, (edges, n / n.sum() if n.sum() else np.ones(len(n)) / len(n), value("mean", 0.0), value("sd", 0.0), low, high)):
            o.append(v)
    return Quartiles(*map(tuple, out))


def drawn(quartiles: Quartiles, bins: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A value for each drawn bin: normal around the bin's mean, drawn again while outside the bin."""
    x = np.empty(bins.shape)
    for j in range(bins.shape[1]):
        b = bins[:, j]
        mean, sd, low, high = (v[j][b] for v in (quartiles.mean, quartiles.deviation, quartiles.low, quartiles.high))
        v = mean.copy()
        todo = np.flatnonzero((sd > 0) & (low < high))
        while len(todo):
            v[todo] = rng.normal(mean[todo], sd[todo])
            todo = todo[(v[todo] < low[todo]) | (v[todo] > high[todo])]
        x[:, j] = v
    return x


def perturbed(rows: DataFrame, quartiles: Quartiles, features: list[str], key: str, n: int, seed: int) -> DataFrame:
    """(key, same, features): ``n`` rows for each explained row, the row itself first; ``same`` tells the bins that it shares."""
    send_package(rows.sparkSession)
    schema = pa.schema([(key, pa.int64()), ("same", pa.list_(pa.float64())), *[(c, pa.float64()) for c in features]])

    def task(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in features]).astype(np.float64)
            own = quartiles.bins(x)
            for i, (k, chunk) in enumerate(zip(b.column(key).to_pylist(), b.column("chunk").to_pylist())):
                size = min(CHUNK, n - chunk * CHUNK)
                rng = np.random.default_rng((seed, abs(k), int(k < 0), chunk))
                bins = np.column_stack([rng.choice(len(s), size, p=s) for s in quartiles.share])
                values = drawn(quartiles, bins, rng)
                if chunk == 0:
                    bins[0], values[0] = own[i], x[i]
                same = (bins == own[i]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, k)), pa.array(same.tolist(), pa.list_(pa.float64())), *[pa.array(np.ascontiguousarray(values[:, j])) for j in range(len(features))]], schema=schema)

    chunks = rows.select(F.col(key).cast("long").alias(key), *[F.col(c).cast("double").alias(c) for c in features])
    chunks = chunks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // CHUNK))))
    return chunks.repartition(key, "chunk").mapInArrow(task, f"{key} long, same array<double>, " + ", ".join(f"{c} double" for c in features))


def ridge(z: np.ndarray, y: np.ndarray, w: np.ndarray, alpha: float) -> np.ndarray:
    """Coefficients of the weighted ridge regression with a free intercept."""
    zc, yc = z - np.average(z, axis=0, weights=w), y - np.average(y, weights=w)
    return np.linalg.solve((zc * w[:, None]).T @ zc + alpha * np.eye(z.shape[1]), (zc * w[:, None]).T @ yc)


def surrogate(same: np.ndarray, score: np.ndarray, top: int, width: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The selected features and their weights, largest first; ties by the features' order."""
    width = 0.75 * np.sqrt(same.shape[1]) if width is None else width
    w = np.sqrt(np.exp(-(1 - same).sum(axis=1) / width**2))
    chosen = np.sort(np.argsort(-np.abs(ridge(same, score, w, 0.01)), kind="stable")[:top])
    weight = ridge(same[:, chosen], score, w, 1.0)
    order = np.argsort(-np.abs(weight), kind="stable")
    return chosen[order], weight[order]


def lime_local(score: Callable[[DataFrame], Column], rows: DataFrame, train: DataFrame, features: list[str], key: str, n_samples: int = 5000, top: int = 10, seed: int = 42,
               quartiles: Quartiles | None = None) -> DataFrame:
    """(key, feature, weight, rank) for every row of ``rows`` (few rows of complete features).

    ``score`` gives the explained probability as a column of a DataFrame with the feature columns.
    """
    held = quartiles or fit_quartiles(train, features)
    draws = perturbed(rows, held, features, key, n_samples, seed)
    scored = draws.select(F.col(key).alias("key"), "same", score(draws).alias("score"))
    schema = pa.schema([("key", pa.int64()), ("feature", pa.string()), ("weight", pa.float64()), ("rank", pa.int64())])

    def fit(table):
        same = table.column("same").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        chosen, weight = surrogate(same, table.column("score").to_numpy(), top)
        n = len(chosen)
        return pa.Table.from_arrays([pa.array([table.column("key")[0].as_py()] * n, pa.int64()), pa.array([features[j] for j in chosen]), pa.array(weight), pa.array(np.arange(1, n + 1))], schema=schema)

    return scored.groupBy("key").applyInArrow(fit, "key long, feature string, weight double, rank long").withColumnRenamed("key", key)
