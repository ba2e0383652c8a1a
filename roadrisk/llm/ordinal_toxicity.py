"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

A text's features are its words (lower case, marks around them off) and the first ``PREFIX`` letters of
longer ones, each with log(1 + count). Grades 0 .. J share one weight vector w:

    P(grade >= j) = 1 / (1 + exp(theta_j - w x)),   theta_1 <= ... <= theta_J

and the expected severity is the sum of these probabilities.

Labels say toxic or not. The grade of a toxic text comes from the strength of its evidence: the number
of its occurrences of features that mark toxic texts (toxic texts have them ``MARKING`` times as
often as clean ones or more), 1 below ``cuts[0]``, 2 below ``cuts[1]``, and so on.

Fitting, in three steps:
1. Spark counts, for every feature, the clean and toxic ones of all labelled texts that have it.
2. Features are kept by the likelihood ratio of these counts, whichever side they speak for, at least
   ``evidence`` and at most ``max_features``, ties by the feature's number (histograms give the bound,
   whatever the number of words). Texts without one look alike and are fitted as one row.
3. Weights and thresholds are fitted on the kept features of the labelled texts, at most about
   ``max_rows`` of them (a documented bound; if there are more, they are taken by the hash of their ids).

Every text is scored.

Defined results: a null or empty text has no features; without toxic or without clean labels nothing
is toxic; a text with several labels counts as toxic if one says so; null labels are left out;
repeated rows each get a row; extra columns are left out; empty tables work.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches, stored

PREFIX = 5
MARKING = 9  # a ratio of shares, so that the sizes of the two classes don't matter
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—"


def word_features(word: str) -> tuple[str, ...]:
    bare = word.strip(MARKS)
    if not bare:
        return ()
    return (bare, bare[:PREFIX] + "*") if len(bare) > PREFIX else (bare,)


def code(feature: str) -> int:
    """A feature's number: 64 bits of its hash, signed."""
    return xxhash.xxh64_intdigest(feature.encode("utf-8", "replace")) - (1 << 63)


class Coder:
    """Words to feature numbers, with a table of at most about ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        self.known: dict[str, tuple[int, ...]] = {}
        self.limit = limit

    def present(self, text: str | None) -> set[int]:
        """Feature numbers of a text."""
        words = set((text or "").lower().split())
        if len(self.known) > self.limit:
            self.known.clear()
        for w in words.difference(self.known):
            self.known[w] = tuple(map(code, word_features(w)))
        return set(chain.from_iterable(map(self.known.__getitem__, words)))


class Finder:
    """Counts of the kept features; words without one are remembered apart."""

    def __init__(self, features: np.ndarray, limit: int = 300_000):
        self.place = {int(f): i for i, f in enumerate(features)}
        self.seen: set[str] = set()
        self.marked: dict[str, tuple[int, ...]] = {}
        self.limit = limit

    def counts(self, text: str | None) -> dict[int, int]:
        """Counts by the features' places."""
        words = Counter((text or "").lower().split())
        if len(self.seen) > self.limit:
            self.seen.clear()
            self.marked.clear()
        for w in words.keys() - self.seen:
            if places := tuple(self.place[f] for f in map(code, word_features(w)) if f in self.place):
                self.marked[w] = places
            self.seen.add(w)
        out: dict[int, int] = {}
        for w in words.keys() & self.marked.keys():
            for k in self.marked[w]:
                out[k] = out.get(k, 0) + words[w]
        return out


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, toxic of all labelled documents.

    The labels are written without what the fit doesn't need: while they are few they are broadcast and no
    text is shuffled for them; a table too large for that is joined by a shuffle.
    """
    told = stored(labels.where("toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")), "labels")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(told, "doc_id")


def feature_counts(rows: DataFrame, limit: int = 400_000) -> DataFrame:
    """(feature, clean, toxic): labelled texts that have each feature; tasks count first."""
    schema = pa.schema([("feature", pa.int64()), ("clean", pa.int64()), ("toxic", pa.int64())])

    def task(batches):
        coder = Coder()
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out():
            keys = list(seen[0].keys() | seen[1].keys())
            made = batch(schema, [keys, [seen[0][k] for k in keys], [seen[1][k] for k in keys]])
            seen[0].clear()
            seen[1].clear()
            return made

        for b in small_batches(batches):
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[toxic].update(coder.present(text))
            if len(seen[0]) + len(seen[1]) > limit:
                yield out()
        if seen[0] or seen[1]:
            yield out()

    return rows.select("text", "toxic").mapInArrow(task, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def pick_features(counts: DataFrame, n_clean: int, n_toxic: int, evidence: float, max_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the kept features, and whether each marks toxic texts."""
    share = n_toxic / (n_clean + n_toxic)
    n = F.col("clean") + F.col("toxic")

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    rated = counts.withColumn("ratio", 2 * (part(F.col("toxic"), n * share) + part(F.col("clean"), n * (1 - share)))).where(F.col("ratio") >= evidence)
    rest = rated.select("feature", (F.col("toxic") * F.lit(n_clean) >= F.col("clean") * F.lit(MARKING * n_toxic)).alias("marks"), F.log("ratio").alias("_log"))
    kept, room = [], max_features
    # from the strongest down as long as there is room; of the bin that overflows, by finer bins, then by the number
    for rank in (-F.floor(F.col("_log") * 20), -F.floor(F.col("_log") * 20_000), F.shiftright("feature", 52)):
        bins = sorted((r["rank"], r["count"]) for r in rest.groupBy(rank.alias("rank")).count().collect())
        last = None
        for b, c in bins:
            if c > room:
                last = b
                break
            room -= c
        if last is None:
            kept.append(rest)
            rest = None
            break
        kept.append(rest.where(rank < last))
        rest = rest.where(rank == last)
    if rest is not None and room:
        kept.append(rest.orderBy("feature").limit(room))
    found = sorted((r["feature"], r["marks"]) for k in kept for r in k.select("feature", "marks").collect())
    return np.array([f for f, _ in found], np.int64), np.array([m for _, m in found], bool)


def kept_counts(rows: DataFrame, features: np.ndarray) -> DataFrame:
    """(toxic, pairs, n): n texts have the kept features and counts that ``pairs`` holds as 32-bit numbers.

    Equal texts, and the many without a kept feature, are one row.
    """
    held = rows.sparkSession.sparkContext.broadcast(features)
    schema = pa.schema([("toxic", pa.bool_()), ("pairs", pa.binary()), ("n", pa.int64())])

    def task(batches):
        finder = Finder(held.value)
        seen: Counter = Counter()
        for b in small_batches(batches):
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[toxic, np.array(sorted(finder.counts(text).items()), "<i4").tobytes()] += 1
        if seen:
            yield batch(schema, [[k[0] for k in seen], [k[1] for k in seen], list(seen.values())])

    return rows.select("text", "toxic").mapInArrow(task, "toxic boolean, pairs binary, n long").groupBy("toxic", "pairs").agg(F.sum("n").alias("n"))


def pair_view(pairs: pa.Array) -> np.ndarray:
    """The (place, count) rows of all ``pairs`` of an Arrow chunk, without a Python object for each."""
    if not len(pairs):
        return np.empty((0, 2), "<i4")
    wide = "<i8" if pa.types.is_large_binary(pairs.type) else "<i4"
    _, ends, data = pairs.buffers()
    at = np.frombuffer(ends, wide, len(pairs) + 1, pairs.offset * np.dtype(wide).itemsize)
    if data is None or at[0] == at[-1]:
        return np.empty((0, 2), "<i4")
    return np.frombuffer(data, "<i4", int(at[-1] - at[0]) // 4, int(at[0])).reshape(-1, 2)


class Ordinal:
    """Weights of the kept features and the ordered thresholds."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.features, self.weights, self.thresholds = features, weights, thresholds

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for each score and j = 1 .. J."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def fit_ordinal(starts: np.ndarray, features: np.ndarray, values: np.ndarray, grades: np.ndarray, weight: np.ndarray, n_features: int, n_grades: int, penalty: float = 0.01, steps: int = 2000, kept: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised negative log-likelihood, by L-BFGS over all rows until no part of the gradient is above a millionth a text.

    Row i has the features ``starts[i]`` to ``starts[i + 1]`` and stands for ``weight[i]`` texts. Thresholds are a first one and logarithms of the gaps, so they stay in order.
    """
    total = weight.sum()
    share = np.array([max(weight[grades >= j].sum() / total, 1e-6) for j in range(1, n_grades + 1)])
    theta = np.log((1 - share) / share)
    x = np.concatenate((np.zeros(n_features), theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))))
    parts = list(_row_parts(starts))

    def loss(x):
        w, free = x[:n_features], x[n_features:]
        theta = np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        value, d_w, d_theta = penalty / 2 * (w @ w), penalty * w, np.zeros(n_grades)
        for low, high in parts:  # a part's arrays stay small, whatever the number of rows
            at, to = starts[low], starts[high]
            g, f, v, k = grades[low:high], features[at:to], values[at:to], weight[low:high]
            score = _row_sums(starts[low : high + 1] - at, v * w[f])
            # F(t) = P(grade < j); a grade's probability is the difference of two of them
            upper, lower = _sigmoid(edges[g + 1] - score), _sigmoid(edges[g] - score)
            p = np.maximum(upper - lower, 1e-12)
            du, dl = k * upper * (1 - upper) / p, k * lower * (1 - lower) / p
            value -= (k * np.log(p)).sum()
            d_theta += np.bincount(g, dl, n_grades + 1)[1:] - np.bincount(g, du, n_grades + 1)[:-1]
            d_w = d_w + np.bincount(f, v * np.repeat(du - dl, np.diff(starts[low : high + 1])), n_features)
        tail = np.cumsum(d_theta[::-1])[::-1]
        return value, np.concatenate((d_w, tail[:1], tail[1:] * np.exp(free[1:])))

    # curvature at the start, by feature: frequent and rare features get steps of their own size
    scale = np.full(len(x), total * share[0] * (1 - share[0]) + penalty)
    scale[:n_features] = penalty
    for low, high in parts:
        at, to = starts[low], starts[high]
        k = np.repeat(weight[low:high] * share[0] * (1 - share[0]), np.diff(starts[low : high + 1]))
        scale[:n_features] += np.bincount(features[at:to], k * values[at:to].astype(float) ** 2, n_features)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    value, slope = loss(x)
    for _ in range(steps):
        if np.abs(slope).max() <= 1e-6 * total:
            break
        d, used = -slope, []
        for s, y in reversed(past):
            used.append((s @ d) / (s @ y))
            d = d - used[-1] * y
        d = d / scale * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ (past[-1][1] / scale)) if past else 1.0)
        for s, y in past:
            d = d + (used.pop() - (y @ d) / (s @ y)) * s
        down, step = slope @ d, 1.0
        while True:
            new = x + step * d
            new_value, new_slope = loss(new)
            if new_value <= value + 1e-4 * step * down or step < 1e-10:
                break
            step /= 2
        if not new_value < value:  # no lower in floating point
            break
        if (new - x) @ (new_slope - slope) > 0:
            past = [*past, (new - x, new_slope - slope)][-kept:]
        x, value, slope = new, new_value, new_slope
    free = x[n_features:]
    return x[:n_features], np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def _row_parts(starts: np.ndarray, size: int = 250_000):
    """Ranges of rows with about ``size`` features each."""
    low, n = 0, len(starts) - 1
    while low < n:
        high = min(n, low + size, max(low + 1, int(np.searchsorted(starts, starts[low] + size))))
        yield low, high
        low = high


def _row_sums(starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of each row's values, 0 for a row of none."""
    out, some = np.zeros(len(starts) - 1), np.diff(starts) > 0
    if some.any():
        out[some] = np.add.reduceat(values, starts[:-1][some])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cuts: tuple[int, ...] = (4, 10), evidence: float = 15.0, max_features: int = 50_000, max_rows: int = 200_000) -> Ordinal:
    """The model of the labelled documents."""
    rows = labelled(docs, labels, id_col, text_col)
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_grades = len(cuts) + 1
    nothing = Ordinal(np.empty(0, np.int64), np.empty(0), np.full(n_grades, 50.0))
    if not n.get(True) or not n.get(False):
        return nothing
    features, marks = pick_features(stored(feature_counts(rows), "features"), n[False], n[True], evidence, max_features)
    if (total := n[True] + n[False]) > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_rows / total))
    found = kept_counts(rows, features).toArrow()
    if not found.num_rows:
        return nothing
    chunks = found["pairs"].chunks
    lengths = np.concatenate([pc.binary_length(c).to_numpy(zero_copy_only=False) for c in chunks]) // 8
    pairs = np.concatenate([pair_view(c) for c in chunks])
    starts = np.concatenate(([0], np.cumsum(lengths)))
    flat, counts = pairs[:, 0].copy(), pairs[:, 1].astype(np.float32)
    toxic, weight = found["toxic"].to_numpy(), found["n"].to_numpy().astype(float)
    del found, chunks, pairs
    hits = _row_sums(starts, counts * marks[flat])
    grades = np.where(toxic, 1 + np.searchsorted(np.array(cuts), hits, side="right"), 0)
    weights, thresholds = fit_ordinal(starts, flat, np.log1p(counts), grades, weight, len(features), n_grades)
    return Ordinal(features, weights, thresholds)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("p_toxic", pa.float64()), ("severity", pa.float64()), ("grade", pa.int64()), ("toxic", pa.bool_())])


def score(docs: DataFrame, model: Ordinal, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features (kept ones it has), p_toxic, severity (expected grade), grade, toxic of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        m = held.value
        finder, weights = Finder(m.features), m.weights.tolist()
        for b in small_batches(batches):
            found = [finder.counts(t) for t in b.column(1).to_pylist()]
            sums = np.array([sum(weights[k] * math.log1p(c) for k, c in x.items()) for x in found], float)
            p = m.at_least(sums)
            grade = (p >= 0.5).sum(1)
            yield batch(SCHEMA, [b.column(0), [len(x) for x in found], p[:, 0], p.sum(1), grade, grade > 0])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, n_features long, p_toxic double, severity double, grade long, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Fits on the labelled documents and scores all of them."""
    return score(docs, fit(docs, labels, id_col=id_col, text_col=text_col, **options), id_col=id_col, text_col=text_col)
