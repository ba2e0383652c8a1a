"""Centroid clustering of integer vectors, nearest centroids found by Orchard search.

For every centroid all others are listed by their distance from it. A search starts at one centroid
and walks its list; when a listed centroid is closer to the vector, the search jumps to that one's
list and starts it anew. Centroids whose distance was taken are marked and not measured twice. The
walk stops when the listed centroid lies *strictly* more than twice as far from the present one as
the vector does: by the triangle inequality no centroid from there on can be as close as the present
one, while one that ties is still met, so ties go to the smaller number exactly. All vectors of an
Arrow batch walk at once: one step of the loop moves each of them by one list entry.

Components are integers, so distances, sums and comparisons are exact (the test of the stop is made
on squares: D > 4 d). The vectors are quantised once, written to the shared folder, and each round
reads them: tasks return sums and counts for each centroid and batch, Spark adds them, and only the
k x dim sums reach the driver, whose size the parameters fix. A new round starts each vector's search
at the centroid that the batch's first vectors chose most, which changes its cost only.

Defined results: vectors of another length than ``dim``, and null vectors or vectors with null or
non-finite components are left out; so are vectors with a component beyond +-2^26 after
scaling (|x| >= 262,144 for the default scale), whose squared distances would not be sure to fit a long.
Fewer kept vectors than k are all centroids; none give no rows. Repeated vec_ids keep a row each; rows
that tie in the starting order (equal vec_id) follow their components; a null vec_id hashes as an
empty string behind the prefix. Inertias beyond a long are null. Centroids without vectors stay where they are. Extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, stored

BOUND = 1 << 26
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
_ROWS = 8192


def quantised(vectors: DataFrame, dim: int, scale: int, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * x) for the vectors that are kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).filter(F.size("x") == dim)
    whole = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (x * scale >= -BOUND) & (x * scale <= BOUND))
    return rows.filter(F.coalesce(whole, F.lit(False))).select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The k vectors with the smallest lower-case hex sha256 of prefix and vec_id, in the hashes' order."""
    key = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(key, "v").limit(k).select("v").collect()  # k rows by contract
    return np.asarray([r["v"] for r in rows], np.int64)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows that face each other."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


class Orchard:
    """Sorted neighbour lists of all centroids, and the search over them."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = np.ascontiguousarray(centroids, np.int64)
        k = len(self.centroids)
        self.apart = np.stack([squares(np.broadcast_to(c, self.centroids.shape), self.centroids) for c in self.centroids])
        # nearest first, equal ones by number; a centroid heads its own list unless an equal one has a smaller number
        self.near = np.lexsort((np.broadcast_to(np.arange(k), (k, k)), self.apart), axis=1)
        self.measured = 0  # distances taken, for tests of the pruning

    def nearest(self, vectors: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to each vector's nearest centroid; the smaller number of those that tie."""
        n, k = len(vectors), len(self.centroids)
        now = np.full(n, start, np.int64)
        d = squares(vectors, self.centroids[now])
        self.measured += n
        seen = np.zeros((n, k), bool)
        seen[:, start] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n)
        while len(walking):
            at = now[walking]
            other = self.near[at, place[walking]]
            go_on = self.apart[at, other] <= 4 * d[walking]
            walking, other = walking[go_on], other[go_on]
            place[walking] += 1
            new = ~seen[walking, other]
            who, which = walking[new], other[new]
            if len(who):
                seen[who, which] = True
                found = squares(vectors[who], self.centroids[which])
                self.measured += len(who)
                closer = (found < d[who]) | ((found == d[who]) & (which < now[who]))
                jump, to = who[closer], which[closer]
                now[jump], d[jump], place[jump] = to, found[closer], 0
            walking = walking[place[walking] < k]
        return now, d


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _slices(batches):
    for b in batches:
        for at in range(0, b.num_rows, _ROWS):
            yield b.slice(at, _ROWS)


def _usual(search: Orchard, vectors: np.ndarray) -> int:
    """Where to start: the centroid that most of a batch's first vectors have."""
    return int(np.bincount(search.nearest(vectors[:64])[0]).argmax())


def means(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each centroid's vectors; centroids without any stay."""
    k, dim = centroids.shape
    out = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def task(batches):
        search = Orchard(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in _slices(batches):
            vectors = _vectors(b.column(0))
            chosen, _ = search.nearest(vectors, _usual(search, vectors))
            count += np.bincount(chosen, minlength=k)
            order = np.argsort(chosen, kind="stable")
            heads = np.flatnonzero(np.diff(chosen[order], prepend=-1))
            total[chosen[order[heads]]] += np.add.reduceat(vectors[order], heads, axis=0)
        hit = np.flatnonzero(count)
        if len(hit):
            yield batch(out, [hit, count[hit], total[hit].tolist()])

    parts = kept.select("v").mapInArrow(task, "cluster int, n long, sums array<long>")
    wide = parts.select("cluster", "n", F.posexplode("sums").alias("j", "s"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = wide.groupBy("cluster", "j").agg(exact("n"), exact("s")).collect()  # at most k x dim rows
    new = centroids.copy()
    for r in rows:
        new[r["cluster"], r["j"]] = int(r["s"]) // int(r["n"])
    return new


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared) of every kept vector."""
    out = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def task(batches):
        search = Orchard(centroids)
        for b in _slices(batches):
            vectors = _vectors(b.column(1))
            chosen, d = search.nearest(vectors, _usual(search, vectors))
            yield batch(out, [b.column(0), pa.array(chosen.astype(np.int32)), pa.array(d)])

    return kept.select("vec_id", "v").mapInArrow(task, "vec_id long, cluster int, distance long")


def fit(kept: DataFrame, k: int, rounds: int, prefix: str) -> np.ndarray:
    """The centroids after ``rounds`` rounds over stored, quantised vectors."""
    centroids = first_centroids(kept, k, prefix)
    for _ in range(rounds if len(centroids) else 0):
        centroids = means(kept, centroids)
    return centroids


def cluster(vectors: DataFrame, *, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, prefix: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and the centroid's checksum of every kept vector."""
    spark = vectors.sparkSession
    kept = stored(quantised(vectors, dim, scale, id_col=id_col, vector_col=vector_col), "vectors")
    centroids = fit(kept, k, rounds, prefix)
    ddl = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id long, distance long, {ddl}").select(*COLUMNS)
    found = stored(assign(kept, centroids), "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    fits = lambda n: n if n < 1 << 63 else None
    each = [(c, fits(sums.get(c, 0)), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    return found.join(F.broadcast(spark.createDataFrame(each, ddl)), "cluster").select(*COLUMNS)
