"""How many texts of its component each text is linked with, exactly, without a row for any pair.

Members of a component are dealt into blocks by a hash of their name: one block for a small component,
more for a large one, so that a block has about ``MOST_TEXTS`` texts and ``MOST_CODES`` shingles at most
(a longer text is a block of its own, with what the hash puts beside it). A block is one row: names, set sizes and the
texts' shingle sets as sorted 64-bit codes. A task takes a block, or two blocks of one component, and
gets all overlaps between their texts as a product of incidence matrices, some columns at a time; only
the number of linked partners of each text leaves it. Rows between tasks are thus blocks and pairs of
blocks; the comparisons within a component of k texts remain k^2 / 2, as each link has to be told.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches, stored

MOST_TEXTS, MOST_CODES, COLUMNS = 512, 1_000_000, 4096
CODED = pa.schema([("label", pa.binary()), ("salt", pa.int64()), ("salts", pa.int64()), ("node", pa.binary()), ("codes", pa.binary())])
BLOCK = pa.schema([("label", pa.binary()), ("salt", pa.int64()), ("salts", pa.int64()), ("nodes", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())), ("codes", pa.binary())])
COUNTED = pa.schema([("node", pa.binary()), ("n", pa.int64())])
BLOCK_DDL = "label binary, salt long, salts long, nodes array<binary>, sizes array<long>, codes binary"


def overlaps(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b`` (of ``a`` itself, if None)."""
    sets = a if b is None else a + b
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = n > 1  # what one text alone has is in no intersection
    if b is not None:
        on = np.zeros((2, len(n)), bool)
        on[(owner >= len(a)).astype(int), column] = True
        useful = on.all(axis=0)
    kept = useful[column]
    place = (np.cumsum(useful) - 1)[column[kept]]
    owner = owner[kept]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    total = np.zeros((len(a), len(a) if b is None else len(b)))
    for low in range(0, int(useful.sum()), COLUMNS):
        i, j = np.searchsorted(place, (low, low + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owner[i:j], place[i:j] - low] = 1
        total += has[: len(a)] @ (has if b is None else has[len(a) :]).T
    return total


def partners(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each set of ``a`` and of ``b``, how many of the other list (of the same one, if ``b`` is None) are linked with it."""
    both = overlaps(a, b)
    sizes = np.asarray([len(s) for s in a], np.float64)
    other = sizes if b is None else np.asarray([len(s) for s in b], np.float64)
    linked = both >= threshold * (sizes[:, None] + other - both)
    if b is None:
        np.fill_diagonal(linked, False)
    return linked.sum(axis=1), linked.sum(axis=0)


def _sets(sizes: list[int], codes: bytes) -> list[np.ndarray]:
    return np.split(np.frombuffer(codes, np.uint64), np.cumsum(sizes)[:-1])


def packed(coded: DataFrame) -> DataFrame:
    """One row for each block of ``coded`` (label, salt, salts, node, codes)."""

    def task(batches):
        key, nodes, sets = None, [], []
        for b in small_batches(batches):
            for label, salt, salts, node, codes in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key is not None and key != (label, salt, salts):
                    yield batch(BLOCK, [[key[0]], [key[1]], [key[2]], [nodes], [[len(s) // 8 for s in sets]], [b"".join(sets)]])
                    nodes, sets = [], []
                key = (label, salt, salts)
                nodes.append(node)
                sets.append(codes)
        if key is not None:
            yield batch(BLOCK, [[key[0]], [key[1]], [key[2]], [nodes], [[len(s) // 8 for s in sets]], [b"".join(sets)]])

    dealt = coded.repartition("label", "salt").sortWithinPartitions("label", "salt")
    return dealt.select("label", "salt", "salts", "node", "codes").mapInArrow(task, BLOCK_DDL)


def counted(blocks: DataFrame, threshold: float) -> DataFrame:
    """node, n_links of all members of all blocks."""

    def inside(batches):
        for b in batches:
            for row in b.to_pylist():
                n, _ = partners(_sets(row["sizes"], row["codes"]), None, threshold)
                yield batch(COUNTED, [row["nodes"], n])

    def across(batches):
        for b in batches:
            for row in b.to_pylist():
                n, m = partners(_sets(row["sizes"], row["codes"]), _sets(row["sizes_b"], row["codes_b"]), threshold)
                yield batch(COUNTED, [row["nodes"] + row["nodes_b"], np.concatenate((n, m))])

    ddl = "node binary, n long"
    own = blocks.select("nodes", "sizes", "codes").mapInArrow(inside, ddl)
    later = blocks.where("salt + 1 < salts").withColumn("other", F.explode(F.expr("sequence(salt + 1, salts - 1)"))).drop("salt", "salts")
    far = blocks.where("salt > 0").select("label", F.col("salt").alias("other"), *[F.col(c).alias(f"{c}_b") for c in ("nodes", "sizes", "codes")])
    pairs = later.join(far, ["label", "other"]).select("nodes", "sizes", "codes", "nodes_b", "sizes_b", "codes_b")
    every = own.unionAll(pairs.mapInArrow(across, ddl))
    return every.groupBy("node").agg(F.sum("n").alias("n_links"))


def component_links(texts: DataFrame, labels: DataFrame, code, threshold: float) -> DataFrame:
    """node, n_links of all labelled nodes.

    ``texts`` has node, text (bytes) and is looked up by node; ``code`` gives the shingle codes of a list of texts.
    """

    def coded(batches):
        for b in small_batches(batches):
            sets = [np.unique(c).astype(np.uint64).tobytes() for c in code(b.column(4).to_pylist())]
            yield batch(CODED, [*b.columns[:4], sets])

    lengths = texts.select("node", F.octet_length("text").cast("long").alias("bytes"))
    members = stored(labels.join(lengths, "node"), "members")
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    # about one shingle for each word of six bytes
    sizes = sizes.select("label", F.greatest(F.ceil(F.col("n") / MOST_TEXTS), F.ceil(F.col("bytes") / (6 * MOST_CODES)), F.lit(1)).cast("long").alias("salts"))
    dealt = members.drop("bytes").join(sizes, "label").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")))
    rows = texts.select("node", "text").join(dealt, "node").select("label", "salt", "salts", "node", "text")
    sets = rows.mapInArrow(coded, "label binary, salt long, salts long, node binary, codes binary")
    return counted(stored(packed(sets), "blocks"), threshold)
