"""Deterministic exact sampling, stratified split and folds.

Order keys are ``md5(seed-key)`` so the same rows are chosen in any engine and
on any cluster layout. Per-class row numbers are computed *distributed*: a
range partitioning on (class, hash) spreads even one giant class across many
tasks, each task numbers its own slice, and a table with one row per
(partition, class) supplies the offsets. No class ever sits in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dbscan import _stored

BROADCAST_ROWS = 100_000


def hash_key(key, seed: int = 42) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("-", F.lit(str(seed)), k.cast("string")))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows chosen by hash order (top-n, no full sort)."""
    return df.orderBy(hash_key(key, seed), F.col(key)).limit(n)


def row_number_distributed(df: DataFrame, part_cols: list[str], order_cols: list, out: str = "rn", size: str | None = None,
                           drop: tuple[str, ...] = ()) -> DataFrame:
    """1-based row number within ``part_cols`` groups in ``order_cols`` order, with one shuffle of the rows.

    ``size`` names a column for the number of rows of each group, which the same small table tells. ``drop`` names
    columns that only the order needs. The numbered rows are stored as Parquet, so the small table reads three columns.

    After the range partitioning and local sort, ``monotonically_increasing_id`` holds the partition
    (upper bits) and the row within it (lower 33 bits); a table with one row per partition and group
    tells where each group begins there and how many of its rows lie in earlier partitions.
    """
    order = [*[F.col(c) for c in part_cols], *order_cols]
    r = _stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).drop(*drop), "numbered")
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    starts = r.groupBy(part.alias("_part"), *part_cols).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_n"))
    prior = Window.partitionBy(*part_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("_n").over(Window.partitionBy(*part_cols)).alias("_size")
    starts = starts.select("_part", *part_cols, (F.coalesce(F.sum("_n").over(prior), F.lit(0)) - F.col("_first") + 1).alias("_off"), whole)
    if starts.count() <= BROADCAST_ROWS:  # partitions x groups, counted
        starts = F.broadcast(starts)
    match = F.col("_part") == part
    for c in part_cols:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    j = r.join(starts.select("_part", "_off", "_size", *[F.col(c).alias(f"_k_{c}") for c in part_cols]), match)
    j = j.withColumn(size, F.col("_size")) if size else j
    return j.withColumn(out, (row + F.col("_off")).cast("long")).drop("_id", "_size", "_part", "_off", *[f"_k_{c}" for c in part_cols])


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: per class exactly round(test_size * n_class) rows (hash order) are test."""
    h = hash_key(key, seed)
    ranked = row_number_distributed(df.withColumn("_h", h), [label], [F.col("_h"), F.col(key)], size="_nc", drop=("_h",)).filter(F.col(label).isNotNull())
    return ranked.withColumn("is_test", F.col("rn") <= F.round(F.col("_nc") * test_size)).drop("_nc")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` in 0..k-1, dealt round-robin per class in hash order."""
    h = hash_key(key, seed)
    ranked = row_number_distributed(df.withColumn("_h", h), [label], [F.col("_h"), F.col(key)], drop=("_h",))
    return ranked.withColumn("fold", ((F.col("rn") - 1) % k).cast("int"))


def example_rows(df: DataFrame, key: str, positions=(10, 100, 250), seed: int = 42) -> DataFrame:
    """Rows at the given 0-based positions of the hash order; falls back to
    position 0 when none of them exists."""
    top = df.withColumn("_h", hash_key(key, seed)).orderBy("_h", key).limit(max(positions) + 1)  # a top-n, no full sort
    order = Window.orderBy("_h", key)  # over at most max(positions) + 1 rows
    top = top.withColumn("position", (F.row_number().over(order) - 1).cast("long"))
    wanted = F.col("position").isin(list(positions))
    top = top.withColumn("_any", F.max(wanted).over(Window.partitionBy()))
    return top.filter(wanted | (~F.col("_any") & (F.col("position") == 0))).drop("_h", "_any")
