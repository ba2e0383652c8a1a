"""Table profiles: value counts, null counts, bounds, describe, class shares.

All profiles are single-pass aggregations (map-side partial aggregation, one
small exchange); value counts for many columns run as one unpivot + groupBy
instead of one job per column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dbscan import _checkpoint


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) for every non-null value of each column, one pass."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        ids=[], values=columns, variableColumnName="column", valueColumnName="value")
    return long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, null_count) for every column, computed in one aggregate."""
    cols = columns or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot(ids=[], values=cols, variableColumnName="column", valueColumnName="null_count")


def table_profile(df: DataFrame, head: int = 5) -> DataFrame:
    """One row for each column: position, type, rows, nulls, least and greatest value as text, estimated distinct values, first values.

    All columns' statistics are one aggregate over one scan; they merge, so nothing grows with the rows.
    ``head`` values come from a limit, which reads no more than it needs. Columns without an order
    (maps) have no extremes.
    """
    cols = df.columns
    text = lambda c: F.col(c).cast("string")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    plain = [c for c in cols if kinds[c].typeName() not in ("map", "variant")]
    aggs = [F.count(F.lit(1)).alias("n")]
    for k, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{k}"))
        if c in plain:
            aggs += [F.min(c).cast("string").alias(f"min_{k}"), F.max(c).cast("string").alias(f"max_{k}"), F.approx_count_distinct(c).alias(f"distinct_{k}")]
    row = df.agg(*aggs)
    first = df.limit(head).agg(*[F.collect_list(F.coalesce(text(c), F.lit("null"))).alias(f"head_{k}") for k, c in enumerate(cols)])
    both = row.withColumn("_one", F.lit(1)).join(first.withColumn("_one", F.lit(1)), "_one")  # two one-row tables
    none = F.lit(None)
    per = [F.struct(F.lit(k).alias("position"), F.lit(c).alias("column"), F.lit(kinds[c].simpleString()).alias("type"), F.col("n").alias("n_rows"), F.col(f"null_{k}").alias("n_null"),
                    *[(F.col(f"{name}_{k}") if c in plain else none.cast(t)).alias(out) for name, out, t in (("min", "least", "string"), ("max", "greatest", "string"), ("distinct", "distinct_estimate", "long"))],
                    F.col(f"head_{k}").alias("head")) for k, c in enumerate(cols)]
    return both.select(F.explode(F.array(*per)).alias("p")).select("p.*")


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def coordinate_bounds(df: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    return df.agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
                  F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"))


def describe(df: DataFrame, c: str) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max of one numeric column."""
    base = df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                  F.min(c).alias("min"), F.max(c).alias("max"))
    q = percentiles(df, c, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    j = base.withColumn("_one", F.lit(1)).join(q.withColumn("_one", F.lit(1)), "_one")  # two one-row tables
    return j.select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Share of each non-null label value (the per-class counts are tiny; the
    total is a window over that small aggregate, not over the input)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def group_ranges(df: DataFrame, key: str, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    """Per-group bounding ranges and centre (one aggregate, no self-join)."""
    return df.groupBy(key).agg(
        F.min(lat).alias("LAT_MIN"), F.max(lat).alias("LAT_MAX"), F.min(lon).alias("LON_MIN"),
        F.max(lon).alias("LON_MAX"), F.avg(lat).alias("LAT_CENTER"), F.avg(lon).alias("LON_CENTER"),
    )


def unpivoted(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, v): the values of many columns as doubles, nulls left out."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(ids=[], values=cols, variableColumnName="column", valueColumnName="v")
    return long.filter(F.col("v").isNotNull())


def frequencies(long: DataFrame) -> DataFrame:
    """(column, v, n): how often each value stands in its column."""
    return long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))


def _value_positions(freq: DataFrame) -> DataFrame:
    """(column, v, start, end): the 0-based positions that value v fills in its column's ascending order.

    The value-frequency table is range-partitioned by (column, v) and sorted, running counts are local
    to a partition, and a table of one row per partition and column adds what lies before. No column
    and no value is ever in one task as a whole; the same path serves every size.
    """
    def running(batches):
        """Adds the running sum of n within each run of equal ``column`` of a sorted partition."""
        column, carried = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            names = b.column("column").dictionary_encode()
            codes, counts = names.indices.to_numpy(), b.column("n").to_numpy()
            heads = np.flatnonzero(np.diff(codes, prepend=-1))
            ends = np.cumsum(counts)
            before = ends[heads] - counts[heads]
            if names.dictionary[int(codes[0])].as_py() == column:
                before[0] -= carried
            ends = ends - np.repeat(before, np.diff(heads, append=len(codes)))
            column, carried = names.dictionary[int(codes[-1])].as_py(), int(ends[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.int64())], names=[*b.schema.names, "_end"])

    local = freq.select("column", "v", "n").repartitionByRange("column", "v").sortWithinPartitions("column", "v").withColumn("_part", F.spark_partition_id())
    local = _checkpoint(local.mapInArrow(running, "column string, v double, n long, _part int, _end long"))
    sums = local.groupBy("_part", "column").agg(F.sum("n").alias("_s"))
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    cum = local.join(sums, ["_part", "column"])
    return cum.select("column", "v", (F.col("_off") + F.col("_end") - F.col("n")).alias("start"), (F.col("_off") + F.col("_end")).alias("end"))


def quantiles(long: DataFrame, qs: list[float], names: list[str]) -> DataFrame:
    """Exact linear-interpolation quantiles per ``column`` of a (column, v) table without null values."""
    return quantiles_of(frequencies(long), qs, names)


def quantiles_of(freq: DataFrame, qs: list[float], names: list[str]) -> DataFrame:
    """The same from a table of ``frequencies``."""
    cum = _value_positions(freq)
    totals = cum.groupBy("column").agg(F.max("end").alias("_tot"))  # one row per column
    at = cum.join(totals, "column")
    exprs = []
    for i, q in enumerate(qs):
        h = (F.col("_tot") - 1) * F.lit(q)
        for side, pos in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            exprs.append(F.max(F.when((pos >= F.col("start")) & (pos < F.col("end")), F.col("v"))).alias(f"_{side}{i}"))
        exprs.append(F.max(h - F.floor(h)).alias(f"_f{i}"))
    per = at.groupBy("column").agg(*exprs)
    return per.select("column", *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(n)
                                  for i, n in enumerate(names)])


def percentiles(df: DataFrame, c: str, qs: list[float], names: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles of the non-null values, as a one-row table (nulls for no values)."""
    names = names or [f"q{i}" for i in range(len(qs))]
    vals = df.select(F.lit("v").alias("column"), F.col(c).cast("double").alias("v")).filter(F.col("v").isNotNull())
    return quantiles(vals, qs, names).agg(*[F.max(n).alias(n) for n in names])


def medians(df: DataFrame, cols: list[str], prefix: str = "_med_") -> DataFrame:
    """Exact medians (linear interpolation) of many columns in one pass, as a one-row table."""
    long = unpivoted(df, cols)
    row = quantiles(long, [0.5], ["m"]).groupBy().pivot("column", cols).agg(F.first("m"))
    return row.select(*[F.col(c).alias(prefix + c) for c in cols])
