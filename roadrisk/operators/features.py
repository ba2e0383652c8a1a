"""Model feature table: recodes, date parts, drops, fills and label encoding.

Label encoding maps each category to its position in the sorted list of the
column's distinct values (the usual label-encoder rule). The vocabularies are
computed from each batch's distinct values + distinct + distributed rank over
the distinct values and counted. A small vocabulary becomes a literal map in the
row's own projection; a larger one is joined, broadcast up to a bound, so the
wide table is not shuffled for encoding.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import map_lookup
from ..functions.recode import (datetime_parts, recode_categories, recode_causes, recode_traffic_control,
                                time_of_day)
from ..schemas import CATEGORICAL_COLUMNS, DROP_COLUMNS, DROP_HIGH_NULL_COLUMNS, FEATURE_COLUMNS, TARGET
from .clean import drop_zero_points
from .sampling import BROADCAST_ROWS, row_number_distributed

LITERAL_VALUES = 100  # a map literal is searched value by value


def label_vocab(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code) with code = rank of value among the sorted distinct values - 1."""
    def values(batches):
        """The distinct values of each column of a batch, so that rows times columns are never laid out."""
        for b in batches:
            found = [pc.drop_null(pc.unique(b.column(k))).cast(pa.string()) for k in range(len(columns))]
            names = pa.array([c for c, v in zip(columns, found) for _ in range(len(v))], pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.concat_arrays(found)], names=["column", "value"])

    distinct = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).mapInArrow(values, "column string, value string").distinct()
    ranked = row_number_distributed(distinct, ["column"], [F.col("value")])
    return ranked.select("column", "value", (F.col("rn") - 1).cast("int").alias("code"))


def _literal_codes(vocab: DataFrame, columns: list[str]) -> dict:
    """From column to its lookup, for those ``columns`` (of few values each) whose values stand in the vocabulary once."""
    kinds = {f.name: f.dataType for f in vocab.schema.fields}
    if kinds["value"].simpleString() != "string" or not columns:
        return {}
    held: dict[str, list[tuple]] = {c: [] for c in columns}
    for r in vocab.filter(F.col("column").isin(columns) & F.col("value").isNotNull()).select("column", "value", "code").collect():
        held[r["column"]].append((r["value"], r["code"]))

    def lookup(codes: dict):
        def code(value: Column) -> Column:
            found = map_lookup(codes, value) if codes else F.lit(None)
            return found.cast(kinds["code"])

        return code

    return {c: lookup(dict(v)) for c, v in held.items() if len(dict(v)) == len(v)}


def label_encode(df: DataFrame, columns: list[str], vocab: DataFrame | None = None, fill: str | None = None) -> DataFrame:
    """Replace each column by its integer code (unknown values -> null).

    Vocabularies of at most ``LITERAL_VALUES`` values are map literals, all looked up in one projection. Each other one is
    a lookup join: broadcast if it was counted as small, by a shuffle if not.
    """
    if fill is not None:
        df = df.fillna(fill, subset=columns)
    vocab = vocab if vocab is not None else label_vocab(df, columns)
    sizes = {r["column"]: r["count"] for r in vocab.groupBy("column").count().collect()}
    literal = _literal_codes(vocab, [c for c in columns if sizes.get(c, 0) <= LITERAL_VALUES])
    df = df.withColumns({c: code(df[c].cast("string")) for c, code in literal.items()})
    for c in (c for c in columns if c not in literal):
        part = vocab.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        part = F.broadcast(part) if sizes.get(c, 0) <= BROADCAST_ROWS else part
        order = df.columns
        df = df.join(part, df[c].cast("string") == part["_value"], "left").withColumn(c, F.col("_code")).select(*order)
    return df


def prepare_categories(df: DataFrame) -> DataFrame:
    """Cause groups, list recodes, traffic-control keep-list, date/time parts."""
    df = recode_causes(df)
    if "DATE_POLICE_NOTIFIED" in df.columns:
        df = datetime_parts(df, "DATE_POLICE_NOTIFIED", "DATE_POLICE_NOTIFIED_DATE_ONLY", "TIME_POLICE_NOTIFIED")
    if "CRASH_DATE" in df.columns:
        df = datetime_parts(df, "CRASH_DATE", "CRASH_DATE_ONLY", "CRASH_TIME")
    df = recode_categories(df)
    return recode_traffic_control(df)


def feature_table(raw: DataFrame, keep: tuple[str, ...] = ("crash_id",), encode: bool = True) -> DataFrame:
    """Integer-coded modelling table: the 20 features + target (+ ``keep`` columns).

    Rows: coordinates present and not both zero. Leakage/identifier columns,
    mostly-null columns and temporary date columns are dropped; report type and
    intersection flag nulls become 'UNKNOWN'; other categorical nulls become
    'Missing' before encoding; the time-of-day label is encoded the same way.
    """
    df = prepare_categories(drop_zero_points(raw))
    drop = [c for c in DROP_COLUMNS + DROP_HIGH_NULL_COLUMNS + ["DATE_POLICE_NOTIFIED_DATE_ONLY", "CRASH_DATE_ONLY",
                                                                "CRASH_TIME", "TIME_POLICE_NOTIFIED"]
            if c in df.columns and c not in keep]
    df = df.drop(*drop).fillna("UNKNOWN", subset=[c for c in ("REPORT_TYPE", "INTERSECTION_RELATED_I") if c in df.columns])
    df = df.withColumn("CRASH_TIME_OF_DAY", time_of_day("CRASH_HOUR"))
    cats = [c for c in CATEGORICAL_COLUMNS if c in df.columns]
    df = df.fillna("Missing", subset=cats)
    if encode:
        df = label_encode(df, cats + ["CRASH_TIME_OF_DAY"])
    cols = [*keep, *[c for c in FEATURE_COLUMNS if c in df.columns], TARGET]
    return df.select(*cols)
