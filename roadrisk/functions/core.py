"""Null/NaN-safe column helpers and the severity score expression.

Every helper returns a ``Column`` so the work stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c) -> Column:
    """Lenient numeric parse: unparsable text -> NULL, 'NaN' -> NULL (never NaN)."""
    v = F.expr(f"try_cast(`{c}` AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def safe_ratio(numer: Column, denom: Column) -> Column:
    """``numer / denom`` when ``denom > 0``, else 0.0 (null operands also give 0.0)."""
    return F.when(denom > 0, numer / denom).otherwise(F.lit(0.0)).cast("double")


def weighted_severity(fatal, serious, moderate, minor, none) -> Column:
    """Severity score: (3*fatal + 2*serious + moderate + 0.5*minor) / (sum of all five).

    Row level (injury counts) and group level (their sums) share this builder.
    A null operand makes the numerator or denominator null and the score 0.0.
    """
    f, s, m, mi, n = (col_(c).cast("double") for c in (fatal, serious, moderate, minor, none))
    numer = 3 * f + 2 * s + 1 * m + 0.5 * mi
    denom = f + s + m + mi + n
    return safe_ratio(numer, denom)


def sum0(c) -> Column:
    """Sum that is 0 for an all-null (or empty) group, as a LongType."""
    return F.coalesce(F.sum(col_(c)), F.lit(0)).cast("long")


def any_of(preds) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def all_of(preds) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def null_false(pred: Column) -> Column:
    """Treat an unknown (NULL) predicate as false, so ``~`` keeps pandas semantics."""
    return F.coalesce(pred, F.lit(False))


def map_lookup(mapping: dict, c, default=None) -> Column:
    """Look ``c`` up in a literal map; missing keys give ``default`` (or NULL)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, col_(c))
    return v if default is None else F.coalesce(v, default if isinstance(default, Column) else F.lit(default))
