"""Expression helpers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens import schemas as S


def present(name: str, dtype: T.DataType) -> Column:
    """True when column ``name`` (of type ``dtype``) holds a value: not NULL
    and, for floats, not NaN.

    This is what ``DataFrame.dropna`` tests, written as plain predicates so
    that the Parquet reader receives ``IsNotNull`` filters (``dropna`` is an
    opaque ``AtLeastNNonNulls`` that is never pushed down).
    """
    col = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def as_timestamp(df: DataFrame, name: str) -> Column:
    """``name`` as a session-zone timestamp; unparsable text becomes NULL."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(col)
    if isinstance(dtype, T.TimestampType):
        return col
    return col.cast(T.TimestampType())


def as_date(df: DataFrame, name: str) -> Column:
    """``name`` as a date; unparsable text becomes NULL."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.try_to_date(col)
    if isinstance(dtype, T.DateType):
        return col
    return F.to_date(col)


def alert_rate(warnings: Column, criticals: Column, readings: Column) -> Column:
    """KPI alert rate in percent, unrounded; 0.0 when there are no readings."""
    return F.when(readings > 0, (warnings + criticals) / readings * 100).otherwise(
        F.lit(0.0)
    )


def alert_rate_pct(warnings: Column, criticals: Column, readings: Column) -> Column:
    """Per-machine alert rate in percent, rounded to one digit (HALF_UP)."""
    return F.round((warnings + criticals) / readings * 100, 1)


def health_score(warnings: Column, criticals: Column, readings: Column) -> Column:
    """100 minus the penalty rate, clamped at 0, rounded to one digit."""
    penalty = warnings * S.WARNING_PENALTY + criticals * S.CRITICAL_PENALTY
    return F.round(
        F.greatest(F.lit(0.0), F.lit(100.0) - penalty / readings * 100), 1
    )


def health_status(score: Column) -> Column:
    """Category of the *rounded* score."""
    return (
        F.when(score >= S.HEALTHY_MIN_SCORE, F.lit(S.HEALTHY))
        .when(score >= S.WATCH_MIN_SCORE, F.lit(S.WATCH))
        .otherwise(F.lit(S.AT_RISK))
    )
