"""Scalar expression helpers (all JVM-side, no Python UDFs).

Null / zero rules of the reference are encoded here once:

* guarded ratio ``coalesce(a / nullif(b, 0), 0)`` -> :func:`safe_ratio`
* ``when(b > 0, a / b).otherwise(0)`` (null condition -> 0) -> :func:`pos_ratio`
* unguarded IEEE division (NaN / inf instead of an ANSI error) -> :func:`float_divide`
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c) -> Column:
    """Epoch microseconds of a timestamp / timestamp_ntz / date column
    (session time zone is UTC, so both timestamp flavours agree)."""
    return F.unix_micros(col(c).cast("timestamp"))


def safe_ratio(a, b, default: float = 0.0) -> Column:
    """``COALESCE(a / NULLIF(b, 0), default)`` with float division."""
    a, b = col(a), col(b)
    return F.coalesce(a.cast("double") / F.nullif(b, F.lit(0)).cast("double"), F.lit(float(default)))


def pos_ratio(a, b) -> Column:
    """``a / b`` when ``b > 0`` else 0 (a null ``b`` also gives 0)."""
    a, b = col(a), col(b)
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def float_divide(x, y) -> Column:
    """IEEE division: x/0 gives +-inf or NaN instead of an ANSI error."""
    x, y = col(x).cast("double"), col(y).cast("double")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return (F.when(y.isNull() | x.isNull(), F.lit(None).cast("double"))
            .when(y == 0, F.when((x == 0) | F.isnan(x), nan).when(x > 0, inf).otherwise(-inf))
            .otherwise(x / y))


def nz_sum(cols) -> Column:
    """Horizontal sum treating null as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def array_mean(cols) -> Column:
    """Horizontal mean skipping nulls (null when all are null)."""
    arr = F.array_compact(F.array(*[col(c).cast("double") for c in cols]))
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(arr) > 0, total / F.size(arr))


def array_median(cols) -> Column:
    """Median of a list of columns, nulls skipped, average of the two middle
    values for even counts (null when all are null)."""
    arr = F.array_sort(F.array_compact(F.array(*[col(c).cast("double") for c in cols])))
    n = F.size(arr)
    lo = F.element_at(arr, ((n + 1) / 2).cast("int"))
    hi = F.element_at(arr, (n / 2).cast("int") + 1)
    return F.when(n > 0, (lo + hi) / 2)


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output hygiene for oracle comparison: round floating columns, widen
    integer columns to BIGINT, decimals to double.

    Rounding is ``round(x * 10^d) / 10^d`` (half away from zero on the
    scaled double), the same arithmetic SQL engines such as DuckDB use for
    ``ROUND(x, d)``, so both sides agree even on exact half-way values."""
    scale = float(10 ** digits)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            x = c.cast("double")
            c = F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.round(x * scale, 0) / scale)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
