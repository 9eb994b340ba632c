"""Intervals and small statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z = 1.96


def wilson(k: Column, n: Column) -> tuple[Column, Column]:
    """The 95 % Wilson interval of a share k/n, within [0, 1]; nulls where n is not positive."""
    p = k / n
    z2 = Z * Z
    mid, width, size = p + z2 / (2 * n), Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)), 1 + z2 / n
    fine = n > 0
    return F.when(fine, F.greatest(F.lit(0.0), (mid - width) / size)), F.when(fine, F.least(F.lit(1.0), (mid + width) / size))


def wilson_sql(k: str, n: str) -> tuple[str, str]:
    z, z2 = f"{Z}::DOUBLE", f"{Z * Z}::DOUBLE"
    p = f"({k} / {n}::DOUBLE)"
    half = f"{z} * sqrt({p} * (1 - {p}) / {n} + {z2} / (4 * {n}::DOUBLE * {n}))"
    mid, size = f"({p} + {z2} / (2 * {n}::DOUBLE))", f"(1 + {z2} / {n})"
    return (f"CASE WHEN {n} > 0 THEN greatest(0::DOUBLE, ({mid} - {half}) / {size}) END", f"CASE WHEN {n} > 0 THEN least(1::DOUBLE, ({mid} + {half}) / {size}) END")


def utc_stamp(time: Column) -> Column:
    """ISO 8601 with milliseconds and Z; the session's time zone must be UTC."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def median(c: str | Column) -> Column:
    """Exact, interpolating between the two middle values."""
    return F.percentile(c, F.lit(0.5))
