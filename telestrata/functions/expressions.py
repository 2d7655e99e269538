"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def outside(column: str, low: float, high: float) -> Column:
    """True outside the closed range, null for null; NaN is above every limit."""
    return F.expr(f"NOT {column} BETWEEN {float(low)!r}D AND {float(high)!r}D")


def flag_count(flag: str | Column) -> Column:
    """Rows whose flag is true; a null flag counts as not raised."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.count_if(flag)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, null when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole)


def exact_mean(value: str, places: int) -> Column:
    """Mean of a SQL expression whose values are already rounded to ``places``.

    Summing doubles depends on the order in which partitions merge, and a mean
    that lies on a rounding tie then changes between runs. The values are summed
    as decimals instead, which is order-free. With a value that no such decimal
    holds (NaN, infinity, 18 digits or more) the mean is null.
    """
    return F.expr(exact_mean_sql(value, places))


def exact_mean_sql(value: str, places: int) -> str:
    scale = 10**places
    exact = f"try_cast({value} AS decimal(18, {places}))"
    return (
        f"CASE WHEN count({value}) = count({exact}) "
        f"THEN try_divide(double(sum({exact}) * {scale}), count({value}) * {scale}) END"
    )


def whole_seconds_between(start: str, end: str) -> Column:
    """Difference of the two whole-second clock readings; zero is possible."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def bucket_of(value: Column, width: float, origin: float = 0.0) -> Column:
    """Index of the fixed-width bucket that holds ``value``."""
    return F.floor((value - F.lit(float(origin))) / F.lit(float(width)))
