"""Rounding, ratios and deviations that do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def money(x: Column, digits: int = 2) -> Column:
    """Exact decimal rounding, half away from zero; stays decimal so sums stay exact."""
    return F.round(x, digits).cast(f"decimal(38,{digits})")


def worth(units: Column, price: Column) -> Column:
    """Whole units (13 digits at most) times an amount, in cents; the product fits 38 digits exactly."""
    return money(units.cast("decimal(13,0)") * price)


def rounded(x: Column, digits: int) -> Column:
    """Round a double half away from zero on its decimal digits; stays decimal."""
    return F.round(x.cast("decimal(38,10)"), digits)


def rnd(x: Column, digits: int) -> Column:
    return rounded(x, digits).cast("double")


def ratio(a: Column, b: Column) -> Column:
    """a / b in double; null for a zero divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return F.try_divide(F.lit(100.0) * a.cast("double"), b.cast("double"))


def wide(x: Column) -> Column:
    """Whole number with room for squares of large sums."""
    return x.cast("decimal(38,0)")


def square(x: Column) -> Column:
    narrow = x.cast("decimal(19,0)")
    return (narrow * narrow).cast("decimal(38,0)")


def deviation(n: Column, total: Column, squares: Column, sample: bool) -> Column:
    """Standard deviation of whole numbers from exact sums; 0 for a single observation."""
    spread = (wide(n) * wide(squares) - wide(total) * wide(total)).cast("double")
    cells = n.cast("double") * ((n - 1) if sample else n).cast("double")
    return F.coalesce(F.sqrt(F.try_divide(spread, cells)), F.lit(0.0))


def variance(n: Column, total: Column, squares: Column) -> Column:
    """Population variance of whole numbers from exact sums."""
    spread = (wide(n) * wide(squares) - wide(total) * wide(total)).cast("double")
    return F.try_divide(spread, n.cast("double") * n.cast("double"))


def plain(df: DataFrame) -> DataFrame:
    """Decimals to double, for output tables."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
