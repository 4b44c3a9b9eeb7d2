"""Column expressions on field values: missing data, units, masks, percentages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed

INFINITY = float("inf")


def is_finite(value: Column) -> Column:
    """True for numbers; false for NULL, NaN and both infinities (NaN compares above infinity)."""
    return F.coalesce(F.abs(value) < F.lit(INFINITY), F.lit(False))


def null_if_nan(value: Column) -> Column:
    """NaN becomes NULL. Apply once at ingest: Spark's aggregates skip NULL but propagate NaN."""
    return F.when(~F.isnan(value), value)


def fill_missing(value: Column, fill: float = fixed.MISSING, *, floating: bool = True) -> Column:
    """Replace anything that is not a finite number by ``fill`` and store as float; other types pass through."""
    if not floating:
        return value
    return F.when(is_finite(value), value).otherwise(F.lit(float(fill))).cast("float")


def mask_where(value: Column, keep: Column, other: object = None) -> Column:
    """Keep ``value`` where the condition holds, else ``other``. An unknown condition counts as false."""
    return F.when(keep, value).otherwise(other if isinstance(other, Column) else F.lit(other))


def scale_offset(value: Column, scale: float = 1.0, offset: float = 0.0) -> Column:
    """``value * scale + offset``."""
    return value * F.lit(float(scale)) + F.lit(float(offset))


def wrap_longitude(lon: Column) -> Column:
    """Longitude in [0, 360)."""
    return F.pmod(lon, F.lit(360.0))


def to_percent(value: Column, largest: Column | float, *, test_scale: bool = True) -> Column:
    """Percent from a fraction: times 100 when the whole field stays within 0..1, then limited to 0..100.

    The limits keep NULL as NULL; ``greatest`` and ``least`` alone would skip it.
    """
    scaled = F.when(_column(largest) <= fixed.PERCENT_LIMIT, value * 100.0).otherwise(value) if test_scale else value
    return F.when(scaled.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), scaled)))


def pressure_to_pa(value: Column, units: Column, largest: Column) -> Column:
    """Pascal from hPa or mbar; blank units count as hPa while the axis stays at or below 2000."""
    name = F.lower(F.trim(F.coalesce(units, F.lit(""))))
    is_hpa = name.isin("hpa", "mb", "mbar", "millibar") | ((name == "") & (largest <= fixed.HPA_LIMIT))
    return F.when(is_hpa, value * 100.0).otherwise(value)


def reference_pressure(variable: Column | None = None, attribute: Column | None = None) -> Column:
    """Reference pressure: the stored variable, else the attribute, else 100000 Pa. Bad text counts as absent."""
    found = [c.try_cast("double") for c in (variable, attribute) if c is not None]
    return F.coalesce(*found, F.lit(fixed.REFERENCE_PRESSURE_PA))


def first_present(names: Sequence[str], available: Sequence[str]) -> str | None:
    """First of ``names`` that is among the ``available`` columns."""
    return next((n for n in names if n in available), None)


def _column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))
