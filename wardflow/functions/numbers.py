"""Exact rounding, percentages, risk bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band limits in percent; the comparisons are strict.
HIGH_ABOVE = 50
MODERATE_ABOVE = 20


def ratio_half_up(numerator: Column, denominator: Column, factor: int = 1, digits: int = 2) -> Column:
    """``factor * numerator / denominator`` rounded half away from zero to ``digits``.

    Works on whole numbers only, so no intermediate quotient is rounded first:
    a DECIMAL average keeps a few digits and would round twice, and a double can
    sit on the wrong side of a tie.
    """
    scale = 10**digits
    num = numerator.cast("bigint")
    den = denominator.cast("bigint")
    doubled = F.abs(num) * F.lit(2 * factor * scale).cast("bigint") + den
    steps = F.call_function("div", doubled, den * F.lit(2).cast("bigint"))
    value = F.signum(num.cast("double")) * steps.cast("double") / F.lit(float(scale))
    return F.when(den != 0, value + F.lit(0.0))


def rate_percent(positives: Column, total: Column) -> Column:
    """Share of positives in percent, two decimals."""
    return ratio_half_up(positives, total, factor=100)


def risk_percent(probability: Column) -> Column:
    return probability * F.lit(100.0)


def risk_band(percent: Column) -> Column:
    return (
        F.when(percent > HIGH_ABOVE, "HIGH")
        .when(percent > MODERATE_ABOVE, "MODERATE")
        .when(percent.isNotNull(), "LOW")
    )


def percent_text(percent: Column) -> Column:
    """One-decimal text such as ``12.3%`` for a percentage of at least 0.

    Rounds the exact binary value, ties to even. The JVM formatter rounds the
    shortest decimal form instead and differs on values such as 12.35. Splitting
    off the low bits keeps every product exact.
    """
    tenths = F.floor(percent * 10)
    high = F.floor(percent * F.lit(float(2**20))) / F.lit(float(2**20))
    above_half = (high * 10 - tenths - F.lit(0.5)) + (percent - high) * 10
    up = (above_half > 0) | ((above_half == 0) & (tenths % 2 == 1))
    rounded = tenths + up.cast("bigint")
    return F.concat(
        F.call_function("div", rounded, F.lit(10)).cast("string"),
        F.lit("."),
        (rounded % 10).cast("string"),
        F.lit("%"),
    )
