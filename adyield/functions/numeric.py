"""Weighted statistics, exact money ratios and rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_UNITS = 10000


def money_units(amount: Column) -> Column:
    """Amount in whole 1/10000 units, so that sums do not depend on the row order."""
    return F.round(amount * F.lit(MONEY_UNITS)).cast("long")


def money_ratio(units: Column, count: Column) -> Column:
    """units / count rounded half up to four decimals with whole-number arithmetic."""
    n = count.cast("long")
    positive = F.call_function("div", F.abs(units) * F.lit(2) + n, n * F.lit(2))
    return F.when(n != 0, F.signum(units.cast("double")) * positive / F.lit(float(MONEY_UNITS)))


def wavg(value: Column, weight: Column) -> Column:
    """Weighted mean as an aggregate; NULL when the weights sum to zero, missing values add nothing."""
    return F.try_divide(F.coalesce(F.sum(value * weight), F.lit(0.0)), F.sum(weight))


def wvar(value: Column, weight: Column) -> Column:
    """Population-weighted variance as a one-pass aggregate."""
    mean = wavg(value, weight)
    return F.greatest(wavg(value * value, weight) - mean * mean, F.lit(0.0))


def wstd(value: Column, weight: Column) -> Column:
    return F.sqrt(wvar(value, weight))


def floor_to_twentieth(value: Column) -> Column:
    return F.floor(value * F.lit(20)) / F.lit(20.0)


def round_to_twentieth(value: Column) -> Column:
    return F.bround(F.bround(value / F.lit(0.05)) * F.lit(0.05), 2)


def scaled_modifier(modifier: Column, scale: float) -> Column:
    return (modifier - F.lit(1.0)) * F.lit(scale) + F.lit(1.0)


def bid_clip(target: Column, old: Column, max_cut: Column, max_push: Column, floor: Column) -> Column:
    """Target kept within old*(1+cut) .. old*(1+push), then at least ``floor``, in cents; no target, no bid."""
    clipped = F.least(F.greatest(target, old * (F.lit(1.0) + max_cut)), old * (F.lit(1.0) + max_push))
    return F.when(target.isNotNull(), F.bround(F.greatest(clipped, floor), 2))


def day_decay(days_back: Column, rate: float = 0.03) -> Column:
    return F.exp(days_back * F.lit(-rate))


def relative_error(estimate: Column, actual: Column) -> Column:
    return F.abs(F.try_divide(estimate - actual, actual))
