"""Scalar expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0


def present(*cols: str) -> Column:
    """True where every column is neither null nor the empty string."""
    condition = F.lit(True)
    for name in cols:
        condition = condition & F.col(name).isNotNull() & (F.col(name).cast("string") != "")
    return condition


def positive_label(hours: Column, threshold: float = 1.0) -> Column:
    return hours >= F.lit(threshold)


def to_number(value: Column) -> Column:
    """Number or NULL; garbage and NaN never survive."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def clip(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value on one or both sides; NULL stays NULL."""
    bounded = value
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(float(lower)))
    if upper is not None:
        bounded = F.least(bounded, F.lit(float(upper)))
    return F.when(value.isNotNull(), bounded)


def text_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def mentions(text: Column, word: str) -> Column:
    """Case-insensitive substring test, false for NULL."""
    return F.coalesce(F.lower(text).contains(word), F.lit(False))


def feature_name(prefix: str, value: str) -> str:
    """Column name for a category value."""
    return f"{prefix}_{value.replace(' ', '_').replace('&', 'and')}"


def feature_name_column(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.replace(F.replace(value, F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and")))


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days from ``earlier`` to ``later``."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(SECONDS_PER_DAY * 1e6)


def hour_angle(ts: Column) -> Column:
    """Hour of day as an angle; a missing time counts as hour 0."""
    return F.coalesce(F.hour(ts), F.lit(0)).cast("double") * F.lit(2.0) * F.pi() / F.lit(24.0)


def cyclic_hour(ts: Column) -> tuple[Column, Column]:
    return F.sin(hour_angle(ts)), F.cos(hour_angle(ts))


def scaled_year(date: Column) -> Column:
    """Release year on a 2000-2030 scale, 2015 when unknown, never below zero."""
    return clip(F.coalesce(F.year(date), F.lit(2015)) - F.lit(2000), lower=0) / F.lit(30.0)


def log_price(price: Column) -> Column:
    return F.log1p(clip(F.coalesce(price, F.lit(0.0)), lower=0))


def sigmoid(x: Column) -> Column:
    """Logistic function with the exponent clipped to [-35, 35]."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clip(x, -35.0, 35.0)))


def discount(rank: Column) -> Column:
    """Positional discount of a 1-based rank."""
    return F.lit(1.0) / F.log2(rank.cast("double") + F.lit(1.0))


def ideal_dcg(positives: Column, k: int) -> Column:
    """DCG when the first ``min(positives, k)`` ranks are all hits."""
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(positives.cast("int"), F.lit(k)))),
        F.lit(0.0),
        lambda total, rank: total + discount(rank),
    )
