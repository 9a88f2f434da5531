"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def differs(a: str | Column, b: str | Column) -> Column:
    """1 when the values differ; a missing value differs from every value and from another
    missing one, as a failed lookup is never evidence of equality."""
    return F.coalesce((as_column(a) != as_column(b)).cast("int"), F.lit(1))


def clip(x: str | Column, lower=None, upper=None) -> Column:
    """Limit to [lower, upper]; null stays null (greatest and least would drop it)."""
    value = bounded = as_column(x)
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(value.isNotNull(), bounded)


def ratio(numerator: str | Column, denominator: str | Column, default: float = 0.0) -> Column:
    """numerator / denominator, or ``default`` when the denominator is zero or missing."""
    return F.coalesce(F.try_divide(as_column(numerator), as_column(denominator)), F.lit(default))


def sigmoid(x: str | Column) -> Column:
    return 1 / (1 + F.exp(-as_column(x)))


def minute_key(ts: str | Column) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm")


def utc_text(ts: str | Column) -> Column:
    """ISO-8601 text with an explicit UTC offset; a naive instant is taken as UTC. The
    fraction is left out on a whole second."""
    at = as_column(ts).cast("timestamp")
    whole = F.unix_micros(at) % 1_000_000 == 0
    return F.when(whole, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def money(x: str | Column) -> Column:
    """Exact cents, so that sums do not depend on the order rows arrive in."""
    return as_column(x).cast("decimal(18,2)")
