"""Numeric expressions: clamps, guarded ratios, station states, hashed draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow.params import DEFAULT_CAPACITY, EMPTY_THRESHOLD, FULL_THRESHOLD, MAPE_EPSILON


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clamp(x: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    def bound(b):
        return F.lit(float(b)) if isinstance(b, (int, float)) else b

    if low is not None:
        x = F.greatest(bound(low), x)
    if high is not None:
        x = F.least(bound(high), x)
    return x


def safe_ratio(num: Column, den: Column) -> Column:
    """``num/den``; 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def station_state(
    bikes: Column | str,
    capacity: Column | str,
    empty: float = EMPTY_THRESHOLD,
    full: float = FULL_THRESHOLD,
) -> Column:
    """empty / full / normal. Both thresholds are inclusive and empty wins; an
    unknown count is normal, as it compares with nothing."""
    bikes = _c(bikes)
    capacity = F.coalesce(_c(capacity), F.lit(DEFAULT_CAPACITY))
    return (
        F.when(bikes.isNull() | F.isnan(bikes), "normal")
        .when(bikes <= capacity * F.lit(empty), "empty")
        .when(bikes >= capacity * F.lit(full), "full")
        .otherwise("normal")
    )


def relative_error(true: Column, pred: Column, epsilon: float = MAPE_EPSILON) -> Column:
    return F.abs(true - pred) / (F.abs(true) + F.lit(epsilon))


def activity_score(total: Column | str) -> Column:
    return F.log10(_c(total) + F.lit(1))


def uniform_sql(seed: int, *parts: str) -> str:
    """SQL text of a uniform in [0,1) that depends only on its arguments: the
    leading 52 bits of their MD5, so that a retried task, or another engine,
    draws the same numbers."""
    text = ", ".join([f"'{int(seed)}'", *(f"CAST({p} AS STRING)" for p in parts)])
    return f"CAST(conv(substr(md5(concat_ws('|', {text})), 1, 13), 16, 10) AS DOUBLE) / {2**52}D"


def poisson_sql(rate: str, u: str, most: str) -> str:
    """SQL text of min(Poisson(rate), most), walking the distribution function
    up to the uniform ``u``. Terms are kept as logarithms, as exp(-rate) is 0 for
    large rates."""
    return f"""CASE WHEN {most} < 1 THEN 0 ELSE aggregate(
        sequence(1, greatest(1, CAST({most} AS INT))),
        named_struct('k', 0, 'log', -({rate}), 'cdf', exp(-({rate})), 'u', {u}),
        (acc, i) -> CASE WHEN acc.k = i - 1 AND acc.u > acc.cdf
            THEN named_struct('k', i, 'log', acc.log + ln(({rate}) / i), 'cdf', acc.cdf + exp(acc.log + ln(({rate}) / i)), 'u', acc.u)
            ELSE acc END,
        acc -> acc.k) END"""


def position_sql(array: str, u: str, at: str = "{}") -> str:
    """SQL text of the number of leading elements of the ascending ``array`` that
    ``u`` has reached, by binary search. ``at`` takes an element's value."""
    halves = f"transform(sequence(CAST(ceil(log2(size({array}) + 1)) AS INT) - 1, 0), b -> shiftleft(1, b))"
    element = at.format(f"get({array}, found + half - 1)")
    return f"""CASE WHEN size({array}) < 1 THEN 0 ELSE aggregate({halves}, 0,
        (found, half) -> CASE WHEN {element} <= {u} THEN found + half ELSE found END) END"""
