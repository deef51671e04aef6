"""Exact division and rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide_down(numerator: Column, denominator: Column) -> Column:
    """Integer quotient, cut toward zero."""
    return F.call_function("div", numerator, denominator)


def round_half_up(value, scale: int = 2) -> Column:
    """Round a plain number to ``scale`` places, halves away from zero."""
    return F.round(value, scale)


def ratio(part: str, whole: str, scale: int = 2) -> Column:
    """``part / whole`` rounded half up to ``scale`` places; NULL when ``whole`` is 0.

    Both are SQL expressions of non-negative counts. The rounding is done on integers, so
    57 of 200 is 0.29 and not the 0.28 that the nearest double would give.
    """
    step = 10**scale
    whole = f"nullif({whole}, 0)"
    return F.expr(f"CAST(({part} * {2 * step} + {whole}) div ({whole} * 2) AS DOUBLE) / {step}D")
