"""Element-wise arithmetic on feature arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blend(a: Column, wa: Column, b: Column, wb: Column) -> Column:
    """wa * a + wb * b, element by element."""
    return F.zip_with(a, b, lambda x, y: wa * x + wb * y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def squared_error(a: Column, b: Column) -> Column:
    """Sum of squared differences of two arrays."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x
    )


def all_close(a: Column, b: Column, atol: float = 1e-8, rtol: float = 1e-5) -> Column:
    """True if |a-b| <= atol + rtol*|b| everywhere."""
    return F.forall(
        F.zip_with(a, b, lambda x, y: F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y)), lambda ok: ok
    )


def argmax(block: Column) -> Column:
    """1-based position of the first largest element."""
    return F.array_position(block, F.array_max(block))
