"""Fixed-point coordinates: a grid of 1e-4 m, rounded half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 10_000
QUANTUM_M = 1e-4


def exact(value: Column, kind: str = "decimal(22,13)") -> Column:
    """The decimal that a double prints as; null if it doesn't fit."""
    return value.cast("string").try_cast(kind)


def grid(value: Column, scale: Column) -> Column:
    """value * scale, in metres, on the grid (bigint); null if not finite."""
    product = exact(value) * exact(scale, "decimal(14,10)")
    return (F.bround(product, 4).try_cast("decimal(20,4)") * F.lit(GRID)).try_cast("bigint")


def quantised(value: Column) -> Column:
    """A length in metres on the grid (bigint)."""
    return (F.bround(exact(value), 4).try_cast("decimal(20,4)") * F.lit(GRID)).try_cast("bigint")


def metres(g: Column) -> Column:
    return g / F.lit(float(GRID))


def key_text(g: Column) -> Column:
    """A grid value as text with four decimals; there is no negative zero."""
    return (g.cast("decimal(16,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(20,4)").cast("string")


def short_number(value: Column) -> Column:
    """Three decimals, without trailing zeros; -0 is 0."""
    text = F.rtrim(F.rtrim(F.format_string("%.3f", value.cast("double")), F.lit("0")), F.lit("."))
    return F.when(text.isin("-0", ""), F.lit("0")).otherwise(text)


def content_id(prefix: str, *parts: Column) -> Column:
    """prefix and the first 12 hex digits of the sha256 of the joined parts."""
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 12))


def floor_grid(value: Column, step: float) -> Column:
    """The grid of the evaluator: floor(v / step + 0.5) * step."""
    return F.floor(value / F.lit(step) + F.lit(0.5)) * F.lit(step)
