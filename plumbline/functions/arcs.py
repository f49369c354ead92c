"""Circular arcs: bulges, sagittas, sweeps and tessellation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def bulge(theta: Column, sweep: Column) -> Column:
    """tan(theta / 4), positive counter-clockwise; null outside (0, 2 pi)."""
    size = F.when((theta > 0) & (theta < 2 * math.pi), F.tan(theta / 4))
    return F.when(sweep == "ccw", size).otherwise(-size)


def swept_by_bulge(value: Column) -> Column:
    return F.lit(4.0) * F.atan(F.abs(value))


def sagitta_px(radius: Column, theta: Column, n: Column, mm_per_px: float) -> Column:
    return radius * (F.lit(1.0) - F.cos(theta / (F.lit(2.0) * n))) / F.lit(mm_per_px)


def segments(radius: Column, theta: Column, bound_px: float, mm_per_px: float) -> Column:
    """The smallest power of two (2 at least) whose sagitta is within the bound:
    the closed form, and one step up or down against rounding."""
    room = F.greatest(F.lit(-1.0), F.lit(1.0) - F.lit(bound_px * mm_per_px) / radius)
    least = F.greatest(F.lit(2.0), F.ceil(theta / (F.lit(2.0) * F.acos(room))))
    guess = F.pow(F.lit(2.0), F.ceil(F.log2(least)))
    fits = lambda n: sagitta_px(radius, theta, n, mm_per_px) <= bound_px
    lower = F.greatest(F.lit(2.0), guess / 2)
    return F.when(fits(lower), lower).when(fits(guess), guess).otherwise(guess * 2).cast("int")


def swept_degrees(start: Column, end: Column, direction: Column) -> Column:
    """Degrees from start to end in the direction, in (0, 360]."""
    delta = F.pmod(F.pmod(end, F.lit(360.0)) - F.pmod(start, F.lit(360.0)), F.lit(360.0))
    turned = F.when(direction == "ccw", delta).otherwise(F.pmod(F.lit(360.0) - delta, F.lit(360.0)))
    return F.when(turned == 0, F.lit(360.0)).otherwise(turned)


def tessellated(cx: Column, cy: Column, radius: Column, start: Column, end: Column, direction: Column, n: Column) -> Column:
    """n + 1 points on the arc."""
    step = F.when(direction == "ccw", 1.0).otherwise(-1.0) * F.radians(swept_degrees(start, end, direction)) / n
    angle = lambda k: F.radians(start) + k * step
    return F.transform(F.sequence(F.lit(0), n), lambda k: F.struct((cx + radius * F.cos(angle(k))).alias("x"), (cy + radius * F.sin(angle(k))).alias("y")))


def bounded(radius: Column, start: Column, end: Column) -> Column:
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return finite(radius) & (radius > 0) & finite(start) & finite(end)


def signed_angle(degrees: Column) -> Column:
    """The angle in (-180, 180]."""
    turned = F.pmod(degrees, F.lit(360.0))
    return F.when(turned > 180, turned - 360).otherwise(turned)
