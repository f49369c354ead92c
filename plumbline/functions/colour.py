"""Legibility: contrast of sRGB colours, also as seen with a colour deficiency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_MIN_PX, LEGEND_MIN_PX, TEXT_CONTRAST, GEOMETRY_CONTRAST = 12.0, 14.0, 4.5, 3.0

# Published simulation matrices at severity 1.0, linear sRGB.
DEFICIENCIES = {
    "protanopia": (
        (0.152286, 1.052583, -0.204868),
        (0.114503, 0.786281, 0.099216),
        (-0.003882, -0.048116, 1.051998),
    ),
    "deuteranopia": (
        (0.367322, 0.860646, -0.227968),
        (0.280085, 0.672501, 0.047413),
        (-0.011820, 0.042940, 0.968881),
    ),
    "tritanopia": (
        (1.255528, -0.076749, -0.178779),
        (-0.078411, 0.930809, 0.147602),
        (0.004733, 0.691367, 0.303900),
    ),
}


def linear(channel: Column) -> Column:
    c = channel / F.lit(255.0)
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def encoded(value: Column) -> Column:
    c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
    return F.rint(F.when(c <= 0.0031308, c * 12.92).otherwise(F.pow(c, F.lit(1.0 / 2.4)) * 1.055 - 0.055) * 255.0)


def luminance(rgb: list[Column]) -> Column:
    return sum((F.lit(w) * linear(c) for w, c in zip((0.2126, 0.7152, 0.0722), rgb)), F.lit(0.0))


def contrast(fg: list[Column], bg: list[Column]) -> Column:
    a, b = luminance(fg), luminance(bg)
    return (F.greatest(a, b) + 0.05) / (F.least(a, b) + 0.05)


def as_seen(rgb: list[Column], deficiency: str) -> list[Column]:
    lin = [linear(c) for c in rgb]
    return [encoded(sum((F.lit(w) * c for w, c in zip(row, lin)), F.lit(0.0))) for row in DEFICIENCIES[deficiency]]


def readable(size_px: Column, kind: Column) -> Column:
    return size_px >= F.when(kind == "legend", LEGEND_MIN_PX).otherwise(TEXT_MIN_PX)
