"""Checks of 4x4 camera-to-world matrices as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.geometry import determinant3, determinant4

SINGULAR, LAST_ROW, ORTHONORMAL, CONVENTION = 1e-9, 1e-6, 1e-4, 1e-3
RELATIVE = 1e-5


def cells(flat: Column, size: int = 4) -> list[list[Column]]:
    return [[F.get(flat, F.lit(r * size + c)) for c in range(size)] for r in range(size)]


def _close(value: Column, target: float, tolerance: float) -> Column:
    return F.abs(value - F.lit(target)) <= F.lit(tolerance + RELATIVE * abs(target))


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def extrinsics_codes(flat: Column) -> Column:
    """Codes of a row-major matrix, hard ones first; warnings only if there are
    no hard ones, and the height only under the usual convention."""
    m = cells(flat)
    singular = F.abs(determinant4(m)) < SINGULAR
    last = _all([_close(m[3][c], 1.0 if c == 3 else 0.0, LAST_ROW) for c in range(4)])
    dot = lambda a, b: m[0][a] * m[0][b] + m[1][a] * m[1][b] + m[2][a] * m[2][b]
    orthonormal = _all([_close(dot(a, b), 1.0 if a == b else 0.0, ORTHONORMAL) for a in range(3) for b in range(3)])
    left_handed = determinant3([r[:3] for r in m[:3]]) < 0
    usual = _all([_close(m[r][1], t, CONVENTION) for r, t in ((0, 0.0), (1, 0.0), (2, -1.0))])
    say = lambda cond, code: F.when(cond, F.lit(code))
    hard = F.array_compact(F.array(say(singular, "MATRIX_NOT_INVERTIBLE"), say(~last, "MATRIX_LAST_ROW_INVALID"), F.when(~singular & ~orthonormal, F.lit("MATRIX_NOT_ORTHONORMAL")).when(~singular & left_handed, F.lit("MATRIX_NOT_RIGHT_HANDED"))))
    height, away = m[2][3], F.sqrt(m[0][3] * m[0][3] + m[1][3] * m[1][3] + m[2][3] * m[2][3])
    soft = F.array_compact(F.array(F.when(~usual, F.lit("NONSTANDARD_WORLD_CONVENTION")).when(~height.between(0.5, 3.0), F.lit("CAMERA_HEIGHT_OUTLIER")), say(away > 50.0, "CAMERA_POSITION_OUTLIER")))
    return F.when(F.size(flat) != 16, F.array(F.lit("INVALID_MATRIX_SHAPE"))).when(F.size(hard) > 0, hard).otherwise(soft)
