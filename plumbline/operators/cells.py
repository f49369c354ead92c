"""Joins by place within a plan.

A plan of few boxes is one cell, so its join is a plain equi-join by plan.  The boxes
of a large plan go to the cells of a grid that they cover; each box has the grid of
its own size (levels, each with cells eight times as wide as the one before), so it
covers no more than 36 cells, whether it is a door or a facade.  Either way the join's
key holds the plan and the cell, and no task meets all pairs of a large plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Boxes of a plan from which on it has a grid.
LARGE = 512
#: Width of the smallest cells in metres, and the number of levels.
BASE_M, LEVELS = 0.25, 11
#: A box that reaches everywhere.
FAR_M = 1e8

_CELL = ("level", "cx", "cy")


def _size(level: Column) -> Column:
    return F.lit(BASE_M) * F.pow(F.lit(8.0), level.cast("double"))


def _level(x0: str, y0: str, x1: str, y1: str) -> Column:
    """The first level whose cells are a fourth of the box at least."""
    wide = F.greatest(F.col(x1) - F.col(x0), F.col(y1) - F.col(y0), F.lit(4 * BASE_M))
    return F.least(F.lit(LEVELS - 1), F.ceil(F.log2(wide / (4 * BASE_M)) / 3 - F.lit(1e-9)).cast("int"))


def _cell(level: Column, x: Column, y: Column) -> Column:
    return F.struct(level.cast("int").alias("level"), F.floor(x / _size(level)).alias("cx"), F.floor(y / _size(level)).alias("cy"))


def _covered(level: Column, box: tuple[str, str, str, str]) -> Column:
    """The cells of a level that the box covers."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / _size(level)), F.floor(F.col(b) / _size(level)))
    x0, y0, x1, y1 = box
    cell = lambda cx, cy: F.struct(level.cast("int").alias("level"), cx.alias("cx"), cy.alias("cy"))
    return F.flatten(F.transform(span(x0, x1), lambda cx: F.transform(span(y0, y1), lambda cy: cell(cx, cy))))


def _whole() -> Column:
    return F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy")))


def once(df: DataFrame, *names: str) -> DataFrame:
    """df with these columns computed once a row: what is read many times (as the
    corners of a box are) would else be put in the place of each reading."""
    out = df.withColumn("_once", F.explode(F.array(F.struct(*names))))
    return out.select(*(F.col(f"_once.{c}").alias(c) if c in names else F.col(c) for c in df.columns))


def _placed(df: DataFrame, large: DataFrame, cells: Column) -> DataFrame:
    known = df.join(large, "plan_id", "left")
    out = known.withColumn("_cell", F.explode(F.when(F.col("_large"), cells).otherwise(_whole()))).drop("_large")
    return out.select("*", *(F.col(f"_cell.{c}").alias(f"_{c}") for c in _CELL)).drop("_cell")


def _large(boxes: DataFrame) -> DataFrame:
    return boxes.groupBy("plan_id").agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select("plan_id", F.lit(True).alias("_large"))


def points_in_boxes(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """points (plan_id, px, py, ...) with each box (plan_id, x0, y0, x1, y1, ...) of
    their plan that holds them, borders included; other columns must differ."""
    box = ("x0", "y0", "x1", "y1")
    large, points = _large(boxes), once(points, "px", "py")
    boxes = once(once(boxes, *box).withColumn("_own", _level(*box)), "_own")
    probes = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: _cell(k, F.col("px"), F.col("py")))
    left, right = _placed(points, large, probes), _placed(boxes, large, _covered(F.col("_own"), box)).drop("_own")
    key = ["plan_id", *(f"_{c}" for c in _CELL)]
    inside = F.col("px").between(F.col("x0"), F.col("x1")) & F.col("py").between(F.col("y0"), F.col("y1"))
    return left.join(right, key).where(inside).drop(*key[1:], *box)


def meeting_boxes(boxes: DataFrame, *carried: str) -> DataFrame:
    """Pairs of boxes (plan_id, ord, x0, y0, x1, y1) of a plan that meet, once each:
    plan_id, a_ord < b_ord and a_, b_ of the carried columns."""
    box = ("x0", "y0", "x1", "y1")
    large, names = _large(boxes), ("ord", *box, *carried, "level")
    boxes = once(once(boxes, *box).withColumn("level", _level(*box)), "level")
    side = lambda p: boxes.select("plan_id", *(F.col(c).alias(f"{p}{c}") for c in names))
    left, right = side("l_"), side("r_")
    # The larger box (by level) at its own level; the other one at all levels from its own.
    left = _placed(left, large, _covered(F.col("l_level"), ("l_x0", "l_y0", "l_x1", "l_y1")))
    up = F.flatten(F.transform(F.sequence(F.col("r_level"), F.lit(LEVELS - 1)), lambda k: _covered(k, ("r_x0", "r_y0", "r_x1", "r_y1"))))
    right = _placed(right, large, up)
    meet = (F.col("l_x0") <= F.col("r_x1")) & (F.col("r_x0") <= F.col("l_x1")) & (F.col("l_y0") <= F.col("r_y1")) & (F.col("r_y0") <= F.col("l_y1"))
    first = F.col("l_ord") < F.col("r_ord")
    # Each pair in one cell and one order: the cell of the corner where they meet.
    corner = _cell(F.col("_level"), F.greatest("l_x0", "r_x0"), F.greatest("l_y0", "r_y0"))
    unique = F.when(F.col("_level") < 0, first).otherwise(((F.col("l_level") > F.col("r_level")) | ((F.col("l_level") == F.col("r_level")) & first)) & (corner["cx"] == F.col("_cx")) & (corner["cy"] == F.col("_cy")))
    pairs = left.join(right, ["plan_id", *(f"_{c}" for c in _CELL)]).where(meet & unique)
    pick = lambda p, c: F.when(first, F.col(f"{'l_' if p == 'a_' else 'r_'}{c}")).otherwise(F.col(f"{'r_' if p == 'a_' else 'l_'}{c}")).alias(f"{p}{c}")
    return pairs.select("plan_id", *(pick(p, c) for p in ("a_", "b_") for c in ("ord", *carried)))


def segment_box(a: Column, b: Column, wider: Column | float) -> list[Column]:
    """x0, y0, x1, y1 around a segment, wider on all sides."""
    out = []
    for name, f, sign in (("x0", F.least, -1), ("y0", F.least, -1), ("x1", F.greatest, 1), ("y1", F.greatest, 1)):
        w = F.lit(float(wider)) if isinstance(wider, (int, float)) else wider
        edge = f(a[name[0]], b[name[0]])
        out.append((edge - w if sign < 0 else edge + w).alias(name))
    return out
