"""The exact route: walls (also arcs), rooms and openings of drawings in millimetres,
with thickness from extended data, for comparison with truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import arcs, geometry as g
from plumbline.operators.evaluator import supported
from plumbline.sources import dxf
from plumbline.sources.tables import Plans

QUANTUM_MM, OFFSET_MM, SAGITTA_PX, MM_PER_PX = 0.01, 20.0, 0.5, 5.0


def rounded(c):
    return F.bround(c.cast("double") / QUANTUM_MM, 0) * QUANTUM_MM


def walls(files: DataFrame, prefix: str = "PLAN", app: str = "PLAN") -> DataFrame:
    """plan_id, idx, id, kind, a, b, center, radius_mm, start_deg, end_deg, sweep,
    bulge, segments, thickness_mm of each wall, in the order of the drawing."""
    t = dxf.tags(files)
    e = dxf.entities(t).where(F.col("layer") == f"{prefix}-WALL").where("paper = 0 and kind in ('LINE', 'ARC')").join(dxf.units(t), "plan_id")
    k = F.col("unit_scale_m") * 1000.0
    at = lambda x, y: F.struct(rounded(F.get(x, F.lit(0)) * k).alias("x"), rounded(F.get(y, F.lit(0)) * k).alias("y"))
    arc = F.col("kind") == "ARC"
    start, end, r = F.get("c50", F.lit(0)), F.get("c51", F.lit(0)), F.get("c40", F.lit(0)) * k
    theta = F.radians(arcs.swept_degrees(start, end, F.lit("ccw")))
    full = F.coalesce(arc & ((F.abs(end - start) >= 360) | ~arcs.bounded(r, start, end)), F.lit(False))
    n = F.row_number().over(Window.partitionBy("plan_id").orderBy("entity_no")) - 1
    out = e.where(~full).withColumn("idx", n)
    only = lambda c: F.when(arc, c)
    return out.select(
        "plan_id",
        F.col("idx").cast("int").alias("idx"),
        F.format_string("w-%04d", F.col("idx")).alias("id"),
        F.when(arc, "circular_arc").otherwise("segment").alias("kind"),
        F.when(~arc, at("c10", "c20")).alias("a"),
        F.when(~arc, at("c11", "c21")).alias("b"),
        only(at("c10", "c20")).alias("center"),
        only(rounded(r)).alias("radius_mm"),
        only(start).alias("start_deg"),
        only(end).alias("end_deg"),
        only(F.lit("ccw")).alias("sweep"),
        only(arcs.bulge(theta, F.lit("ccw"))).alias("bulge"),
        only(arcs.segments(r, theta, SAGITTA_PX, MM_PER_PX)).alias("segments"),
        only(F.lit(SAGITTA_PX)).alias("max_sagitta_px"),
        (dxf.thickness(F.col("tags"), app) * 1000.0).alias("thickness_mm"),
    )


def hosts(openings: DataFrame, wall: DataFrame) -> DataFrame:
    """openings: plan_id, idx, span (two points, mm).  The first wall whose line both
    ends of the span are on (else its centre); arcs by their radius."""
    o = openings.withColumn("p", F.col("span")[0]).withColumn("q", F.col("span")[1])
    mid = F.struct(((F.col("p.x") + F.col("q.x")) / 2).alias("x"), ((F.col("p.y") + F.col("q.y")) / 2).alias("y"))
    w = wall.select("plan_id", F.col("idx").alias("w_idx"), F.col("id").alias("wall_id"), "kind", F.col("a").alias("w_a"), F.col("b").alias("w_b"), "center", "radius_mm")
    off = lambda p: F.when(F.col("w_a").isNotNull(), g.offset(p, F.col("w_a"), F.col("w_b"))).otherwise(F.abs(g.length(F.col("center"), p) - F.col("radius_mm")))
    fits = F.coalesce((off(F.col("p")) <= OFFSET_MM) & (off(F.col("q")) <= OFFSET_MM), F.lit(False)) | F.coalesce(off(mid) <= OFFSET_MM, F.lit(False))
    found = o.join(w, "plan_id").where(fits).groupBy("plan_id", "idx").agg(F.min_by("wall_id", "w_idx").alias("wall_id"))
    return openings.join(found, ["plan_id", "idx"], "left")


def records(wall: DataFrame) -> DataFrame:
    """Walls as the evaluator compares them: kind and geometry, ends in order."""
    a, b = F.least("a", "b"), F.greatest("a", "b")
    return wall.select("plan_id", F.col("idx").alias("ord"), "kind", a.alias("a_mm"), b.alias("b_mm"), F.col("center").alias("center_mm"), "radius_mm", "start_deg", "end_deg", supported(F.col("kind"), F.col("max_sagitta_px"), F.lit(None).cast("double")).alias("supported"))


def parse(files: DataFrame, prefix: str = "PLAN", app: str = "PLAN") -> tuple[DataFrame, Plans]:
    """Walls in millimetres, and the plan tables of the exact convention."""
    return walls(files, prefix, app), dxf.parse(files, prefix, exact=True)
