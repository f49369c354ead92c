"""White-model compilation and the checks of its topology."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions.numeric import QUANTUM_M
from plumbline.operators.findings import SPECS, finding, union
from plumbline.operators.cells import FAR_M, points_in_boxes, segment_box
from plumbline.operators.normalize import OPENING_OFFSET_M, Normalized, Normalizing
from plumbline.plans.stages import settled

WALL_THICKNESS_M, WALL_HEIGHT_M, CEILING_M = 0.10, 2.60, 2.60
DOOR = (2.10, 0.00)
WINDOW = (1.20, 0.90)
DEGENERATE_WALL_M, VERTEX_TOLERANCE_M, AREA_EPS = 0.05, 0.02, 1e-12
OPEN, FLAT, CROSSED = "room polygon has fewer than three distinct vertices", "room polygon has zero area", "room polygon self-intersects"

# Key, value, reason of each assumption.
ASSUMPTIONS = (
    ("wall_height_m", WALL_HEIGHT_M, "no height in the drawing"),
    ("wall_thickness_m", WALL_THICKNESS_M, "no thickness in the drawing"),
    ("ceiling_z_m", CEILING_M, "no ceiling height in the drawing"),
    ("floor_z_m", 0.0, "single storey"),
    ("door_height_m", DOOR[0], "no door height in the drawing"),
    ("door_sill_m", DOOR[1], "doors start at the floor"),
    ("window_height_m", WINDOW[0], "no window height in the drawing"),
    ("window_sill_m", WINDOW[1], "no sill height in the drawing"),
)


@dataclass(frozen=True)
class Model:
    wall: DataFrame
    room: DataFrame
    opening: DataFrame


def derived_id(kind: str, of) -> F.Column:
    """gw-, gr-, go- and 12 hex digits of the hash of the parse id."""
    return F.concat(F.lit(f"g{kind[0]}-"), F.substring(F.sha2(F.concat(F.lit(f"geom-{kind}|"), of), 256), 1, 12))


def compile_model(n: Normalizing | Normalized, thickness: DataFrame | None = None) -> Model:
    """thickness: plan_id, id, thickness_m of walls that have one."""
    wall = n.wall.select("plan_id", "ord", F.col("id").alias("parse_id"), F.col("start_m").alias("start"), F.col("end_m").alias("end"))
    if thickness is not None:
        wall = wall.join(thickness.withColumnRenamed("id", "parse_id"), ["plan_id", "parse_id"], "left")
    else:
        wall = wall.withColumn("thickness_m", F.lit(None).cast("double"))
    wall = wall.select("plan_id", "ord", derived_id("wall", F.col("parse_id")).alias("id"), "parse_id", "start", "end", F.coalesce("thickness_m", F.lit(WALL_THICKNESS_M)).alias("thickness_m"), F.lit(WALL_HEIGHT_M).alias("height_m"))
    room = n.room.select("plan_id", "ord", derived_id("room", F.col("id")).alias("id"), F.col("ring_m").alias("polygon"), F.lit(0.0).alias("floor_z_m"), F.lit(CEILING_M).alias("ceiling_z_m"))
    host = wall.groupBy("plan_id", F.col("parse_id").alias("wall_id")).agg(F.first("thickness_m").alias("host_thickness"))
    door = F.col("type") == "door"
    opening = n.opening.join(host, ["plan_id", "wall_id"], "left").select(
        "plan_id",
        "ord",
        derived_id("opening", F.col("id")).alias("id"),
        "type",
        derived_id("wall", F.col("wall_id")).alias("wall_id"),
        F.col("center_m").alias("center"),
        "width_m",
        F.when(door, DOOR[0]).otherwise(WINDOW[0]).alias("height_m"),
        F.when(door, DOOR[1]).otherwise(WINDOW[1]).alias("sill_m"),
        F.coalesce("host_thickness", F.lit(WALL_THICKNESS_M)).alias("depth_m"),
    )
    return settled(Model(wall, room, opening))


def assumptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ASSUMPTIONS), "key string, value double, reason string")


def id_collisions(model: Model) -> DataFrame:
    parts = [finding(t.groupBy("plan_id", "id").count().where("count > 1"), "GEOM_DUPLICATE_ENTITY", f"derived geometry {k} id collision", F.col("id")) for k, t in (("wall", model.wall), ("room", model.room), ("opening", model.opening))]
    return union(parts)


def wall_ends(wall: DataFrame) -> DataFrame:
    return wall.select("plan_id", "id", F.explode(F.array("start", "end")).alias("p"))


def near_cells(p, tolerance: float):
    """The cells of a grid that hold all points within `tolerance` of p."""
    cell = lambda v, k: (F.floor(v / F.lit(tolerance)) + k).alias("c")
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct(cell(p["x"], i).alias("x"), cell(p["y"], j).alias("y")))))


def loose_walls(wall: DataFrame, room: DataFrame, tolerance: float = VERTEX_TOLERANCE_M) -> DataFrame:
    """Walls with an end that is on no room's vertex: an anti-join that is an
    equi-join by plan and grid cell (each end looks into nine cells)."""
    corner = room.select("plan_id", F.explode("polygon").alias("v")).distinct()
    corner = corner.select("plan_id", "v", F.floor(F.col("v.x") / tolerance).alias("cx"), F.floor(F.col("v.y") / tolerance).alias("cy"))
    ends = wall_ends(wall).withColumn("cell", F.explode(near_cells(F.col("p"), tolerance)))
    ends = ends.select("plan_id", "id", "p", F.col("cell.x").alias("cx"), F.col("cell.y").alias("cy"))
    close = (F.abs(F.col("p.x") - F.col("v.x")) <= tolerance) & (F.abs(F.col("p.y") - F.col("v.y")) <= tolerance)
    found = ends.join(corner, ["plan_id", "cx", "cy"]).where(close).select("plan_id", "id", "p").distinct()
    return wall_ends(wall).distinct().join(found, ["plan_id", "id", "p"], "left_anti").select("plan_id", "id").distinct()


def unsupported_edges(wall: DataFrame, room: DataFrame) -> DataFrame:
    """Room edges that lie within no wall (one row for each edge)."""
    edges = room.select("plan_id", "id", F.posexplode(g.ring_edges(F.col("polygon"))).alias("k", "e"))
    # A wall without a length holds any point.
    point = (F.col("start.x") == F.col("end.x")) & (F.col("start.y") == F.col("end.y"))
    wider = F.when(point, F.lit(FAR_M)).otherwise(F.lit(2 * OPENING_OFFSET_M))
    w = wall.select("plan_id", F.col("start").alias("a"), F.col("end").alias("b"), *segment_box(F.col("start"), F.col("end"), wider))
    n = g.length(F.col("a"), F.col("b"))
    starts = edges.select("*", F.col("e.a.x").alias("px"), F.col("e.a.y").alias("py"))
    holds = lambda p: (F.coalesce(g.offset(p, F.col("a"), F.col("b")), F.lit(0.0)) <= OPENING_OFFSET_M) & F.coalesce(g.along(p, F.col("a"), F.col("b")), F.lit(0.0)).between(F.lit(-QUANTUM_M), n + QUANTUM_M)
    held = points_in_boxes(starts, w).where(holds(F.col("e.a")) & holds(F.col("e.b"))).select("plan_id", "id", "k").distinct()
    return edges.join(held, ["plan_id", "id", "k"], "left_anti")


def validate_topology(m: Model) -> DataFrame:
    """Findings of the geometry stage, one for each defect (not made distinct)."""
    ref = F.col("id")
    # The first fault of each ring, by one pass over the rooms.
    fault = g.bound(
        g.distinct_vertices(F.col("polygon"), VERTEX_TOLERANCE_M),
        lambda ring: F.when(F.size(ring) < 3, OPEN)
        .when(F.abs(g.twice_area(ring, "double", "double") / 2) <= AREA_EPS, FLAT)
        .when(g.self_touching(ring, g.tolerant_touch(QUANTUM_M)), CROSSED),
    )
    rooms = m.room.select("plan_id", "id", F.explode(F.array_compact(F.array(fault))).alias("fault"))
    code = F.when(F.col("fault") == OPEN, "GEOM_OPEN_POLYGON").otherwise("GEOM_SELF_INTERSECTING_POLYGON")
    severity, tier = SPECS["GEOM_OPEN_POLYGON"]  # those of both
    parts = [
        rooms.select("plan_id", code.alias("code"), F.lit(severity).alias("severity"), F.lit(tier).alias("tier"), ref.cast("string").alias("source_ref"), F.col("fault").alias("message")),
        finding(m.wall.where(g.length(F.col("start"), F.col("end")) < DEGENERATE_WALL_M), "GEOM_DEGENERATE_WALL", "wall is shorter than the minimum length", ref),
        finding(loose_walls(m.wall, m.room), "GEOM_OPEN_ROOM_BOUNDARY", "wall endpoints do not coincide with any room boundary", ref),
        finding(unsupported_edges(m.wall, m.room), "GEOM_OPEN_ROOM_BOUNDARY", "room edge has no supporting wall", ref),
    ]
    host = m.wall.groupBy("plan_id", F.col("id").alias("wall_id")).agg(F.first("start").alias("a"), F.first("end").alias("b"), F.first("height_m").alias("host_height"))
    o = m.opening.join(host, ["plan_id", "wall_id"], "left")
    off = F.coalesce(g.offset(F.col("center"), F.col("a"), F.col("b")), F.lit(0.0))
    t, n = F.coalesce(g.along(F.col("center"), F.col("a"), F.col("b")), F.lit(0.0)), g.length(F.col("a"), F.col("b"))
    known, half = F.col("a").isNotNull(), F.col("width_m") / 2
    parts += [
        finding(o.where(~known), "GEOM_OPENING_UNRESOLVED_WALL", "opening references an unknown wall", ref),
        finding(o.where(known & (off > OPENING_OFFSET_M)), "GEOM_OPENING_OFF_WALL", "opening centre is off its host wall", ref),
        finding(o.where(known & ((t - half < -QUANTUM_M) | (t + half > n + QUANTUM_M))), "GEOM_OPENING_WIDTH_EXCEEDS_WALL", "opening span does not fit within its host wall", ref),
        finding(o.where(known & (F.col("sill_m") + F.col("height_m") > F.col("host_height") + QUANTUM_M)), "GEOM_OPENING_ABOVE_WALL", "opening rises above the host wall", ref),
    ]
    return union([*parts, id_collisions(m)])


def topology_report(model: Model, findings: DataFrame) -> DataFrame:
    """Counts and checks of each plan."""
    count = lambda t, name, cond=None: t.groupBy("plan_id").agg((F.count("*") if cond is None else F.count_if(cond)).alias(name))
    out = count(model.wall, "walls").join(count(model.room, "rooms"), "plan_id", "full")
    for part in (count(model.opening, "doors", F.col("type") == "door"), count(model.opening, "windows", F.col("type") == "window"), count(findings, "errors", F.col("severity") == "error"), count(findings, "warnings", F.col("severity") == "warn")):
        out = out.join(part, "plan_id", "full")
    out = out.fillna(0)
    return out.withColumn("closed", F.col("errors") == 0)
