"""Viewpoints, free space, adjacency and coverage."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.operators.cells import points_in_boxes, segment_box
from plumbline.operators.compile import Model
from plumbline.operators.findings import finding, union
from plumbline.plans.stages import settled

CAMERA_HEIGHT_M, HEIGHT_RANGE_M = 1.35, (0.5, 3.0)
WALL_MARGIN_M, OPENING_CLEARANCE_M = 0.35, 0.20
PULL_STEP_M, PULL_MAX_M = 0.05, 2.0
COLLINEAR_M = 0.02


def free_space(points: DataFrame, model: Model) -> DataFrame:
    """points: plan_id, room_id, point, polygon.  One row for each violation:
    code and what is violated.  Joins are by plan (and cell, in large plans), with
    the clearance as residual."""
    p = F.col("point")
    at = points.select("*", F.col("point.x").alias("px"), F.col("point.y").alias("py"))
    outside = points.where(~g.inside(p, F.col("polygon"))).select("plan_id", "room_id", F.lit("CAM_VIEWPOINT_OUTSIDE_ROOM").alias("code"), F.col("room_id").alias("source_ref"))
    wall = model.wall.select("plan_id", F.col("id").alias("source_ref"), "start", "end", "thickness_m", *segment_box(F.col("start"), F.col("end"), F.col("thickness_m") / 2 + WALL_MARGIN_M))
    near_wall = points_in_boxes(at, wall).where(g.segment_distance(p, F.col("start"), F.col("end")) < F.col("thickness_m") / 2 + WALL_MARGIN_M)
    opening = model.opening.select("plan_id", F.col("id").alias("source_ref"), "center", *segment_box(F.col("center"), F.col("center"), OPENING_CLEARANCE_M))
    near_opening = points_in_boxes(at, opening).where(g.length(p, F.col("center")) < OPENING_CLEARANCE_M)
    pick = lambda df, code: df.select("plan_id", "room_id", F.lit(code).alias("code"), "source_ref")
    return union([outside, pick(near_wall, "CAM_VIEWPOINT_COLLIDES_WALL"), pick(near_opening, "CAM_VIEWPOINT_COLLIDES_OPENING")])


def _push(px: float, py: float, walls, openings) -> tuple[float, float] | None:
    """Unit direction away from the violation with the smallest deficit; of equal
    ones the last counts (walls, then openings)."""
    least, away = math.inf, None
    for ax, ay, bx, by, need in walls:
        dx, dy = bx - ax, by - ay
        square = dx * dx + dy * dy
        t = 0.0 if square < 1e-12 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / square))
        nx, ny = px - (ax + t * dx), py - (ay + t * dy)
        d = math.hypot(nx, ny)
        if d < need and need - d <= least:
            least = need - d
            if d >= 1e-12:
                away = (nx / d, ny / d)
            elif square < 1e-12:
                away = (1.0, 0.0)
            else:
                size = math.hypot(dx, dy)
                away = (-dy / size, dx / size)
    for cx, cy in openings:
        d = math.hypot(px - cx, py - cy)
        if d < OPENING_CLEARANCE_M and OPENING_CLEARANCE_M - d <= least:
            least = OPENING_CLEARANCE_M - d
            away = ((px - cx) / d, (py - cy) / d) if d >= 1e-12 else (1.0, 0.0)
    return away


def _is_inside(px: float, py: float, ring) -> bool:
    odd = False
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
        dx, dy = bx - ax, by - ay
        square = dx * dx + dy * dy
        t = 0.0 if square < 1e-12 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / square))
        if math.hypot(px - (ax + t * dx), py - (ay + t * dy)) <= 1e-6:
            return False
        if (ay > py) != (by > py) and px < dx * (py - ay) / dy + ax:
            odd = not odd
    return odd


def pull_back(blocked: DataFrame, model: Model) -> DataFrame:
    """blocked: plan_id, room_id, point, polygon.  The point after at most 40
    steps away from what is too close; it ends early outside the room or 2 m
    away.  Rows travel with the walls and openings that a point can come near to on
    its way, so a task works on single rows."""
    reach = PULL_MAX_M + 2 * PULL_STEP_M
    at = blocked.select("plan_id", "room_id", F.col("point.x").alias("px"), F.col("point.y").alias("py"))
    need = F.col("thickness_m") / 2 + WALL_MARGIN_M
    walls = model.wall.select("plan_id", F.struct("ord", F.col("start.x").alias("ax"), F.col("start.y").alias("ay"), F.col("end.x").alias("bx"), F.col("end.y").alias("by"), need.alias("need")).alias("w"), *segment_box(F.col("start"), F.col("end"), need + reach))
    openings = model.opening.select("plan_id", F.struct("ord", F.col("center.x").alias("cx"), F.col("center.y").alias("cy")).alias("o"), *segment_box(F.col("center"), F.col("center"), OPENING_CLEARANCE_M + reach))
    near = lambda boxes, c, name: points_in_boxes(at, boxes).groupBy("plan_id", "room_id").agg(F.array_sort(F.collect_list(c)).alias(name))
    keys = ["plan_id", "room_id"]
    rows = blocked.select(*keys, "point", "polygon").join(near(walls, "w", "walls"), keys, "left").join(near(openings, "o", "openings"), keys, "left")

    def run(batches):
        for df in batches:
            out = []
            for r in df.itertuples(index=False):
                walls_ = [(w["ax"], w["ay"], w["bx"], w["by"], w["need"]) for w in (r.walls if r.walls is not None else [])]
                openings_ = [(o["cx"], o["cy"]) for o in (r.openings if r.openings is not None else [])]
                ring = [(p["x"], p["y"]) for p in r.polygon]
                ox, oy = x, y = r.point["x"], r.point["y"]
                for _ in range(math.ceil(PULL_MAX_M / PULL_STEP_M)):
                    if not _is_inside(x, y, ring) or (away := _push(x, y, walls_, openings_)) is None:
                        break
                    x, y = x + away[0] * PULL_STEP_M, y + away[1] * PULL_STEP_M
                    if math.hypot(x - ox, y - oy) > PULL_MAX_M:
                        break
                out.append((r.plan_id, r.room_id, {"x": x, "y": y}))
            yield pd.DataFrame(out, columns=["plan_id", "room_id", "point"])

    return rows.mapInPandas(run, "plan_id string, room_id string, point struct<x: double, y: double>")


def place_viewpoints(model: Model, height_m: float = CAMERA_HEIGHT_M) -> tuple[DataFrame, DataFrame]:
    """Viewpoints (plan_id, id, room_id, position, yaw_rad, camera_height_m) and
    findings: the centroid, or where it is pulled back to, else no viewpoint."""
    rooms = model.room.select("plan_id", F.col("id").alias("room_id"), "polygon").withColumn("point", g.centroid(F.col("polygon")))
    rooms = settled(rooms)
    keys = ["plan_id", "room_id"]
    blocked = settled(free_space(rooms, model).select(*keys).distinct())
    good = rooms.join(blocked, keys, "left_anti").select(*keys, "point")
    pulled = settled(pull_back(rooms.join(blocked, keys, "left_semi"), model).join(rooms.select(*keys, "polygon"), keys))
    still = free_space(pulled, model).select(*keys).distinct()
    placed = good.unionByName(pulled.join(still, keys, "left_anti").select(*keys, "point"))
    placed = settled(placed)
    number = F.row_number().over(Window.partitionBy("plan_id").orderBy("room_id")) - 1
    views = placed.withColumn("id", F.lpad(number.cast("string"), 4, "0")).select("plan_id", "id", "room_id", F.struct(F.col("point.x").alias("x"), F.col("point.y").alias("y"), F.lit(height_m).alias("z")).alias("position"), F.lit(0.0).alias("yaw_rad"), F.lit(height_m).alias("camera_height_m"))
    same = Window.partitionBy("plan_id", F.bround("position.x", 6), F.bround("position.y", 6)).orderBy("id")
    twice = views.withColumn("k", F.row_number().over(same)).where("k > 1")
    parts = [
        finding(rooms.join(placed.select(*keys), keys, "left_anti"), "CAM_UNCOVERED_ROOM", "room has zero valid viewpoint placements", F.col("room_id")),
        finding(twice, "CAM_DUPLICATE_ENTITY", "duplicate viewpoint position", F.col("id")),
    ]
    if not HEIGHT_RANGE_M[0] <= height_m <= HEIGHT_RANGE_M[1]:
        parts.append(finding(views.select("plan_id").distinct(), "CAM_CAMERA_HEIGHT_OUT_OF_RANGE", "camera height is out of range"))
    return views, union(parts)


def extrinsics(views: DataFrame) -> DataFrame:
    """views with the row-major camera-to-world matrix; the image's y is the
    world's -z."""
    c, s = F.cos("yaw_rad"), F.sin("yaw_rad")
    zero, one = F.lit(0.0), F.lit(1.0)
    row = lambda a, b, d, t: F.array(a, b, d, t)
    matrix = F.flatten(F.array(row(-c, zero, s, F.col("position.x")), row(-s, zero, -c, F.col("position.y")), row(zero, -one, zero, F.col("position.z")), row(zero, zero, zero, one)))
    return views.withColumn("matrix", matrix)


def extrinsics_text(views: DataFrame) -> DataFrame:
    """plan_id, id, text: four lines of four numbers with ten decimals."""
    line = lambda k: F.array_join(F.transform(F.slice("matrix", 4 * k + 1, 4), lambda v: F.format_string("%.10f", v)), " ")
    return extrinsics(views).select("plan_id", "id", F.concat(F.concat_ws("\n", *(line(k) for k in range(4))), F.lit("\n")).alias("text"))


def wall_in_edge(a, b, p, q):
    """The wall a-b lies within the edge p-q, with tolerance."""
    size = g.length(p, q)
    off = lambda v: F.coalesce(g.offset(v, p, q), g.length(p, v))
    t = lambda v: F.coalesce(g.along(v, p, q), F.lit(0.0))
    fits = lambda v: (off(v) <= COLLINEAR_M) & t(v).between(F.lit(-COLLINEAR_M), size + COLLINEAR_M)
    return fits(a) & fits(b)


def door_rooms(model: Model, views: DataFrame) -> DataFrame:
    """Doors with the covered rooms whose border holds their wall."""
    doors = model.opening.where("type = 'door'").select("plan_id", F.col("id").alias("door_id"), F.col("wall_id").alias("w"))
    wall = model.wall.groupBy("plan_id", F.col("id").alias("w")).agg(F.first("start").alias("a"), F.first("end").alias("b"))
    edges = model.room.select("plan_id", F.col("id").alias("room_id"), F.explode(g.ring_edges(F.col("polygon"))).alias("e")).join(views.select("plan_id", "room_id").distinct(), ["plan_id", "room_id"], "left_semi")
    used = wall.join(doors.select("plan_id", "w").distinct(), ["plan_id", "w"], "left_semi")
    boxes = edges.select("*", *segment_box(F.col("e.a"), F.col("e.b"), 2 * COLLINEAR_M))
    touching = points_in_boxes(used.select("*", F.col("a.x").alias("px"), F.col("a.y").alias("py")), boxes).where(wall_in_edge(F.col("a"), F.col("b"), F.col("e.a"), F.col("e.b")))
    rooms = touching.groupBy("plan_id", "w").agg(F.array_sort(F.collect_set("room_id")).alias("rooms"))
    return doors.join(rooms, ["plan_id", "w"], "left")


def adjacency(model: Model, views: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (plan_id, a, b, ord) between viewpoints through doors, and findings
    for doors that don't join just two covered rooms."""
    doors = door_rooms(model, views)
    two = F.coalesce(F.size("rooms") == 2, F.lit(False))
    at = lambda name: views.select("plan_id", F.col("room_id").alias(f"room_{name}"), F.col("id").alias(name))
    joined = doors.where(two).select("plan_id", "door_id", F.col("rooms")[0].alias("room_a"), F.col("rooms")[1].alias("room_b"))
    pairs = joined.join(at("a"), ["plan_id", "room_a"]).join(at("b"), ["plan_id", "room_b"])
    edges = pairs.groupBy("plan_id", "a", "b").agg(F.min("door_id").alias("first_door"))
    edges = edges.withColumn("ord", F.row_number().over(Window.partitionBy("plan_id").orderBy("first_door"))).select("plan_id", "a", "b", "ord")
    return edges, finding(doors.where(~two), "CAM_MAP_ADJACENCY_UNRESOLVED", "door does not resolve to two covered rooms", F.col("door_id"))


def start_viewpoints(views: DataFrame) -> DataFrame:
    return views.groupBy("plan_id").agg(F.min_by("id", "room_id").alias("start_viewpoint"))


def map_draft(views: DataFrame, edges: DataFrame) -> DataFrame:
    """plan_id, pos, key, values: neighbours of each viewpoint, the start first."""
    both = edges.select("plan_id", F.col("a").alias("key"), F.col("b").alias("value"), "ord").unionByName(edges.select("plan_id", F.col("b").alias("key"), F.col("a").alias("value"), "ord"))
    values = both.groupBy("plan_id", "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "value"))), lambda s: s["value"]).alias("values"))
    out = views.select("plan_id", F.col("id").alias("key")).join(values, ["plan_id", "key"], "left").join(start_viewpoints(views), "plan_id")
    pos = F.row_number().over(Window.partitionBy("plan_id").orderBy((F.col("key") != F.col("start_viewpoint")).cast("int"), "key"))
    return out.select("plan_id", pos.alias("pos"), "key", F.coalesce("values", F.array().cast("array<string>")).alias("values"))


def coverage_report(model: Model, views: DataFrame, edges: DataFrame, findings: DataFrame) -> DataFrame:
    rooms = model.room.groupBy("plan_id").agg(F.count("*").alias("rooms"))
    out = rooms.join(views.groupBy("plan_id").agg(F.count("*").alias("viewpoints")), "plan_id", "left").join(edges.groupBy("plan_id").agg(F.count("*").alias("edges")), "plan_id", "left")
    n = findings.groupBy("plan_id").agg(F.count_if(F.col("code") == "CAM_UNCOVERED_ROOM").alias("uncovered_rooms"), F.count_if(F.col("code") == "CAM_MAP_ADJACENCY_UNRESOLVED").alias("unresolved_doors"), F.count_if(F.col("code").startswith("CAM_VIEWPOINT_COLLIDES")).alias("collisions"))
    out = out.join(n, "plan_id", "left").fillna(0)
    return out.withColumn("every_room_covered", (F.col("uncovered_rooms") == 0) & (F.col("viewpoints") == F.col("rooms"))).withColumn("no_collision_errors", F.col("collisions") == 0)
