"""Normalisation: raw plans to canonical metric geometry with content ids.

Inputs are tables keyed by plan_id (see plumbline.sources.tables).  Coordinates
become grid points (bigint, 1e-4 m); every plan is moved so that its walls'
smallest x and y are zero.  What can't be normalised is a finding, not an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions.numeric import GRID, QUANTUM_M, content_id, grid, key_text, metres, quantised
from plumbline.operators.cells import points_in_boxes, segment_box
from plumbline.operators.findings import finding, union
from plumbline.plans.stages import settled
from plumbline.sources.tables import Plans

MAX_COORDINATE_M = 100_000
OPENING_OFFSET_M = 0.02
DIMENSION_TIE_M = 1e-4
PENDING = "__dxf_probe__"


@dataclass(frozen=True)
class Normalized:
    """Normalised plans as tables that are written (see Normalizing)."""

    frame: DataFrame
    wall: DataFrame
    room: DataFrame
    opening: DataFrame
    dimension: DataFrame
    normalization: DataFrame
    finding: DataFrame


def _metric(p: Column) -> Column:
    """A raw point on the grid; rasters count y from the top."""
    y = F.when(F.col("y_down"), F.col("height_px") - p["y"]).otherwise(p["y"])
    return g.point(grid(p["x"], F.col("unit_scale_m")), grid(y, F.col("unit_scale_m")))


def _moved(p: Column) -> Column:
    return g.point(p["x"] - F.col("tx"), p["y"] - F.col("ty"))


def _bad(p: Column) -> Column:
    far = lambda c: F.coalesce(F.abs(p[c]) > MAX_COORDINATE_M * GRID, F.lit(True))
    return far("x") | far("y")


def on_metres(p: Column) -> Column:
    return g.point(metres(p["x"]), metres(p["y"]))


def wall_id(start: Column, end: Column) -> Column:
    return content_id("w", F.lit("wall"), *(key_text(p[c]) for p in (start, end) for c in ("x", "y")))


def room_id(ring: Column) -> Column:
    coordinates = F.flatten(F.transform(ring, lambda p: F.array(key_text(p["x"]), key_text(p["y"]))))
    return content_id("r", F.lit("room"), F.array_join(coordinates, "|"))


def opening_id(kind: Column, wall: Column, center: Column, width: Column) -> Column:
    return content_id("o", F.lit("opening"), kind, F.coalesce(wall, F.lit("__pending__")), key_text(center["x"]), key_text(center["y"]), key_text(width))


def resolve_walls(openings: DataFrame, walls: DataFrame) -> DataFrame:
    """Openings (plan_id, key, center, span in metres) with the number of walls
    that fit and the first's id: an equi-join by plan (and cell, in large plans), a
    residual condition, and one aggregation that is partial before the shuffle."""
    w = walls.select("plan_id", F.col("id").alias("w_id"), F.col("start_m").alias("w_a"), F.col("end_m").alias("w_b"), *segment_box(F.col("start_m"), F.col("end_m"), 2 * OPENING_OFFSET_M))
    t, n = g.along(F.col("center_m"), F.col("w_a"), F.col("w_b")), g.length(F.col("w_a"), F.col("w_b"))
    fits = (g.offset(F.col("center_m"), F.col("w_a"), F.col("w_b")) <= OPENING_OFFSET_M) & t.between(F.lit(-QUANTUM_M), n + QUANTUM_M)
    fits &= F.col("span_m").isNull() | F.forall("span_m", lambda p: g.offset(p, F.col("w_a"), F.col("w_b")) <= OPENING_OFFSET_M)
    keys = openings.select("plan_id", "idx", "center_m", "span_m", F.col("center_m.x").alias("px"), F.col("center_m.y").alias("py"))
    found = points_in_boxes(keys, w).where(fits).groupBy("plan_id", "idx").agg(F.count("*").alias("n_walls"), F.min("w_id").alias("found_wall"))
    return openings.join(found, ["plan_id", "idx"], "left").fillna(0, ["n_walls"])


class Normalizing:
    """A plan's tables, each made when it is asked for; settled() makes them all.
    What more than one of the others reads is settled on its first use."""

    def __init__(self, plans: Plans) -> None:
        self.plans, self.frame = plans, plans.frame
        self._scale = self.frame.select("plan_id", F.col("kind").alias("frame_kind"), "unit_scale_m", "y_down", "height_px")
        self._source = F.when(F.col("frame_kind") == "dxf", F.lit("dxf")).otherwise(F.lit("annotation")).alias("source_kind")

    def settled(self) -> Normalized:
        wall = self.__dict__["_wall"] = settled(self._wall)
        room, opening = settled((self._room, self._opening))
        self.__dict__.update(_room=room, _opening=opening)
        for name in ("wall", "room", "opening", "finding"):
            self.__dict__.pop(name, None)
        self.__dict__["_settled_wall"] = wall
        return settled(Normalized(*(getattr(self, f) for f in Normalized.__dataclass_fields__)))

    @cached_property
    def _raw_walls(self) -> DataFrame:
        walls = self.plans.wall.join(self._scale, "plan_id").withColumn("a", _metric(F.col("start"))).withColumn("b", _metric(F.col("end")))
        walls = walls.withColumn("bad", _bad(F.col("a")) | _bad(F.col("b")))
        walls = walls.withColumn("first", F.least(F.col("a"), F.col("b"))).withColumn("b", F.greatest(F.col("a"), F.col("b"))).withColumn("a", F.col("first"))
        return walls

    @cached_property
    def _anchor(self) -> DataFrame:
        return self._raw_walls.groupBy("plan_id").agg(F.min(F.least("a.x", "b.x")).alias("tx"), F.min(F.least("a.y", "b.y")).alias("ty"))

    @cached_property
    def _moving(self) -> DataFrame:
        return self._scale.join(self._anchor, "plan_id")

    @cached_property
    def _wall(self) -> DataFrame:
        plan = Window.partitionBy("plan_id")
        walls = self._raw_walls.withColumn("tx", F.min(F.least("a.x", "b.x")).over(plan)).withColumn("ty", F.min(F.least("a.y", "b.y")).over(plan))
        walls = walls.withColumn("start_g", _moved(F.col("a"))).withColumn("end_g", _moved(F.col("b")))
        walls = walls.withColumn("bad", F.col("bad") | _bad(F.col("start_g")) | _bad(F.col("end_g")))
        walls = walls.withColumn("ord", F.row_number().over(plan.orderBy("start_g", "end_g", "idx")))
        return walls.select("plan_id", "idx", wall_id(F.col("start_g"), F.col("end_g")).alias("id"), "start_g", "end_g", on_metres(F.col("start_g")).alias("start_m"), on_metres(F.col("end_g")).alias("end_m"), "source_ref", self._source, "bad", "frame_kind", "ord")

    @cached_property
    def _settled_wall(self) -> DataFrame:
        return settled(self._wall)

    @cached_property
    def _room(self) -> DataFrame:
        rooms = self.plans.room.join(self._moving, "plan_id").withColumn("ring", F.transform("polygon", lambda p: _moved(_metric(p))))
        rooms = rooms.withColumn("bad", F.exists("ring", _bad)).withColumn("ring_g", g.canonical_ring(g.without_closing(F.col("ring"))))
        room = rooms.select("plan_id", "idx", room_id(F.col("ring_g")).alias("id"), "ring_g", F.transform("ring_g", on_metres).alias("ring_m"), "source_ref", self._source, "bad", "frame_kind")
        return room.withColumn("ord", F.row_number().over(Window.partitionBy("plan_id").orderBy("ring_g", "source_ref", "idx")))

    @cached_property
    def _opening(self) -> DataFrame:
        wall = self._settled_wall
        openings = self.plans.opening.join(self._moving, "plan_id").withColumn("center_g", _moved(_metric(F.col("center"))))
        openings = openings.withColumn("span_g", F.transform("span", lambda p: _moved(_metric(p))))
        openings = openings.withColumn("center_m", on_metres(F.col("center_g"))).withColumn("span_m", F.transform("span_g", on_metres))
        openings = resolve_walls(openings, wall)
        by_index = wall.select("plan_id", F.col("idx").alias("wall_index"), F.col("id").alias("index_wall"))
        openings = openings.join(by_index, ["plan_id", "wall_index"], "left")
        missing = F.concat(F.lit("__missing_wall_index__:"), F.col("wall_index").cast("string"))
        host = F.when(F.col("wall_index").isNotNull(), F.coalesce("index_wall", missing)).when(F.col("n_walls") == 1, F.col("found_wall")).otherwise(F.lit(PENDING))
        openings = openings.withColumn("wall_id", host)
        ends = wall.groupBy("plan_id", "id").agg(F.first("start_m").alias("h_a"), F.first("end_m").alias("h_b")).withColumnRenamed("id", "wall_id")
        openings = openings.join(ends, ["plan_id", "wall_id"], "left")
        t = lambda k: g.along(F.element_at("span_m", k), F.col("h_a"), F.col("h_b"))
        width = F.coalesce(F.when(F.size("span_m") == 2, quantised(F.abs(t(2) - t(1)))), quantised(F.col("width_m")))
        openings = openings.withColumn("width_g", width).withColumn("bad", _bad(F.col("center_g")))
        sound = F.coalesce((F.col("width_m") > 0) & ~F.isnan("width_m") & (F.abs("width_m") < float("inf")) & (F.col("width_g") > 0), F.lit(False))
        openings = openings.withColumn("bad_width", ~sound)
        opening = openings.select("plan_id", "idx", opening_id(F.col("kind"), F.col("wall_id"), F.col("center_g"), F.col("width_g")).alias("id"), F.col("kind").alias("type"), "wall_id", "center_g", "width_g", "center_m", "span_m", metres(F.col("width_g")).alias("width_m"), "n_walls", "source_ref", self._source, "bad", "bad_width", "frame_kind")
        return opening.withColumn("ord", F.row_number().over(Window.partitionBy("plan_id").orderBy("center_g", "width_g", "type", "wall_id", "idx")))

    @cached_property
    def dimension(self) -> DataFrame:
        return self.plans.dimension.join(self._moving, "plan_id").select("plan_id", "idx", on_metres(_moved(_metric(F.col("a")))).alias("a_m"), on_metres(_moved(_metric(F.col("b")))).alias("b_m"), metres(quantised(F.col("declared_length_m"))).alias("declared_m"), "frame_kind")

    @cached_property
    def normalization(self) -> DataFrame:
        return self.frame.join(self._anchor, "plan_id", "left").select(
            "plan_id",
            F.lit(QUANTUM_M).alias("quantum_m"),
            "source_units",
            F.col("unit_scale_m").alias("source_unit_scale_m"),
            F.array(metres(F.col("tx")), metres(F.col("ty"))).alias("translation_m"),
            F.when(F.col("y_down"), F.lit("flipped_from_raster")).otherwise(F.lit("up")).alias("y_axis"),
            F.col("height_px").alias("source_height_px"),
            F.when(F.col("y_down"), F.col("unit_scale_m")).alias("scale_m_per_px"),
        )

    @cached_property
    def finding(self) -> DataFrame:
        limits = [finding(t_.where("bad"), "PARSE_RESOURCE_LIMIT", "normalized coordinates exceed configured bounds", F.col("source_ref")) for t_ in (self._wall, self._room, self._opening)]
        limits.append(finding(self._opening.where("bad_width"), "PARSE_RESOURCE_LIMIT", "opening width must be finite and positive", F.col("source_ref")))
        return union(limits)

    # Confidence: 1.0 for drawings.  On rasters 0.9 for what a consistent declared
    # dimension ties (walls by both ends, rooms by two vertices), else 0.6; openings
    # take their wall's.

    @cached_property
    def _good(self) -> DataFrame:
        measured = g.length(F.col("a_m"), F.col("b_m"))
        fits = F.abs(measured - F.col("declared_m")) <= F.greatest(F.lit(0.02), F.abs("declared_m") * 0.01)
        return self.dimension.where((F.col("frame_kind") == "raster") & fits).select("plan_id", "a_m", "b_m")

    @cached_property
    def wall(self) -> DataFrame:
        a, b = F.col("d.a_m"), F.col("d.b_m")
        w = self._wall.select("plan_id", "id", "start_m", "end_m").alias("w").join(self._good.alias("d"), "plan_id")
        w = w.where((_same(F.col("w.start_m"), a) & _same(F.col("w.end_m"), b)) | (_same(F.col("w.start_m"), b) & _same(F.col("w.end_m"), a)))
        return _tied(self._wall, w)

    @cached_property
    def room(self) -> DataFrame:
        a, b = F.col("d.a_m"), F.col("d.b_m")
        r = self._room.select("plan_id", "id", "ring_m").alias("r").join(self._good.alias("d"), "plan_id")
        r = r.where(F.exists("r.ring_m", lambda p: _same(p, a)) & F.exists("r.ring_m", lambda p: _same(p, b)))
        return _tied(self._room, r)

    @cached_property
    def opening(self) -> DataFrame:
        by_wall = self.wall.groupBy("plan_id", "id").agg(F.max("confidence").alias("wall_confidence")).withColumnRenamed("id", "wall_id")
        opening = self._opening.join(by_wall, ["plan_id", "wall_id"], "left")
        return opening.withColumn("confidence", F.when(F.col("frame_kind") != "raster", F.lit(1.0)).otherwise(F.coalesce("wall_confidence", F.lit(0.6)))).drop("wall_confidence")


def _same(p: Column, q: Column) -> Column:
    return (F.abs(p["x"] - q["x"]) <= DIMENSION_TIE_M) & (F.abs(p["y"] - q["y"]) <= DIMENSION_TIE_M)


def _tied(t: DataFrame, found: DataFrame) -> DataFrame:
    value = F.when(F.col("frame_kind") != "raster", F.lit(1.0)).when(F.col("tied").isNotNull(), F.lit(0.9)).otherwise(F.lit(0.6)).alias("confidence")
    return t.join(found.select("plan_id", "id").distinct().withColumn("tied", F.lit(True)), ["plan_id", "id"], "left").select(*t.columns, value)


def normalize(plans: Plans) -> Normalizing:
    """Tables with the names of Normalized's fields, made as they are asked for."""
    return Normalizing(plans)


def projection(n: Normalizing | Normalized) -> DataFrame:
    """What is equal for any two sources of one plan: units, rooms, walls and
    openings in order, as one JSON text for each plan (see functions.canonical)."""
    from plumbline.functions.canonical import canonical_hash

    xy = lambda p: F.array(p["x"], p["y"])
    ordered = lambda t, value, name: t.groupBy("plan_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", value.alias("v")))), lambda s: s["v"]).alias(name))
    rooms = ordered(n.room, F.transform("ring_m", xy), "rooms")
    walls = ordered(n.wall, F.array(xy(F.col("start_m")), xy(F.col("end_m"))), "walls")
    openings = ordered(n.opening, F.struct(F.col("type").alias("a"), F.col("wall_id").alias("b"), xy(F.col("center_m")).alias("c"), F.col("width_m").alias("d")), "openings")
    out = n.frame.select("plan_id").join(rooms, "plan_id", "left").join(walls, "plan_id", "left").join(openings, "plan_id", "left")
    return out.select("plan_id", canonical_hash(F.struct("rooms", "walls", "openings")).alias("projection_hash"))
