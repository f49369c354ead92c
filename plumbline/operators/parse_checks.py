"""Checks of normalised plans: every defect is a row of findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions.numeric import GRID, QUANTUM_M, metres
from plumbline.operators.cells import meeting_boxes
from plumbline.operators.findings import finding, union
from plumbline.operators.normalize import MAX_COORDINATE_M, OPENING_OFFSET_M, PENDING, Normalized, Normalizing
from plumbline.plans.stages import settled

DEGENERATE_WALL_M, LOW_CONFIDENCE, MAX_VERTICES = 0.05, 0.5, 10_000
LIMITS = {"wall": 20_000, "room": 5_000, "opening": 20_000}


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """All but the first row of each key, within the plan."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy("plan_id", *key).orderBy("ord"))).where("n > 1").drop("n")


def ring_faults(room: DataFrame) -> DataFrame:
    """Rooms with the code and message of their ring's first fault, if any."""
    ring, n = F.col("ring_g"), F.size("ring_g")
    repeats = F.size(F.array_distinct(ring)) != n
    beside = F.exists(F.slice(g.ring_edges(ring), 1, F.greatest(n - 1, F.lit(0))), lambda e: e["a"] == e["b"])
    say = lambda code, message: F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"))
    fault = (
        F.when(n > MAX_VERTICES, say("PARSE_RESOURCE_LIMIT", "room polygon exceeds configured vertex limit"))
        .when(n < 3, say("PARSE_OPEN_POLYGON", "room polygon needs at least 3 vertices"))
        .when(repeats & beside, say("PARSE_OPEN_POLYGON", "room polygon repeats a vertex"))
        .when(repeats, say("PARSE_SELF_INTERSECTING_POLYGON", "room polygon repeats a vertex"))
        .when(g.twice_area(ring) == 0, say("PARSE_SELF_INTERSECTING_POLYGON", "room polygon has zero area"))
        .when((n > 3) & g.self_touching(ring), say("PARSE_SELF_INTERSECTING_POLYGON", "room polygon self-intersects"))
    )
    return room.withColumn("fault", fault)


def crossing_rooms(room: DataFrame) -> DataFrame:
    """Pairs of rooms of one plan whose borders cross: a join of boxes that meet,
    which loses no crossing, then of their edges, one by one in generated code."""
    box = lambda f, c: f(F.transform("ring_g", lambda p: p[c]))
    limit = MAX_COORDINATE_M * GRID
    # Within the bounds, products of differences are below 2**62: exact as integers.
    plain = F.forall("ring_g", lambda p: (F.abs(p["x"]) <= limit) & (F.abs(p["y"]) <= limit))
    r = room.where(F.size("ring_g") > 0).select("plan_id", "ord", "source_ref", "ring_g", g.ring_edges(F.col("ring_g")).alias("edges"), plain.alias("plain"), *(metres(box(f, c)).alias(f"{c}{k}") for k, f in enumerate((F.array_min, F.array_max)) for c in "xy"))
    pairs = meeting_boxes(settled(r), "source_ref", "ring_g", "edges", "plain").where(F.col("a_ring_g") != F.col("b_ring_g"))
    pairs = pairs.select("plan_id", "a_ord", "b_ord", F.least("a_source_ref", "b_source_ref").alias("source_ref"), (F.col("a_plain") & F.col("b_plain")).alias("plain"), "b_edges", F.explode("a_edges").alias("e"))
    pairs = pairs.select("plan_id", "a_ord", "b_ord", "source_ref", "plain", "e", F.explode("b_edges").alias("f"))
    e, f = F.col("e"), F.col("f")
    crosses = F.when(F.col("plain"), g.proper_cross(e, f, "bigint")).otherwise(g.proper_cross(e, f))
    found = pairs.where(g.boxes_meet(e, f) & crosses)
    return found.select("plan_id", "a_ord", "b_ord", "source_ref").distinct().select("plan_id", "source_ref")


def degenerate_walls(wall: DataFrame) -> DataFrame:
    short = g.length(F.col("start_m"), F.col("end_m")) < DEGENERATE_WALL_M
    return finding(wall.where(short), "PARSE_DEGENERATE_WALL", "wall is shorter than minimum", F.col("source_ref"))


def dimension_faults(dimension: DataFrame) -> DataFrame:
    gap = F.abs(g.length(F.col("a_m"), F.col("b_m")) - F.col("declared_m"))
    wrong = dimension.where(gap > F.greatest(F.lit(0.02), F.abs("declared_m") * 0.01))
    return finding(wrong, "PARSE_DIMENSION_INCONSISTENT", "declared dimension differs from measured geometry")


def opening_faults(opening: DataFrame, wall: DataFrame) -> DataFrame:
    """Openings with the code of what is wrong with their wall, if anything.
    A declared wall that fits is taken, whatever else is near."""
    declared = (F.col("wall_id") != PENDING) | (F.col("source_kind") != "dxf")
    ends = wall.groupBy("plan_id", "id").agg(F.first("start_m").alias("a"), F.first("end_m").alias("b"))
    # The wall to test: the declared one, or the only one that fits.
    by_id = opening.join(ends.withColumnRenamed("id", "wall_id"), ["plan_id", "wall_id"], "left")
    t, n = g.along(F.col("center_m"), F.col("a"), F.col("b")), g.length(F.col("a"), F.col("b"))
    off = g.offset(F.col("center_m"), F.col("a"), F.col("b")) > OPENING_OFFSET_M
    skew = F.col("span_m").isNotNull() & F.exists("span_m", lambda p: g.offset(p, F.col("a"), F.col("b")) > OPENING_OFFSET_M)
    wide = (t < F.col("width_m") / 2 - QUANTUM_M) | (n - t < F.col("width_m") / 2 - QUANTUM_M)
    say = lambda code, message: F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"))
    fault = (
        F.when(declared & F.col("a").isNull(), say("PARSE_UNKNOWN_WALL_REF", "opening references unknown wall"))
        .when(declared & off, say("PARSE_OPENING_OFF_WALL", "opening is offset from declared wall"))
        .when(declared & skew, say("PARSE_OPENING_OFF_WALL", "opening is not collinear with declared wall"))
        .when(declared & wide, say("PARSE_OPENING_WIDTH_EXCEEDS_WALL", "opening width exceeds wall span"))
        .when(~declared & (F.col("n_walls") == 0), say("PARSE_UNKNOWN_WALL_REF", "opening does not resolve to any wall"))
        .when(~declared & (F.col("n_walls") > 1), say("PARSE_AMBIGUOUS_WALL_REF", "opening resolves to multiple walls"))
    )
    return by_id.withColumn("fault", fault)


def _faults(df: DataFrame, ref) -> DataFrame:
    from plumbline.operators.findings import PARSE

    code = F.col("fault.code")
    pick = lambda k: F.create_map(*[x for c, spec in PARSE.items() for x in (F.lit(c), F.lit(spec[k]))])[code]
    return df.where("fault is not null").select("plan_id", code.alias("code"), pick(0).alias("severity"), pick(1).alias("tier"), ref.cast("string").alias("source_ref"), F.col("fault.message").alias("message"))


def validate(n: Normalizing | Normalized) -> DataFrame:
    """All findings of the parse stage (distinct; see findings.precedence)."""
    n = n.settled() if isinstance(n, Normalizing) else n
    ref = F.col("source_ref")
    none = F.lit(None).cast("string")
    long = g.length(F.col("start_m"), F.col("end_m"))
    parts = [n.finding, degenerate_walls(n.wall)]
    wall_twice, room_twice = duplicates(n.wall, "start_g", "end_g"), duplicates(n.room, "ring_g")
    opening_twice = duplicates(n.opening, "type", "wall_id", "center_g", "width_g")
    for kind, table, twice in (("wall", n.wall, wall_twice), ("room", n.room, room_twice), ("opening", n.opening, opening_twice)):
        parts.append(finding(twice, "PARSE_DUPLICATE_ENTITY", f"duplicate {kind} geometry", ref))
        parts.append(finding(table.where(F.col("confidence") < LOW_CONFIDENCE), "PARSE_LOW_CONFIDENCE", f"{kind} confidence below threshold", ref))
        parts.append(finding(table.groupBy("plan_id").count().where(F.col("count") > LIMITS[kind]), "PARSE_RESOURCE_LIMIT", f"{kind} count exceeds configured limit"))
    rings = ring_faults(n.room)
    parts += [_faults(rings, ref), finding(crossing_rooms(n.room), "PARSE_ROOM_BOUNDARY_UNMATCHED", "room boundaries cross", ref), _faults(opening_faults(n.opening, n.wall), none)]
    parts.append(dimension_faults(n.dimension))
    # No usable wall and no usable room, though there are walls and rooms.
    first_wall = n.wall.withColumn("k", F.row_number().over(Window.partitionBy("plan_id", "start_g", "end_g").orderBy("ord")))
    first_room = rings.withColumn("k", F.row_number().over(Window.partitionBy("plan_id", "ring_g").orderBy("ord")))
    walls = first_wall.groupBy("plan_id").agg(F.count_if((long >= DEGENERATE_WALL_M) & (F.col("k") == 1)).alias("walls"))
    rooms = first_room.groupBy("plan_id").agg(F.count_if(F.col("fault").isNull() & (F.col("k") == 1)).alias("rooms"))
    parts.append(finding(walls.join(rooms, "plan_id").where("walls = 0 and rooms = 0"), "PARSE_EMPTY_GEOMETRY", "no usable geometry remains after validation"))
    return union(parts)
